"""Quality rules with a distribution-divergence test.

Base measures are counted exactly per text. The verdict compares a document's
character-class and common-word histograms with references of the languages,
by Jensen-Shannon distance (base 2, 0 to 1), where the text is long enough for
its histogram to mean something.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, pieces, utf8

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
REPEAT_WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
COMMON_WORDS = 100                # per language
MAX_LANGUAGES = 1_000
#: Minimum lengths for a histogram to be judged.
MIN_CHARS_FOR_CLASSES = 200
MIN_WORDS_FOR_COMMON = 100
#: Largest distances that are kept.
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.47
#: Least share of common words that is kept, as a part of the reference's share.
#: A text without any is nearer to its reference (0.46) than the limit above.
MIN_COMMON_PART = 0.55
#: Standard deviations by which the count must also lie below the expected one,
#: where a language's common words are so rare that chance alone can miss them.
COMMON_DEVIATIONS = 3
#: Repeated (language, hash) pairs that are broadcast; with more of them, every text
#: is dealt to find its copies. The rows that count are the same.
MAX_REPEATED = 1_000_000
#: Distinct words a task holds before it passes its counts on.
HELD_WORDS = 200_000
SALTS = 16
#: What a row of counts is of, where it is not of a character class.
WORD, TOTAL = -1, -2

_UPPER, _LOWER, _DIGIT = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
_PUNCTUATION = b".,;:?!\"'()-"
_CONTINUATION = bytes(range(128, 192))
_ASCII = bytes(range(128))
CLASSES = ("upper", "lower", "digit", "punctuation", "symbol", "space", "non_ascii", "other")


def _count(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def class_counts(text: bytes) -> list[int]:
    """Code points per character class."""
    upper, lower, digit, punctuation, symbol, space = (
        _count(text, c) for c in (_UPPER, _LOWER, _DIGIT, _PUNCTUATION, SYMBOLS, SPACE))
    non_ascii = len(text) - _count(text, _ASCII) - _count(text, _CONTINUATION)
    rest = len(text) - _count(text, _CONTINUATION) - (
        upper + lower + digit + punctuation + symbol + space + non_ascii)
    return [upper, lower, digit, punctuation, symbol, space, non_ascii, rest]


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words that lie in a ``window``-word sequence found twice or more."""
    n = len(words)
    if n <= window:            # one window at most
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=n)
    if len(seen) == n:
        return 0
    # double the run of words that a key stands for while it fits, then add one word
    key, span = ids, 1
    while span < window:
        grow = span if 2 * span <= window else 1
        m = n - span - grow + 1
        right = key[span:span + m] if grow == span else ids[span:span + m]
        pairs = key[:m] * (int(right.max()) + 1) + right
        distinct, key, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(distinct) == len(pairs):
            return 0
        span += grow
    again = counts[key] > 1
    covered = np.zeros(n, dtype=bool)
    for shift in range(window):
        covered[shift:shift + len(again)] |= again
    return int(covered.sum())


def base_measures(text: bytes) -> tuple[int, int, int, int, int, bool]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    chars = len(text) - _count(text, _CONTINUATION) - _count(text, SPACE)
    repeated = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * len(words)
    return len(words), chars, _count(text, SYMBOLS), len(lines) - len(set(lines)), repeated, failed


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> float:
    """Distance (root of the divergence, base 2) of two histograms of equal length."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = lambda a: np.nansum(np.where(a > 0, a * np.log2(a / m), 0.0))
        return math.sqrt(max(0.0, 0.5 * float(kl(p)) + 0.5 * float(kl(q))))


@dataclass
class Reference:
    """Histograms of one language: character classes; common words and the rest."""

    classes: np.ndarray
    words: dict[bytes, int]            # word -> place
    counts: np.ndarray                 # one more than words: all other words


def distinct_texts(texts: DataFrame) -> DataFrame:
    """The distinct ``(lang, text)`` rows, compared byte by byte.

    Only texts whose hash occurs again are shuffled, one copy per task; the
    others have no copies and stay where they are.
    """
    hashed = texts.withColumn("h", F.xxhash64("text"))
    again = materialize(hashed.groupBy("lang", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                        .select("lang", "h"), "repeated")
    if again.limit(MAX_REPEATED + 1).count() > MAX_REPEATED:
        return texts.distinct()
    single, repeated = (hashed.join(F.broadcast(again), ["lang", "h"], how).select("lang", "text")
                        for how in ("left_anti", "left_semi"))
    return single.unionAll(repeated.distinct())


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
               common: int = COMMON_WORDS) -> dict[str, Reference]:
    """References of every language in ``lang_col``, over all its texts.

    Rows of null language or text do not count, and every distinct (language,
    text) counts once, so that copies cannot bend a reference. Words are
    counted in the tasks and summed by (language, word), so a frequent language
    or word is one partial count per task, in one pass over the texts. The driver
    receives ``common`` words
    per language, of at most ``MAX_LANGUAGES`` languages (more is an error).
    """
    narrow = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    narrow = distinct_texts(narrow.where(F.col("lang").isNotNull() & F.col("text").isNotNull()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            rows = [(q, None, i, int(n)) for q, c in classes.items() for i, n in enumerate(c)]
            rows += [(q, None, TOTAL, c.total()) for q, c in words.items()]
            rows += [(q, w, WORD, n) for q, c in words.items() for w, n in c.items()]
            classes.clear()
            words.clear()
            for i in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows[i:i + 10_000]),
                                                    (pa.string(), pa.binary(), pa.int32(), pa.int64()))],
                    names=["lang", "word", "class", "n"])

        for batch in batches:
            for b in pieces(batch, 1 << 20):
                for lang, text in zip(b.column(0).to_pylist(), utf8(b.column(1))):
                    classes[lang] = classes.get(lang, 0) + np.array(class_counts(text))
                    words.setdefault(lang, Counter()).update(text.lower().split())
                if sum(map(len, words.values())) > HELD_WORDS:
                    yield from flush()
        yield from flush()

    counted = (narrow.mapInArrow(run, "lang string, word binary, class int, n bigint")
               .groupBy("lang", "class", "word").agg(F.sum("n").alias("n")))
    # Per language and class value: the classes and the total are one row each, the
    # words are ranked. The best of each task go to one of SALTS rankings first, so the
    # last one gets at most SALTS * common rows, however many tasks there are.
    def best(rows: DataFrame, *keys: str) -> DataFrame:
        order = Window.partitionBy("lang", "class", *keys).orderBy(F.desc("n"), "word")
        return rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= common).drop("r")

    salted = counted.withColumn("salt", F.spark_partition_id() % SALTS)
    ranked = best(best(salted, "salt"))
    most = MAX_LANGUAGES * (common + len(CLASSES) + 1)
    rows = ranked.limit(most + 1).collect()
    of: dict[str, list] = {}
    for r in rows:
        of.setdefault(r["lang"], []).append(r)
    if len(of) > MAX_LANGUAGES or len(rows) > most:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out: dict[str, Reference] = {}
    for lang, own in sorted(of.items()):
        total = sum(r["n"] for r in own if r["class"] == TOTAL)
        classes = np.zeros(len(CLASSES))
        for r in own:
            if r["class"] >= 0:
                classes[r["class"]] = r["n"]
        best = sorted(((-r["n"], bytes(r["word"])) for r in own if r["class"] == WORD))
        counts = [-n for n, _ in best]
        if not counts or not classes.sum():
            continue
        out[lang] = Reference(classes, {w: i for i, (_, w) in enumerate(best)},
                              np.array([*counts, total - sum(counts)], dtype=float))
    return out


def distances(text: bytes, reference: Reference) -> tuple[float | None, float | None]:
    """Class and common-word distance; null where the text is too short."""
    by_class = by_word = None
    classes = np.array(class_counts(text), dtype=float)
    if classes.sum() >= MIN_CHARS_FOR_CLASSES:
        by_class = jensen_shannon(classes, reference.classes)
    words = text.lower().split()
    if len(words) >= MIN_WORDS_FOR_COMMON:
        counts = np.zeros(len(reference.counts))
        known = [p for p in map(reference.words.get, words) if p is not None]
        np.add.at(counts, known, 1)
        counts[-1] = len(words) - len(known)
        by_word = jensen_shannon(counts, reference.counts)
    return by_class, by_word


def lacks_common(text: bytes, reference: Reference) -> bool:
    """Whether a text, long enough, has far fewer common words than its language."""
    words = text.lower().split()
    if len(words) < MIN_WORDS_FOR_COMMON:
        return False
    share = 1 - reference.counts[-1] / reference.counts.sum()
    expected = len(words) * share
    chance = COMMON_DEVIATIONS * math.sqrt(expected * (1 - share))
    return sum(map(reference.words.__contains__, words)) < min(MIN_COMMON_PART * expected, expected - chance)


def nearness(found: tuple[float | None, float | None, Reference]) -> tuple[float, float]:
    """Order of references by how near a text is: words first, then classes."""
    by_class, by_word, _ = found
    return by_word or 0.0, by_class or 0.0


_RESULT = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
           "n_repeat_words bigint, base_failed boolean, class_distance double, word_distance double, "
           "kept boolean")


def judge(docs: DataFrame, known: dict[str, Reference], id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """Base measures, distances and verdict for every row of ``docs``.

    A document is compared with its language's reference, or with that of the
    nearest language if its own is null or has none: by the words' distance,
    or by the classes' where the text is too short for words. It is kept if the base rules hold
    and no measured distance is above its limit, nor its share of common words
    far below the reference's (wrong language, gibberish: their distance is
    small, as they only miss words); distances of short texts, and all if there
    is no reference, are null and never reject. Null and empty
    texts have no words, so the base rules fail. Repeated rows each keep
    theirs; an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(known)

    def verdict(text: bytes, lang: str | None) -> tuple:
        base = base_measures(text)
        refs = held.value
        own = refs.get(lang)
        if own is not None:
            by_class, by_word = distances(text, own)
        else:
            near = [(*distances(text, r), r) for r in refs.values()]
            by_class, by_word, own = min(near, key=nearness, default=(None, None, None))
        fits = (by_class or 0.0) <= MAX_CLASS_DISTANCE and (by_word or 0.0) <= MAX_WORD_DISTANCE
        fits = fits and (by_word is None or not lacks_common(text, own))
        return (*base, by_class, by_word, fits and not base[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _RESULT.split(", ")]
        types = [*[pa.int64()] * 5, pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
        for batch in batches:
            for b in pieces(batch):
                rows = [verdict(t, q) for t, q in zip(utf8(b.column(1)), b.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *[pa.array(c, t) for c, t in zip(zip(*rows), types)]], names=names)

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
                         F.col(lang_col).cast("string").alias("lang"))
    return narrow.mapInArrow(run, _RESULT)
