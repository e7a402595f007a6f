"""Language identification by compression.

Every language is represented by raw-content zstandard dictionaries made of
its texts; a text belongs to the language whose dictionaries encode it in the
fewest bytes, and a narrow margin rejects the answer.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_class, pieces

UNKNOWN = "und"
DICTIONARIES = 2                 # per language
DICTIONARY_BYTES = 32_768
CONTEXTS = 4                     # per dictionary, for short texts
CONTEXT_BYTES = 512
#: Texts below this are measured by what they add to a context of the language:
#: a frame of so few bytes by itself is mostly overhead.
SHORT_BYTES = 1_024
CHUNK_BYTES = 16_384
#: Documents per language from which dictionaries are cut, about, and the most
#: bytes of them, over all languages, that the driver receives.
FIT_DOCUMENTS = 600
FIT_BYTES = 64 << 20
#: Each takes about 2 MB of compressors in every worker.
MAX_LANGUAGES = 200
#: Relative margin between the two best sizes below which an answer is rejected.
MARGIN = 0.01
#: Part of a text's own size that dictionaries of little text must save to win.
LITTLE_SAVING = 0.1
HELD_OUT = 2                     # crc32(id) mod 4 of held-out rows

_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text.decode("utf-8", "replace")))


def _settings(strategy: int) -> zstandard.ZstdCompressionParameters:
    return zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=16, chain_log=16, search_log=3, min_match=4, target_length=16,
        strategy=strategy, write_content_size=False, write_dict_id=False)


@dataclass
class Samples:
    """What is learned: per language its dictionaries and contexts."""

    languages: list[str]                 # most frequent first; wins a tie
    dictionaries: list[list[bytes]]
    contexts: list[list[list[bytes]]]
    little: list[bool]                   # of less text than the dictionaries hold


class Classifier:
    """Compressors of every learned language."""

    def __init__(self, samples: Samples) -> None:
        self.languages = samples.languages
        self.little = np.array(samples.little, dtype=bool)
        self.long, self.short = [], []
        self.plain_long, self.plain_short = (
            zstandard.ZstdCompressor(compression_params=_settings(s)).compress
            for s in (zstandard.STRATEGY_GREEDY, zstandard.STRATEGY_DFAST))
        for dictionaries, contexts in zip(samples.dictionaries, samples.contexts):
            longs, shorts = [], []
            for raw, tails in zip(dictionaries, contexts):
                longs.append(self._compressor(raw, zstandard.STRATEGY_GREEDY))
                squeeze = self._compressor(raw, zstandard.STRATEGY_DFAST)
                shorts += [(squeeze, t, len(squeeze(t))) for t in tails]
            self.long.append(longs)
            self.short.append(shorts)

    @staticmethod
    def _compressor(raw: bytes, strategy: int):
        settings = _settings(strategy)
        d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(dict_data=d, compression_params=settings).compress

    def alone(self, text: bytes) -> int:
        """Encoded bytes of the whole text without a dictionary."""
        text = text.lower()
        if len(text) < SHORT_BYTES:
            return len(self.plain_short(text)) - len(self.plain_short(b""))
        return sum(len(self.plain_long(text[i:i + CHUNK_BYTES])) for i in range(0, len(text), CHUNK_BYTES))

    def sizes(self, text: bytes) -> np.ndarray:
        """Mean encoded bytes of the whole text under each language."""
        text = text.lower()
        if len(text) < SHORT_BYTES:
            return np.array([sum(len(c(t + text)) - n for c, t, n in ways) / len(ways) for ways in self.short])
        chunks = [text[i:i + CHUNK_BYTES] for i in range(0, len(text), CHUNK_BYTES)]
        return np.array([sum(len(c(x)) for c in ways for x in chunks) / len(ways) for ways in self.long])

    def predict(self, text: bytes | None) -> tuple[str, float, float, bool]:
        """``(language, score, margin, rejected)`` of a text.

        The score is the posterior of the smallest size when each byte counts
        as eight bits of evidence; the margin is the second size's excess (1 at most).
        A language learned from little text wins only by a margin that is not
        narrow and if its dictionaries save bytes at all: a text that repeats
        itself is encoded best with the smallest ones, whatever they hold.
        """
        if text is None or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, 0.0, True
        sizes = self.sizes(text)
        best = int(sizes.argmin())
        if self.little[best] and not self.little.all():
            others = np.where(self.little, np.inf, sizes)
            if (others.min() - sizes[best] < MARGIN * others.min()
                    or sizes[best] > (1 - LITTLE_SAVING) * self.alone(text)):
                sizes = others
                best = int(sizes.argmin())
        score = float(1.0 / np.exp2(np.maximum(-1000.0, -8.0 * (sizes - sizes[best]))).sum())
        if len(sizes) == 1:
            return self.languages[0], score, 1.0, False
        second = float(np.partition(sizes, 1)[1])
        margin = min(1.0, (second - sizes[best]) / max(second, 1.0)) if second < np.inf else 1.0
        margin = float(margin)
        return self.languages[best], score, margin, margin < MARGIN


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          documents: int = FIT_DOCUMENTS) -> Samples:
    """Dictionaries from slices of about ``documents`` texts per language.

    Only rows with id, text and language that are not held out are used. The
    driver receives the distinct slices of that bounded sample, ``FIT_BYTES`` at
    most (fewer documents each, where languages are many); more than
    ``MAX_LANGUAGES`` languages are an error. Dictionaries of languages with
    enough text (an eighth of what the largest has) have one size; a language with
    less has smaller ones of its own, and changes nothing for the others.
    """
    text, key = F.col("text"), F.col("id")
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    known = known.where(key.isNotNull() & F.col("lang").isNotNull() & (F.length(text) > 0)
                        & (crc_class(key) != HELD_OUT))
    counts = {r["lang"]: r["n"] for r in
              known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return Samples([], [], [], [])
    need = DICTIONARIES * (DICTIONARY_BYTES + CONTEXTS * CONTEXT_BYTES)
    shortest, longest = 300, 1_200
    drawn_from = {q: min(n, documents) for q, n in counts.items()}
    widths = {q: min(longest, 2 * max(shortest, need // n + 1)) for q, n in drawn_from.items()}
    wanted = 4 * sum(n * widths[q] for q, n in drawn_from.items())    # four bytes a character at most
    part = min(1.0, FIT_BYTES / wanted)
    spread = 1 << 30

    def of_lang(values: dict[str, int]):
        return F.create_map(*[F.lit(x) for q, v in values.items() for x in (q, v)])[F.col("lang")]

    limit = of_lang({q: int(min(1.0, part * documents / n) * spread) for q, n in counts.items()})
    drawn = F.pmod(F.xxhash64(F.lit("language"), key, F.length(text), F.substring(text, 1, 100)), F.lit(spread))
    middle = F.substr(text, F.greatest(F.lit(1), (F.length(text) / 2 - longest / 2).cast("int")), of_lang(widths))
    rows = known.where(drawn < limit).select("lang", middle.alias("part")).distinct().collect()

    streams = {}
    for lang in counts:
        parts = sorted((r["part"].encode().lower() for r in rows if r["lang"] == lang), key=_mixed)
        width = max(shortest, min(longest, need // max(1, len(parts)) + 1))
        streams[lang] = b"\n".join(p[:width].decode("utf-8", "ignore").encode() for p in parts)
    most = min(need, max(map(len, streams.values())))
    common = min(most, *(len(s) for s in streams.values() if len(s) >= most // 8))
    languages = sorted(counts, key=lambda q: (-counts[q], q))
    out = Samples(languages, [], [], [len(streams[q]) < common for q in languages])
    for lang in languages:
        stream, at = streams[lang], 0
        room = max(4_096, min(common, len(stream)))
        context = min(CONTEXT_BYTES, room // (4 * DICTIONARIES * CONTEXTS))
        size = room // DICTIONARIES - CONTEXTS * context

        def take(n: int) -> bytes:
            nonlocal at
            part, at = stream[at:at + n], at + n
            return part or stream[:n]            # a language with too few texts

        out.contexts.append([[take(context) for _ in range(CONTEXTS)] for _ in range(DICTIONARIES)])
        out.dictionaries.append([take(size) for _ in range(DICTIONARIES)])
    return out


def _mixed(part: bytes) -> bytes:
    """Sort key of a fixed order that mixes the sample."""
    return hashlib.blake2b(part, digest_size=8).digest()


def identify(docs: DataFrame, samples: Samples, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang, score, margin, rejected)`` for every row of ``docs``.

    ``lang`` is the language of the smallest size; ``rejected`` tells that the
    margin is narrow. A null text, one without a letter, or no learned
    language gives ``und``, score 0, rejected. Equal sizes go to the language
    learned from more rows. Texts are read whole, in chunks. Repeated rows each
    keep theirs; an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(held.value)
        for batch in batches:
            for b in pieces(batch):
                found = [classifier.predict(t) for t in b.column(1).cast(pa.binary()).to_pylist()]
                lang, score, margin, rejected = zip(*found) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                     pa.array(margin, pa.float64()), pa.array(rejected, pa.bool_())],
                    names=["doc_id", "lang", "score", "margin", "rejected"])

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, lang string, score double, margin double, rejected boolean")
