import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.llm import divergence as V

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORD.findall(text or "")
    c = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if c[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum((text or "").count(x) for x in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered), failed)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aab \n\t#|é日\xa0")), max_size=120))
def test_base_measures(text):
    assert V.base_measures(text.encode()) == brute(text)


def test_base_measures_of_documents_and_classes(small_docs):
    for r in small_docs.collect():
        assert V.base_measures(r.text.encode()) == brute(r.text)
        assert sum(V.class_counts(r.text.encode())) == len(r.text)


def test_distance():
    p, q = np.array([1.0, 0]), np.array([0, 3.0])
    assert V.jensen_shannon(p, q) == pytest.approx(1) and V.jensen_shannon(p, p) == 0
    a, b = np.array([0.2, 0.5, 0.3]), np.array([0.3, 0.3, 0.4])
    m = (a + b) / 2
    want = (0.5 * (a * np.log2(a / m)).sum() + 0.5 * (b * np.log2(b / m)).sum()) ** 0.5
    assert V.jensen_shannon(4 * a, b) == pytest.approx(want)


def test_reference_counts_everything_once(frame):
    text = "the cat and the dog"
    refs = V.references(frame([(1, text, "en"), (2, "The end", "en"), (3, None, "en"), (4, "le", None), (5, "der", "de")]))
    assert set(refs) == {"en", "de"}
    en = refs["en"]
    # the texts are far more than a thousandth of their language, but have no copies
    assert en.counts[en.words[b"the"]] == 3 and en.counts.sum() == 7
    copies = V.references(frame([(i, text, "en") for i in range(50)]))["en"]
    assert copies.counts.sum() == pytest.approx(5)


def test_verdicts(frame, small_docs):
    refs = V.references(small_docs)
    good = " ".join(r.text for r in small_docs.where("lang = 'en' and doc_id < 3").collect())
    rows = [(1, good, "en"), (2, good, None), (3, good, "xx"), (4, good.upper() + "!!", "en"), (5, None, "en"), (6, "", "en"),
            (7, "short text", "en"), (8, " ".join(w + "%%%" for w in good.split()), "en"), (None, good, "en"), (1, good, "en")]
    got = sorted((str(r.doc_id), r.kept, r.base_failed) for r in V.judge(frame(rows), refs).collect())
    assert got == sorted([("1", True, False), ("2", True, False), ("3", True, False), ("4", False, False),
                          ("5", False, True), ("6", False, True), ("7", False, True), ("8", False, False),
                          ("None", True, False), ("1", True, False)])
    assert V.references(frame([])) == {} and V.judge(frame([]), {}).count() == 0
    assert V.judge(frame(rows), {}).where("kept").count() == 7


def test_labelled_quality(spark, small):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1")
    judged = V.judge(docs, V.references(docs)).join(labels, "doc_id")
    passed = judged.where("not base_failed")
    assert passed.where("kept").count() >= 0.98 * passed.count()


def test_missing_common_words_are_rejected(spark, frame):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1")
    refs = V.references(docs)
    good = [r for r in docs.join(labels, "doc_id").collect() if len(r.text.split()) >= V.MIN_WORDS_FOR_COMMON]
    rng = random.Random(1)
    letters = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n))
               for n in (100, 300, 1000) for _ in range(10)]
    rows = [(0, r.text, r.lang) for r in good]
    rows += [(1, r.text, q) for r in good for q in refs if q != r.lang]
    rows += [(2, t, q) for t in letters for q in [*refs, None]]
    judged = V.judge(frame(rows), refs).where("not base_failed").groupBy("doc_id").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.doc_id: r.kept for r in judged}
    assert kept[0] >= 0.98 and kept[1] <= 0.02 and kept[2] == 0


def test_rare_common_words_do_not_reject():
    # one common word in a hundred: a short text may miss it by chance, a long one may not
    ref = V.Reference(np.ones(8), {b"x": 0}, np.array([1.0, 99.0]))
    assert not V.lacks_common(b"w " * 100, ref) and V.lacks_common(b"w " * 10_000, ref)
    assert not V.lacks_common(b"w " * 9_930 + b"x " * 70, ref)


@pytest.mark.parametrize("limit", [V.MAX_REPEATED, 0])
def test_every_distinct_text_counts_once(spark, frame, monkeypatch, limit):
    # two copies among thousands of rows, and one text at a third of the rows
    monkeypatch.setattr(V, "MAX_REPEATED", limit)
    rows = [(i, f"common w{i}", "en") for i in range(3_000)]
    rows += [(i, f"common w{i}", "en") for i in range(500)] + [(0, "hot text", "en")] * 1_500
    rows += [(0, "common w0", "de")] * 2 + [(0, "", "de"), (0, None, "de"), (0, "x", None)]
    refs = V.references(frame(rows).repartition(7))
    en, de = refs["en"], refs["de"]
    assert en.counts[en.words[b"common"]] == 3_000 and en.counts[en.words[b"hot"]] == 1
    assert en.counts.sum() == 6_002 and de.counts.sum() == 2
    assert en.classes.sum() == sum(map(len, {t for _, t, q in rows if q == "en"}))


KINDS = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", ".,;:?!\"'()-", "#*$%&|<>", " \t\n\x0b\x0c\r"]


def plain_verdicts(rows):
    """Verdicts by plain counting: rows of (id, text, lang)."""
    def kinds(text):
        where = [next((i for i, k in enumerate(KINDS) if ch in k), 6 if ord(ch) > 127 else 7) for ch in text]
        return [where.count(i) for i in range(8)]

    def lowered(text):
        return [w for w in re.split("[ \t-\r]+", re.sub("[A-Z]", lambda m: m.group().lower(), text)) if w]

    def distance(p, q):
        p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
        out = 0
        for a, b in zip(p, q):
            out += sum(0.5 * x * np.log2(2 * x / (a + b)) for x in (a, b) if x)
        return max(out, 0) ** 0.5

    refs = {}
    for lang in {q for _, t, q in rows if q is not None and t is not None}:
        texts = {t for _, t, q in rows if q == lang and t is not None}
        classes = np.sum([kinds(t) for t in texts], axis=0)
        words = Counter(w for t in texts for w in lowered(t))
        top = sorted(words, key=lambda w: (-words[w], w.encode()))[:100]
        if top:
            refs[lang] = classes, top, [words[w] for w in top] + [words.total() - sum(words[w] for w in top)]
    out = []
    for i, text, lang in rows:
        failed, text = brute(text)[-1], text or ""
        found = []
        for q in [lang] if lang in refs else sorted(refs):
            classes, top, counts = refs[q]
            by_class = distance(kinds(text), classes) if len(text) >= 200 else None
            w, by_word, lacks = lowered(text), None, False
            if len(w) >= 100:
                own = Counter(w)
                mine = [own[x] for x in top]
                by_word = distance([*mine, len(w) - sum(mine)], counts)
                share = 1 - counts[-1] / sum(counts)
                expected = len(w) * share
                lacks = sum(mine) < min(0.55 * expected, expected - 3 * (expected * (1 - share)) ** 0.5)
            found.append((by_word or 0, by_class or 0, by_class, by_word, lacks))
        _, _, c, w, lacks = min(found, key=lambda x: x[:2])
        out.append((i, c, w, not failed and not lacks and (c or 0) <= 0.25 and (w or 0) <= 0.47))
    return out


def test_verdicts_equal_plain_counting(spark, frame, small_docs):
    rng = random.Random(4)
    rows = [(r.doc_id, r.text, rng.choice([r.lang] * 4 + [None, "xx", "de"])) for r in small_docs.limit(120).collect()]
    rows += [(1000, None, "en"), (1001, "", None), (1002, " ".join(["the", "and", "of"] * 40), None)]
    docs = frame(rows)
    got = {r.doc_id: r for r in V.judge(docs, V.references(docs)).collect()}
    for i, c, w, kept in plain_verdicts(rows):
        assert got[i].kept == kept, i
        for a, b in ((got[i].class_distance, c), (got[i].word_distance, w)):
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, abs=1e-9))


def test_very_long_text_and_one_language_for_both_distances(frame, small_docs):
    refs = V.references(small_docs)
    texts = {q: " ".join(r.text for r in small_docs.where(F.col("lang") == q).collect()) for q in refs}
    rows = [(1, texts["en"] * 40, "en"), (2, "x" * 3_000_000, "en"), (3, "a b c d " * 200_000, None)]
    rows += [(10 + k, t[:3_000], None) for k, t in enumerate(texts.values())]
    got = {r.doc_id: r for r in V.judge(frame(rows), refs).collect()}
    assert not got[2].kept and got[2].n_words == 1 and got[3].n_repeat_words == 800_000 and not got[3].kept
    for k, t in enumerate(texts.values()):
        pairs = [V.distances(t[:3_000].encode(), r) for r in refs.values()]
        assert (got[10 + k].class_distance, got[10 + k].word_distance) in pairs
