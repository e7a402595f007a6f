import math
import re
import zlib
from collections import Counter

import numpy as np

from ledgerlens.llm import quality as Q

SF = "/root/testdata/sf0.01"


def test_linear_time_identity():
    rng = np.random.default_rng(0)
    m = Q.Machine(0.3, rng.normal(size=Q.SIZE), rng.normal(size=(Q.SIZE, Q.RANK)))
    index, value = Q.features("Some words, some WORDS here!! and 12 more\nlines".encode(), 47)
    pairs = sum(float(m.factors[index[i]] @ m.factors[index[j]]) * value[i] * value[j]
                for i in range(len(index)) for j in range(i + 1, len(index)))
    want = m.bias + float((m.linear[index] * value).sum()) + pairs
    assert np.isclose(m.raw(index, value, np.array([0]))[0], want)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in got)
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got)
    good = [r for r in got if r.quality == 1]
    assert sum(r.predicted for r in good) >= 0.97 * len(good)


def test_rows_of_every_kind_are_scored(spark, frame):
    text = "a plain sentence with several words in it. "
    rows = [(i, text * (i % 5 + 1)) for i in range(40)] + [(i, "JUNK!! " * 30) for i in range(40, 80)]
    rows += [(1, text), (None, text), (90, None), (91, ""), (92, "x" * 200_000)]
    labels = spark.createDataFrame([(i, int(i < 40), "z") for i in range(80)] + [(3, 1, "z"), (None, 0, "z"), (5, None, "z")],
                                   "doc_id bigint, quality int, text string")
    got = Q.classify(frame(rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(r.predicted == 1 for r in got if r.doc_id is not None and r.doc_id < 40)
    assert all(r.predicted == 0 for r in got if r.doc_id is not None and 40 <= r.doc_id < 80)
    none = labels.where("false")
    assert {r.score for r in Q.classify(frame(rows[:5]), none).collect()} == {0.5}
    assert Q.classify(frame([]), labels).count() == 0
    assert Q.keep_good(frame(rows), labels).where("doc_id >= 40 and doc_id < 80").count() == 0


def test_scores_of_the_query_equal_all_pairs(spark, small_docs, small):
    """The score from a plain sum over pairs of features, made by plain counting."""
    labels = spark.read.parquet(f"{small}/labels.parquet")
    machine = Q.train(small_docs, labels)
    docs = {r.doc_id: r for r in small_docs.where("length(text) < 1500").limit(25).collect()}
    got = {r.doc_id: r.score for r in Q.classify(small_docs, labels).collect()}
    for i, r in docs.items():
        index, value = Q.features(r.text.encode(), r.n_chars)
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), r.text).split(" ")
        words = Counter(w for x in lowered for w in re.split("[ \t-\r]+", x) if w)
        plain = Counter()
        for w, n in words.items():
            plain[zlib.crc32(w.encode()) % Q.WORD_BUCKETS, 1 + math.log(n)] += 1
        length = math.sqrt(sum(n * v * v for (_, v), n in plain.items()))
        hashed = sorted((b, v / length) for (b, v), n in plain.items() for _ in range(n))
        k = len(words)
        assert np.allclose(sorted(zip(index[:k].tolist(), value[:k].tolist())), hashed, atol=1e-5)
        raw = float(machine.bias)
        v = [np.asarray(machine.factors[a], dtype=np.float64) * b for a, b in zip(index, value)]
        raw += sum(float(machine.linear[a]) * float(b) for a, b in zip(index, value))
        raw += sum(float(v[a] @ v[b]) for a in range(len(v)) for b in range(a + 1, len(v)))
        assert abs(got[i] - 1 / (1 + math.exp(-max(-30, min(30, raw))))) < 1e-4
