"""The source audit against a plain count over all terms."""

import random
import re
from collections import Counter

import pytest

from ledgerlens.llm import audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs=3, top=200):
    """rows: (text, lang, source)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = [((t or "").translate(lower), q or "", s or "") for t, q, s in rows]
    out = []
    for lang in {q for _, q, _ in rows}:
        of = [(TERM.findall(t), s) for t, q, s in rows if q == lang]
        docs = Counter(w for ws, _ in of for w in set(ws))
        kept = sorted(w for w, n in docs.items() if n >= min_docs)
        count = {None: Counter(), **{s: Counter() for _, s in of}}
        for ws, s in of:
            for w in ws:
                if docs[w] >= min_docs:
                    count[s][w] += 1
                    count[None][w] += 1
        share = {s: {w: 1 + 10 ** 9 * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept}
                 for s, c in count.items()}
        f = lambda p, q: (p - q) * (p - q) // q
        for s in count:
            if s is None:
                continue
            pairs = [(-sum(f(share[s][w], share[o][w]) for w in kept), o) for o in count if o not in (None, s)]
            found = [(-f(share[s][w], share[None][w]), w) for w in kept
                     if count[s][w] and share[s][w] > share[None][w]]
            for part, list_ in (("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode()))),
                                ("term", sorted(found, key=lambda x: (x[0], x[1].encode()))[:top])):
                out += [(lang, s, part, item, -v, r + 1) for r, (v, item) in enumerate(list_)]
    return sorted(out)


def frame(spark, rows):
    rows = [(i, t, q, s, "x", 1, 2, "y", 3) for i, (t, q, s) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id int, text string, lang string, source string, term string, n int, "
                                       "tile int, item string, id int")


def result(df):
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, docs=120, words=150, sources=6):
    rnd = random.Random(seed)
    rows = []
    for _ in range(docs):
        lang, source = rnd.choice(["en", "en", "de", None]), rnd.choice([*map(str, range(sources)), None])
        n = rnd.randint(0, 60)
        rows.append((" ".join(f"{rnd.choice('aBzé')}{'x' * int(rnd.expovariate(0.05) % words)}" for _ in range(n)),
                     lang, source))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_count(spark, seed):
    rows = corpus(seed)
    assert result(audit.audit(frame(spark, rows))) == brute(rows)


def test_many_sources_meet_in_tiles(spark, monkeypatch):
    rows = corpus(3, docs=160, sources=14)
    monkeypatch.setattr(audit, "TILE_SOURCES", 3)
    assert result(audit.audit(frame(spark, rows))) == brute(rows)


def test_groups_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = corpus(4)
    monkeypatch.setattr(audit, "MAX_GROUP_BYTES", 0)
    monkeypatch.setattr(audit, "HELD_TERMS", 10)
    assert result(audit.audit(frame(spark, rows))) == brute(rows)


def test_levels_over_several_words_and_blocks(spark):
    """More terms than a block of ids holds; a hot source; very long text."""
    rnd = random.Random(5)
    letters = "abcdefghijklmnop"
    names = [a + b + c for a in letters for b in letters for c in letters][:2500]
    rows = [(" ".join(names), "en", s) for s in "aab"]
    rows += [(" ".join(rnd.choices(names, k=20_000)), "en", "hot")]
    rows += [(" ".join(rnd.choices(names[:50], k=30)), "en", rnd.choice(["hot", "b", "c"])) for _ in range(60)]
    got = result(audit.audit(frame(spark, rows), top=40))
    assert got == brute(rows, top=40)
    assert sum(r[2] == "term" and r[1] == "hot" for r in got) == 40


def test_empty_and_null(spark):
    assert result(audit.audit(frame(spark, []).limit(0))) == []
    rows = [(None, None, None), ("", "en", "a"), ("12 !!", "en", "b"), ("once", "de", "a")]
    assert result(audit.audit(frame(spark, rows))) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_ties_go_by_item(spark):
    rows = [("b a é", "en", "x")] * 3 + [("c", "en", "y")] * 3
    got = [r for r in result(audit.audit(frame(spark, rows))) if r[1:3] == ("x", "term")]
    assert [r[3] for r in sorted(got, key=lambda r: r[5])] == ["a", "b", "é"] and got == [
        r for r in brute(rows) if r[1:3] == ("x", "term")]
