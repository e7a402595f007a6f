import hashlib
import random
import re

from ledgerlens.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(rows, items):
    wins = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9)) if w else ():
            wins.setdefault(tuple(w[i:i + 10]), set()).add(item)
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for i in range(len(w)):
            for k in {len(x) for x in wins}:
                if i + k <= len(w) and tuple(w[i:i + k]) in wins:
                    hit |= set(range(i, i + k))
                    found |= wins[tuple(w[i:i + k])]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def sample():
    rng = random.Random(5)
    vocabulary = ["alpha", "Beta", "gamma", "été", "x1", "日本"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([3, 9, 10, 14, 25]))) for i in range(12)]
    items += [(12, ""), (13, None), (14, "!!! ?"), (None, text(11)), (15, items[0][1]), (15, items[5][1])]
    rows = [(i, text(60)) for i in range(25)]
    rows += [(100 + i, f"{text(3)}, \n<{t.upper() if t else ''}>\t {text(2)}--") for i, (_, t) in enumerate(items)]
    return [*rows, (None, items[0][1]), (200, None), (201, ""), (100, items[1][1]), (202, text(5000))], items


def test_matches_brute_force_in_one_or_several_blocks(spark, frame):
    rows, items = sample()
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    want = brute(rows, items)
    for chars in (D.BLOCK_CHARS, 900):
        got = D.digest(D.find_contamination(frame(rows), bench, block_chars=chars))
        assert sorted((tuple(r) for r in got.collect()), key=str) == want
        kept = D.remove_contaminated(frame(rows), bench, block_chars=chars).collect()
        assert sorted((str(r.doc_id), r.text) for r in kept if r.text) == sorted(
            (str(d), t) for (d, t), w in zip(rows, map(lambda r: brute([r], items)[0], rows)) if t and not w[-1])


def test_spans_point_into_the_original_text(spark, frame):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id bigint, text string")
    text = "Été! <ONE-two, three\nfour; five six 'seven' EIGHT nine…ten> end"
    text = text.replace("…", ".")
    (r,) = D.find_contamination(frame([(1, text)]), bench).collect()
    (s,) = r.spans
    assert text[s.start:s.end] == "ONE-two, three\nfour; five six 'seven' EIGHT nine.ten"
    assert (s.first_word, s.last_word) == (1, 10)


def test_empty_tables(spark, frame):
    none = spark.createDataFrame([], "item_id bigint, text string")
    got = D.digest(D.find_contamination(frame([(1, "some words")]), none)).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in got] == [(2, 0, False)]
    assert D.find_contamination(frame([]), none).count() == 0
    assert D.remove_contaminated(frame([(1, None), (2, "a")]), none).count() == 2


def test_hot_windows_are_cut_by_weight(spark, frame):
    """Many items share one instruction: few blocks, none empty or above its bound, and equal results."""
    instruction = "answer the next question with one word and nothing else now"
    items = [(f"item-{i:05d}", f"{instruction} q{i}") for i in range(2_000)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    bound = 20_000
    blocks = D._blocks(bench, "item_id", "text", D.WINDOW_WORDS, bound)
    rows = [[(len(r["pattern"]), len(r["item"])) for r in b.collect()] for b in blocks]
    sizes = [sum(p + i for p, i in b) for b in rows]
    total = sum(sizes)
    largest = max(p + i for b in rows for p, i in b)
    assert sum(map(len, rows)) == len({(w, i) for i, t in items for w in D.windows(t.encode())})
    assert min(sizes) > 0 and max(sizes) <= bound + largest and len(blocks) <= total // bound + 1
    docs = frame([(1, f"please {instruction} thanks"), (2, f"x {instruction} q7 and {instruction} q1999 end"), (3, "clean")])
    one = D.digest(D.find_contamination(docs, bench))
    many = D.digest(D.find_contamination(docs, bench, block_chars=bound))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    got = {r["doc_id"]: r for r in many.collect()}
    # windows of ten of the eleven words, and those that end in an item's own word
    assert got[1]["n_hit"] == 11 and got[1]["n_items"] == 2_000 and got[3]["n_hit"] == 0
    assert got[2]["n_hit"] == 24 and got[2]["n_items"] == 2_000
    left = D.remove_contaminated(docs, bench, block_chars=bound).collect()
    assert [r["doc_id"] for r in left] == [3]
