import random

from ledgerlens.llm import lines


def brute(rows, least):
    """Delete every line in some run of ``least`` words or more that occurs earlier."""
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    units = {}
    for i in order:
        split = (rows[i][1] or "").split("\n")
        units[i] = [(p, x, len(x.split())) for p, x in enumerate(split) if x.split()]
    seen, gone = {}, {i: set() for i in order}
    for i in order:
        u = units[i]
        spans = set()
        for s in range(len(u)):
            total, e = 0, s
            while e < len(u) and total < least:
                total += u[e][2]
                e += 1
            if total >= least:
                spans.add((s, e - 1))
        for e in range(len(u)):
            total, s = 0, e
            while s >= 0 and total < least:
                total += u[s][2]
                s -= 1
            if total >= least:
                spans.add((s + 1, e))
        for s, e in sorted(spans):
            key = tuple(x for _, x, _ in u[s:e + 1])
            if key not in seen:
                seen[key] = (i, s, e)
                continue
            j, fs, fe = seen[key]
            a = u[fe][0] + 1 if j == i and s <= fe else u[s][0]
            gone[i] |= set(range(a, u[e][0] + 1))
    return {rows[i][0]: None if rows[i][1] is None else "\n".join(
        x for p, x in enumerate(rows[i][1].split("\n")) if p not in gone[i]) for i in order}


def check(frame, rows, least):
    got = lines.dedup_lines(frame(rows), min_words=least)
    assert {r.doc_id: r.text for r in got.collect()} == brute(rows, least)


def test_random_documents_match_brute_force(frame):
    rng = random.Random(11)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice([1, 2, 4, 7]))) for _ in range(14)] + ["", "  "]
    for least in (1, 5, 8):
        rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.choice([0, 1, 3, 9, 20])))) for i in range(60)]
        check(frame, rows, least)


def test_planted_passage_of_over_fifty_words(frame):
    passage = [" ".join(f"p{i}w{j}" for j in range(20)) for i in range(3)] + ["short end"]
    alone = " ".join(f"q{j}" for j in range(51))
    rows = [(1, "intro one\n" + "\n".join(passage) + "\ntail one"), (2, "\n".join(passage[:2]) + "\nnot enough"),
            (3, "x\n" + "\n".join(passage) + "\ny"), (4, alone), (5, f"{alone}\nz\n{alone}"), (6, alone)]
    got = {r.doc_id: r.text for r in lines.dedup_lines(frame(rows)).collect()}
    assert got == {1: rows[0][1], 2: rows[1][1], 3: "x\ny", 4: alone, 5: "z", 6: ""}


def test_overlap_inside_a_document_keeps_the_first_run(frame):
    line = " ".join("abcdefghijklmnopqrstuvwxyzabcd")
    (r,) = lines.dedup_lines(frame([(1, "\n".join([line] * 5))])).collect()
    assert r.text == "\n".join([line] * 2)


def test_nulls_repeats_long_texts_and_extra_columns(frame):
    long = "\n".join(" ".join(f"{i}_{j}" for j in range(9)) for i in range(4000))
    rows = [(1, None), (2, ""), (3, long), (4, long), (None, "a b"), (5, long.split("\n")[0]), (6, long), (6, long)]
    docs = frame(rows)
    got = lines.dedup_lines(docs).collect()
    assert len(got) == len(rows)
    texts = sorted((str(r.doc_id), r.text) for r in got)
    assert texts == sorted([("1", None), ("2", ""), ("3", long), ("4", ""), ("None", "a b"),
                            ("5", rows[5][1]), ("6", ""), ("6", "")])
    assert lines.dedup_lines(docs).drop("_ll_runs").columns == docs.columns
    assert lines.dedup_lines(frame([])).count() == 0


def test_no_python_in_the_plan(frame):
    plan = lines.dedup_lines(frame([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_ends_of_windows_are_never_broadcast(spark, frame):
    passage = "\n".join(f"line {i} of a passage that occurs again" for i in range(20))
    runs = lines.repeated_runs(spark.createDataFrame(
        [(i, i * 7, f"{passage}\n{passage}\n{passage[:-30]}") for i in range(50)], "id bigint, h bigint, text string"))
    got = runs.collect()
    assert len(got) == 50
    assert "Broadcast" not in runs._jdf.queryExecution().executedPlan().toString()
