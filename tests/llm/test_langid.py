import zlib

import zstandard

from ledgerlens.llm import langid as L

DOCS = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(DOCS)
    got = {r.doc_id: r for r in L.identify(docs, L.learn(docs)).collect()}
    held = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    right = sum(got[r.doc_id].lang == r.lang for r in held)
    assert right >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_held_out_rows_teach_nothing(frame):
    rows = [(i, f"word{i} " * 20, "aa" if zlib.crc32(str(i).encode()) % 4 != 2 else "held") for i in range(60)]
    assert L.learn(frame(rows)).languages == ["aa"]


def test_defined_answers(spark, frame):
    docs = spark.read.parquet(DOCS)
    samples = L.learn(docs)
    long = " ".join(r.text for r in docs.where("lang = 'fr'").limit(60).collect())
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, long), (5, "日本"), (None, long[:500]), (4, long)]
    got = {(r.doc_id, r.lang) for r in L.identify(frame(rows), samples).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "fr"), (None, "fr")} <= got
    assert next(q for i, q in got if i == 5) in samples.languages
    narrow = L.identify(frame([(1, "xqzj")]), samples).first()
    assert 0 <= narrow.margin <= 1 and narrow.rejected == (narrow.margin < L.MARGIN)
    nothing = L.learn(frame([]))
    assert [r.lang for r in L.identify(frame([(1, "hello")]), nothing).collect()] == ["und"]
    assert L.identify(frame([]), samples).count() == 0


def plain_sizes(samples, text):
    """The sizes by one-shot compression with freshly made dictionaries."""
    text = text.lower()
    out = []
    for dictionaries, contexts in zip(samples.dictionaries, samples.contexts):
        total = n = 0
        for raw, tails in zip(dictionaries, contexts):
            def size(data, strategy):
                settings = L._settings(strategy)
                made = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                return len(zstandard.ZstdCompressor(dict_data=made, compression_params=settings).compress(data))
            if len(text) < L.SHORT_BYTES:
                for t in tails:
                    total += size(t + text, zstandard.STRATEGY_DFAST) - size(t, zstandard.STRATEGY_DFAST)
                    n += 1
            else:
                total += sum(size(text[i:i + L.CHUNK_BYTES], zstandard.STRATEGY_GREEDY)
                             for i in range(0, len(text), L.CHUNK_BYTES))
                n += 1
        out.append(total / n)
    return out


def test_sizes_and_choice_equal_plain_compression(spark, small_docs):
    samples = L.learn(small_docs)
    classifier = L.Classifier(samples)
    texts = [r.text.encode() for r in small_docs.where("text is not null").limit(40).collect()] + [
        b"short one", "été".encode(), b"x" * 50_000]
    for text in texts:
        want = plain_sizes(samples, text)
        assert classifier.sizes(text).tolist() == want
        if L.has_letter(text):
            lang, _, margin, rejected = classifier.predict(text)
            best = min(range(len(want)), key=want.__getitem__)        # the first of equal ones
            assert lang == samples.languages[best] and rejected == (margin < L.MARGIN)


def test_equal_sizes_go_to_the_more_frequent_language():
    same = L.Samples(["b", "a"], [[b"some words here"] * 2] * 2, [[[b"some"] * 4] * 2] * 2, [False] * 2)
    lang, score, margin, rejected = L.Classifier(same).predict(b"words of a text")
    assert (lang, score, margin, rejected) == ("b", 0.5, 0.0, True)


def test_one_dirty_row_changes_no_other_language(spark, small_docs):
    """A language of one short text gets its own small dictionaries."""
    clean = L.learn(small_docs)
    row = next(i for i in range(10**6, 10**6 + 50) if zlib.crc32(str(i).encode()) % 4 != L.HELD_OUT)
    dirty = spark.createDataFrame([(row, "hello there", "xx")], "doc_id bigint, text string, lang string")
    both = L.learn(small_docs.select("doc_id", "text", "lang").unionAll(dirty))
    assert both.languages == [*clean.languages, "xx"]
    assert both.dictionaries[:-1] == clean.dictionaries and both.contexts[:-1] == clean.contexts
    a, b = L.Classifier(clean), L.Classifier(both)
    texts = [r.text.encode() for r in small_docs.where("text is not null").collect()]
    moved = sum(a.predict(t)[0] != b.predict(t)[0] for t in texts)
    assert moved == 0
    # the one text it was learned from is its own
    assert b.predict(b"hello there hello there")[0] == "xx"


def test_what_the_driver_receives_is_bounded(spark, small_docs, monkeypatch):
    monkeypatch.setattr(L, "FIT_BYTES", 200_000)
    samples = L.learn(small_docs)
    assert sum(len(d) for own in samples.dictionaries for d in own) <= 200_000
    assert len(samples.languages) == 4 and L.Classifier(samples).predict(b"the house of the man")[0] in samples.languages
