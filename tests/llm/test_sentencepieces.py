"""Encoding by backtracking against the library, and decoding."""

import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import sentencepieces as S
from ledgerlens.llm.common import Memory
from ledgerlens.llm.tokens import vocabulary_path

PATH = vocabulary_path(S.MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PARTS = ["a", "b", "the", "ing", "in", "er", "re", " ", "  ", "▁", "\n", "\t", "日本", "語", "€", "𝄞", "é", "\x00",
         "1", "0", "-", "==", "//", "aaaa", "<s>", "</s>", "<unk>", "<0x41>", "​", "�", "\r\n", "ß", ".”", "한",
         "ा", "."]


def ids_of(data: bytes) -> list[int]:
    return np.frombuffer(data, "<i4").tolist()


def test_random_texts_equal_the_library():
    rnd, e, d = random.Random(1), S.encoder(PATH), S.decoder(PATH)
    for _ in range(4_000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 40)))
        ids = ids_of(e.packed(text))
        assert ids == LIBRARY.encode(text)
        assert d.text(np.array(ids, dtype=np.int32)) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_the_library(text):
    assert ids_of(S.encoder(PATH).packed(text)) == LIBRARY.encode(text)


def test_any_ids_decode_as_the_library():
    rnd, d = random.Random(2), S.decoder(PATH)
    for _ in range(4_000):
        ids = [rnd.choice([rnd.randrange(32_000), rnd.randrange(260), rnd.randrange(3, 259)])
               for _ in range(rnd.randint(0, 8))]
        assert d.text(np.array(ids, dtype=np.int32)) == LIBRARY.decode(ids)


def test_without_cuts_and_with_long_chunks():
    """One chunk of a whole text: nothing is remembered or cut."""
    rnd = random.Random(3)
    e = S.Encoder(PATH)
    text = "".join(rnd.choice("abcdefgh+/ \n日本語の語") for _ in range(20_000))
    assert ids_of(e.chunk("▁" + text.replace(" ", "▁"))) == LIBRARY.encode(text)
    for long in ("A" * 30_000, "ab" * 20_000, " " * 5_000, "日" * 9_000, "é\n" * 5_000):
        assert ids_of(e.packed(long)) == LIBRARY.encode(long)


def test_backtracking_is_needed_and_exact():
    """The longest pieces alone are often not the merge result."""
    e = S.encoder(PATH)
    words = "thlyouble onntshansh ershnted ofthbleingin anreblehe thatthtiorin whationed".split()
    greedy = [[i for _, i in e.vocabulary.automaton.iter_long("▁" + w)] for w in words]
    found = [ids_of(e.packed(w)) for w in words]
    assert found == [LIBRARY.encode(w) for w in words]
    assert any(a != b for a, b in zip(greedy, found))


def test_pair_checks_equal_merging_the_pair():
    rnd, e = random.Random(4), S.encoder(PATH)
    v = e.vocabulary
    normal = sorted(v.ids.values())
    def merge(text):
        symbols = list(text)
        while True:
            best = [(v.scores[a + b], -i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in v.scores]
            if not best:
                return symbols
            i = -max(best)[1]
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]

    for _ in range(3_000):
        a, b = rnd.choice(normal), rnd.choice(normal[:300])
        assert e.fits(a, b) == (merge(v.names[a] + v.names[b]) == [v.names[a], v.names[b]])


def test_memory_is_bounded_in_bytes():
    """Texts without spaces are long pieces: none is kept; short ones are forgotten in turn."""
    made = []
    memory = Memory(lambda t: made.append(t) or t.encode(), max_bytes=10_000, longest=20)
    for i in range(1_000):
        memory["日" * 600 + str(i)]
        memory[str(i)]
    kept = sum(len(k) * 4 + len(v) + Memory.ENTRY_BYTES for d in (memory, memory.older) for k, v in d.items())
    assert kept <= 20_000 and not any(len(k) > 20 for k in memory)
    assert memory["999"] == b"999" and made.count("999") == 1


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    return [None, "", " ", "plain words here", "日本語", "x" * 100_000, "tie tie", "tie tie", "\n\n",
            *("".join(rnd.choice(PARTS) for _ in range(300)) for _ in range(40))]


def test_round_trip_over_a_table(spark, frame, texts):
    docs = frame(list(enumerate(texts)))
    for coded in (S.decode(S.encode(docs)), S.encode(docs, decoded=True)):
        got = {r["doc_id"]: (r["ids"], r["text"]) for r in coded.collect()}
        for i, t in enumerate(texts):
            want = LIBRARY.encode(t or "")
            assert got[i] == (want, LIBRARY.decode(want))


def test_empty_table_null_ids_and_repeats(spark, frame):
    assert S.encode(frame([(1, "a")]).limit(0)).collect() == []
    null = spark.createDataFrame([(1, None), (1, None), (None, [264])], "doc_id bigint, ids array<int>")
    assert sorted((r["doc_id"] or 0, r["text"]) for r in S.decode(null).collect()) == [(0, "a"), (1, ""), (1, "")]
