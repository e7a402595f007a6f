import sys
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlens.llm import packing, planes, tokens
from ledgerlens.session import scratch_path

ENCODER = tokens.encoder(tokens.vocabulary_path())


def whole(text):
    return ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab Cé\n\t　\xa0'.,!1 日🙂<|>")) | st.characters(codec="utf-8")))
def test_cut_encoding_equals_whole_encoding(text):
    assert np.frombuffer(ENCODER.packed(text), "<u4").tolist() == whole(text)


def test_special_spelling_and_memory_limit(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_REMEMBERED", dict.fromkeys(tokens.MAX_REMEMBERED, 900))
    fresh = tokens.Encoder(tokens.vocabulary_path())
    for t in ["<|endoftext|> a <|endoftext|>", "it's we'll DON'T", "a b c d e f g, h. i! j?", "x  y   z \n \n w "]:
        for encoder in (ENCODER, fresh):
            assert np.frombuffer(encoder.packed(t), "<u4").tolist() == whole(t)


def test_texts_without_spaces_are_not_held(monkeypatch):
    """20,000 texts of 600 characters and no space: what is held stays within its bound in bytes."""
    bound = 100_000
    monkeypatch.setattr(tokens, "MAX_REMEMBERED", dict.fromkeys(tokens.MAX_REMEMBERED, bound))
    fresh = tokens.Encoder(tokens.vocabulary_path())
    rnd = np.random.default_rng(1)
    for i in range(20_000 // 100):
        text = "".join(map(chr, rnd.integers(0x4E00, 0x9000, 600)))
        assert fresh.packed(text) == fresh._whole(text)
        fresh.packed(f"{text} {text[:40]} base64{i}")
    for memory in (fresh.spaced, fresh.bare, fresh.marks):
        held = sum(sys.getsizeof(k) + sys.getsizeof(v) for d in (memory, memory.older) for k, v in d.items())
        assert held <= 2 * bound and all(len(k) <= memory.longest for d in (memory, memory.older) for k in d)


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [1, 7, 8, 65_536])
def test_block_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    blob, sizes = planes.encode_block(ids, bits)
    assert (planes.decode_block(blob) == ids).all() and len(sizes) == (32 if bits else 4)
    with pytest.raises(ValueError):
        planes.decode_block(b"XXXX" + blob[4:])


@given(st.binary(max_size=50), st.binary(max_size=50))
def test_crc_join(a, b):
    assert planes.crc_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def expected(rows):
    out, at = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*whole(t), 0], dtype="<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("block,bits", [(64, False), (100, True), (65_536, False)])
def test_files_round_trip(spark, frame, block, bits):
    rows = [(5, "hello world"), (2, None), (9, ""), (None, "no id"), (1, " ".join(f"w{i}" for i in range(900))),
            (7, "x " * 300), (3, "é" * 50)]
    path = scratch_path(spark, "planes-test")
    planes.write_ids(frame(rows), path, block=block, bits=bits)
    got = [tuple(r) for r in planes.read_documents(spark, path).orderBy("start").collect()]
    assert got == expected(rows)
    chunks = planes.read_ids(spark, path).orderBy("part", "chunk").collect()
    joined = [i for c in chunks for i in c.ids]
    assert joined == [x for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)) for x in [*whole(t), 0]]
    index = spark.read.parquet(path)
    assert all(sum(r.plane_bytes) < len(r.blob) for r in index.collect())
    full = {(r.part, r.chunk): r.n for r in index.collect()}
    assert all(n == block for (p, c), n in full.items() if (p, c + 1) in full)


def test_repeated_ids_and_empty_table(spark, frame):
    path = scratch_path(spark, "planes-test")
    planes.write_ids(frame([(1, "same"), (1, "same"), (1, "other one"), (0, "first")]), path)
    got = planes.read_documents(spark, path).collect()
    assert sorted(r.doc_id for r in got) == [0, 1, 1, 1]
    spans = sorted((r.start, r.n_tokens) for r in got)
    assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    path = scratch_path(spark, "planes-test")
    planes.write_ids(frame([]), path)
    assert planes.read_documents(spark, path).count() == 0


def test_documents_table(spark, small_docs):
    path = scratch_path(spark, "planes-test")
    planes.write_ids(small_docs, path)
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    assert [tuple(r) for r in planes.read_documents(spark, path).orderBy("start").collect()] == expected(rows)


def test_added_token_spelling_is_one_id(spark, frame):
    plain = Tokenizer.from_file(tokens.vocabulary_path())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y z", "no such text", "<|endoftext|", "a b"]
    ids = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids[0] == [64, 220, 50256, 275]
    assert [np.frombuffer(ENCODER.packed(t), "<u4").tolist() for t in texts] == ids
    docs = frame(list(enumerate(texts)))
    path = scratch_path(spark, "planes-test")
    planes.write_ids(docs, path)
    want, at = [], 0
    for i, x in enumerate(ids):
        want.append((i, at, len(x) + 1, zlib.crc32(np.array([*x, 0], dtype="<u4").tobytes())))
        at += len(x) + 1
    assert [tuple(r) for r in planes.read_documents(spark, path).orderBy("start").collect()] == want
    assert sorted(map(tuple, packing.token_counts(docs).collect())) == [(i, n) for i, _, n, _ in want]
