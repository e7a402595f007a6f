"""SimHash near-duplicates found through the anchors of a covering code.

Fingerprints are 64 bits. The anchors are the codewords of a direct sum of
perfect codes over disjoint bit blocks: every block word is within the block
code's covering radius of exactly one codeword, so every fingerprint has one
home anchor. A fingerprint is replicated to every anchor that lies within
covering radius plus threshold of it -- precisely, to the anchors that some
fingerprint at most ``max_bits`` away can have as home. Two fingerprints that
differ in at most ``max_bits`` bits therefore meet at the home anchor of
either one, and each pair is compared once, at the home of the smaller.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, free_name, materialize, pieces, utf8

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2

# Generator polynomials of perfect binary codes by block length
# (binary Golay code, Hamming code) and their covering radii.
GENERATORS = {23: 0b101011100011, 15: 0b10011}
RADIUS = {23: 3, 15: 1}

#: Bit blocks of the anchor code. Two Golay blocks have 2**24 anchors and
#: replicate a fingerprint 61 times on average for two bits; the bits outside
#: the blocks are left free. Three blocks have 2**35 anchors (165 replicas)
#: and keep the fingerprints per anchor few beyond about 2**28 of them.
TWO_BLOCKS = (23, 23)
THREE_BLOCKS = (23, 23, 15)
MANY = 1 << 28


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text: majority of the bits of its shingles' XXH64.

    A-Z are lower-cased, words are runs of characters other than space and
    \\x09-\\x0D, shingles are ``shingle_words`` consecutive words joined by a
    space (repeats count; fewer words: the whole sequence). A bit is 1 if it
    is set in over half of the hashes. No words: zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    k = shingle_words
    n = max(1, len(words) - k + 1)
    ones = np.zeros(64, dtype=np.int64)
    step = 1 << 16
    for i in range(0, n, step):
        part = words[i:min(n, i + step) + k - 1]
        if len(words) < k:
            part = [b" ".join(words)]
            grams = part
        else:
            grams = list(map(b" ".join, zip(*(part[j:] for j in range(k)))))
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(g, SEED) for g in grams), dtype="<u8", count=len(grams))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, text_hash, fp)`` for every row; ``fp`` is the fingerprint as a signed
    long, ``text_hash`` tells the texts of a repeated id apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch):
                fp = np.fromiter((fingerprint(t, shingle_words) for t in utf8(b.column(2))),
                                 dtype=np.uint64, count=b.num_rows).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)],
                                                 names=["doc_id", "text_hash", "fp"])

    text = F.col(text_col)
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                         text.alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


@cache
def _cosets(length: int, flips: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Tables of a perfect block code.

    The syndrome of each block word is looked up in the first table. For each
    syndrome, the other two hold the error patterns (block word xor codeword)
    of weight up to radius + flips as a ragged array: starts, then patterns,
    one pair for each number of flips that is needed to reach the codeword's
    cell.
    """
    g, r = GENERATORS[length], RADIUS[length]
    top = g.bit_length() - 1
    words = np.arange(1 << length, dtype=np.uint32)
    syndrome = words.copy()
    for bit in range(length - 1, top - 1, -1):
        syndrome ^= np.where((syndrome >> np.uint32(bit)) & np.uint32(1),
                             np.uint32(g << (bit - top)), np.uint32(0))
    starts, patterns = [], []
    for need in range(flips + 1):
        weights = range(r + 1) if need == 0 else [r + need]
        e = np.array([sum(1 << i for i in c) for w in weights for c in combinations(range(length), w)],
                     dtype=np.uint32)
        s = syndrome[e]
        order = np.argsort(s, kind="stable")
        starts.append(np.searchsorted(s[order], np.arange((1 << top) + 1)))
        patterns.append(e[order].astype(np.uint64))
    return syndrome, starts, patterns


def anchors(fp: np.ndarray, blocks: tuple[int, ...], flips: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, anchor)``: the anchors of each fingerprint.

    These are its home, within covering radius in every block, and the anchors
    that up to ``flips`` flipped bits can turn into the home.
    """
    rows = np.arange(len(fp))
    anchor = np.zeros(len(fp), dtype=np.uint64)
    spent = np.zeros(len(fp), dtype=np.int64)
    shift = 0
    for length in blocks:
        syndrome, starts, patterns = _cosets(length, flips)
        word = (fp[rows] >> np.uint64(shift)) & np.uint64((1 << length) - 1)
        s = syndrome[word.astype(np.int64)]
        parts = []
        for need in range(flips + 1):
            pick = np.flatnonzero(spent + need <= flips)
            first, n = starts[need][s[pick]], np.diff(starts[need])[s[pick]]
            src = np.repeat(pick, n)
            within = np.arange(len(src)) - np.repeat(np.cumsum(n) - n, n)
            code = word[src] ^ patterns[need][np.repeat(first, n) + within]
            parts.append((rows[src], anchor[src] | (code << np.uint64(shift)), spent[src] + need))
        rows, anchor, spent = (np.concatenate(x) for x in zip(*parts))
        shift += length
    return rows, anchor


def links(distinct: DataFrame, max_bits: int = MAX_BITS,
          blocks: tuple[int, ...] | None = None) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of distinct fingerprints at most ``max_bits`` apart.

    ``distinct`` has one column ``fp`` without repeats. Each pair comes once.
    Without ``blocks`` the anchor code follows the number of fingerprints,
    which changes costs only.
    """
    if blocks is None:
        blocks = TWO_BLOCKS if distinct.count() <= MANY else THREE_BLOCKS

    def placed(flips: int, name: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(0, batch.num_rows, 2048):
                    fp = batch.column(0).slice(i, 2048).to_numpy(zero_copy_only=False)
                    rows, anchor = anchors(fp.view(np.uint64), blocks, flips)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor.view(np.int64)), pa.array(fp[rows])], names=["anchor", name])

        return distinct.select("fp").mapInArrow(run, f"anchor bigint, {name} bigint")

    homes, replicas = placed(0, "a"), placed(max_bits, "b")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    # a merge join at any size: the planner takes the replicas, some 60 rows for each
    # that is read, for as many as are read, and would broadcast them
    return homes.join(replicas.hint("merge"), "anchor").where(near).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, text_hash, fp, component, component_id)`` for every row of ``docs``.

    Rows whose fingerprints differ in at most ``max_bits`` bits are linked;
    ``component`` is the smallest fingerprint reachable, ``component_id`` the
    smallest id. Rows of one fingerprint are
    represented by that fingerprint, so copies are never paired with each
    other, whatever their number. Null and empty texts have fingerprint zero
    and are linked like any other; repeated ids give repeated rows; null ids
    never name a component (a component of null ids only has id null). An
    empty table gives no rows.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, shingle_words), "simhash-fp")
    classes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-class")
    pairs = links(classes, max_bits)
    component = connected_components(pairs, "a", "b", "simhash-cc")
    linked = component.join(classes, component.node == classes.fp)
    smallest = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    linked = component.join(smallest, "component").select(F.col("node").alias("fp"), "component", "component_id")
    named = classes.join(linked, "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component"),
        F.when(F.col("component").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"))
    named = materialize(named, "simhash-named")
    return fps.join(named, "fp").select("doc_id", "text_hash", "fp", "component", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, all its columns.

    It is the row of the smallest id (null ids last), of its texts the one of
    the smallest hash; of rows equal in both, any one.
    """
    found = materialize(near_duplicates(docs, id_col, text_col, shingle_words, max_bits), "simhash-found")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("least")
    chosen = found.groupBy("component").agg(least)
    # a merge join at any size, whose partitions adaptive execution splits
    keys = materialize(chosen.select("least.doc_id", "least.text_hash"), "simhash-kept").hint("merge")
    own_id, own_hash = F.col(id_col).cast("bigint"), F.xxhash64(F.col(text_col))
    i, h = free_name(docs, "_ll_id"), free_name(docs, "_ll_hash")
    keyed = docs.withColumn(i, own_id).withColumn(h, own_hash)
    kept = keyed.join(keys, keyed[i].eqNullSafe(keys["doc_id"]) & (keyed[h] == keys["text_hash"]), "left_semi")
    repeats = found.groupBy("doc_id", "text_hash").count().where("count > 1").limit(1).count()
    if repeats:
        kept = kept.dropDuplicates([i, h])
    return kept.select(*docs.columns)
