"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_broadcast, rows_with_ids, scratch, stage, table
from .components import components

#: Words of a shingle, seed of its hash, differing bits that still link.
WORDS, SEED, BITS = 4, 42, 4

#: A half of 32 bits that so many fingerprints have is hot: the table values about it are divided by a second segment.
HOT = 128

#: Runs of equal keys up to this long are compared all at once, longer ones by search from member to member.
SHORT_RUN = 8


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64 bits that over half of the shingles' hashes have set; 0 without words."""
    w = (text or "").encode().lower().split()  # bytes: only A-Z change, only the six ASCII spaces part words
    if not w:
        return 0
    if len(w) <= words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(w), SEED)]
    else:
        line = b" ".join(w)
        ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
        starts = [0, *ends[:-words].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)]
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], "<u8")
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "vx_fp") -> DataFrame:
    """docs with a long column of fingerprints, row by row."""
    names = [*docs.columns, out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{out}` long"
    at = docs.columns.index(text_col)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = np.array([fingerprint(x.as_py()) for x in batch.column(at)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=names)

    return docs.mapInArrow(batches, schema)


def _linked(fps: np.ndarray, bits: int) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of the links among fps, by search; each step compares one member to all not yet reached."""
    left = fps[1:]
    todo = [fps[0]]
    while True:
        while todo and len(left):
            x = todo.pop()
            near = np.bitwise_count(left ^ x) <= bits
            if near.any():
                found = left[near]
                left = left[~near]
                todo += list(found)
                for y in found.tolist():
                    yield int(x), y
        if not len(left):
            return
        todo, left = [left[0]], left[1:]


def _edges_of_runs(key: np.ndarray, fp: np.ndarray, bits: int, divided: bool) -> Iterator[tuple[int, int]]:
    """Links among fingerprints with equal keys; key is sorted."""
    cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
    length = np.diff(cuts)
    own = np.repeat(length, length)
    short = np.flatnonzero((own > 1) & (own <= SHORT_RUN))
    for d in range(1, SHORT_RUN):
        i = short[(own[short] > d) & (short + d < len(key))]
        i = i[key[i] == key[i + d]]
        i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= bits]
        yield from zip(fp[i].tolist(), fp[i + d].tolist(), strict=True)
    low = np.uint64(0xFFFFFFFF)
    for k in np.flatnonzero(length > SHORT_RUN):
        run, value = fp[cuts[k] : cuts[k + 1]], key[cuts[k]]
        if divided:
            yield from _linked(run, bits)
            continue
        half = run >> np.uint64(32) if value >> np.uint64(32) else run & low
        if half.min() == half.max() and half[0] != value & low:
            continue  # they all meet again under their own value
        yield from _linked(run, bits)


def _whole(key: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Fingerprints from table values and what was entered beside them."""
    half, width = np.uint64(0xFFFFFFFF), np.uint64(32)
    bit = rest >> width
    own = (key & half) ^ np.where(bit == width, np.uint64(0), np.uint64(1) << (bit & np.uint64(31)))
    other = rest & half
    return np.where(key >> width == 0, other << width | own, own << width | other)


class _Forest:
    """Union of what one task has linked, so that it sends a spanning forest and not every link."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = y
        return x


def links(distinct: DataFrame, bits: int = BITS, fp: str = "vx_fp") -> DataFrame:
    """Edges (hi, lo) that connect all fingerprints with at most `bits` <= 4 differing bits.

    Of two such fingerprints one half of 32 bits differs in at most 2.  Each fingerprint is entered into a
    table for each half under all 33 values at most 1 bit from its own (its Hamming ball); two balls meet
    just when the halves differ in at most 2 bits.  So 66 short rows a fingerprint find every link.  Rows
    of a table value are sorted next to each other; each pair's full distance is verified there, or, where
    many share a value, searched from member to member, so that what is made is a forest and never all pairs.

    A table value can only be long if a half about it is hot, that is, HOT fingerprints have it.  Rows of
    such values are divided further, so that no task holds them all: of a link's other halves, at most 4
    bits apart, one quarter of 16 bits differs in at most 2, and balls of 1 bit about the quarters meet.
    """
    low, high = F.col(fp).bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(fp, 32)
    first, bit = F.col("i") < 33, F.expr("i % 33")  # bit 32: none is flipped
    flip = F.expr("case when i % 33 = 32 then 0L else shiftleft(1L, cast(i % 33 as int)) end")
    own = F.when(first, low).otherwise(high.bitwiseOR(F.lit(1 << 32)))
    entered = distinct.select(fp, F.explode(F.sequence(F.lit(0), F.lit(65))).alias("i"))
    # the other half and the flipped bit are the rest of the fingerprint: short numbers, which compress well
    rest = F.when(first, high).otherwise(low).bitwiseOR(F.shiftleft(bit.cast("long"), 32))
    table_rows = entered.select(own.bitwiseXOR(flip).alias("key"), rest.alias("rest"))

    halves = distinct.select(F.explode(F.array(low, high.bitwiseOR(F.lit(1 << 32)))).alias("own")).groupBy("own").agg(F.count("*").alias("n")).where(F.col("n") >= HOT)
    hot = stage(halves.select(F.explode(F.expr("transform(sequence(0, 32), i -> own ^ if(i = 32, 0L, shiftleft(1L, i)))")).alias("key")).distinct())
    if hot.isEmpty():
        return _searched(table_rows, bits, False)
    hot = bounded_broadcast(hot)
    whole = entered.select(own.bitwiseXOR(flip).alias("key"), F.when(first, high).otherwise(low).alias("other"), fp).join(hot, "key")
    second = whole.select("*", F.explode(F.sequence(F.lit(0), F.lit(33))).alias("j"))
    quarter = F.expr("(shiftrightunsigned(other, 16 * cast(j div 17 as int)) & 65535L) ^ if(j % 17 = 16, 0L, shiftleft(1L, j % 17))")
    divided = second.select(F.xxhash64("key", F.expr("j div 17"), quarter).alias("key"), F.col(fp).alias("rest"))
    return _searched(table_rows.join(hot, "key", "left_anti"), bits, False).unionByName(_searched(divided, bits, True))


def _searched(entered: DataFrame, bits: int, divided: bool) -> DataFrame:
    """Edges (hi, lo) among rows (key, rest) of equal keys; rest is the rest of the fingerprint, if divided all of it."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest()
        held: list[tuple[np.ndarray, np.ndarray]] = []  # rows of the value that the last batch ended in

        def edges(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            new = [(a, b) for a, b in _edges_of_runs(key, fp, bits, divided) if forest.join(a, b)]
            pairs = np.array(new, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs.max(axis=1)), pa.array(pairs.min(axis=1))], names=["hi", "lo"])

        for batch in it:
            raw, rest = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if not len(raw):
                continue
            key = raw.view(np.uint64)
            fp = rest if divided else _whole(key, rest)
            start = int(np.searchsorted(raw, raw[-1]))
            if start == 0 and (not held or held[-1][0][-1] == key[0]):
                held.append((key, fp))
                continue
            yield edges(np.concatenate([*(k for k, _ in held), key[:start]]), np.concatenate([*(f for _, f in held), fp[:start]]))
            held = [(key[start:], fp[start:])]
        if held:
            yield edges(np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held]))

    return entered.repartition("key").sortWithinPartitions("key").mapInArrow(batches, "hi long, lo long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """docs with vx_row, vx_fp (fingerprint) and vx_component: the smallest id that a row is linked to.

    Equal fingerprints are one node whatever their number, so exact copies cost nothing beyond the first.
    Rows without words, or with null text, have fingerprint zero and are linked like any other.  Null ids
    are passed over when the smallest is taken; a group of null ids only has a null component.  Repeated
    rows are told apart by vx_row.  An empty table gives no rows.  Columns may have any names but vx_row and vx_fp.
    """
    rows = stage(rows_with_ids(fingerprints(docs, text_col), "vx_row"))
    return rows.join(component_of(rows, id_col, bits).drop("vx_root"), "vx_fp")


def component_of(rows: DataFrame, id_col: str, bits: int = BITS) -> DataFrame:
    """vx_fp, vx_root (a fingerprint of its group) and vx_component for every fingerprint of rows."""
    with scratch(rows.sparkSession) as kept:
        nodes = stage(rows.groupBy("vx_fp").agg(F.min(id_col).alias("least")))
        roots = stage(components(stage(links(nodes.select("vx_fp"), bits))))
        rooted = stage(nodes.join(roots, nodes.vx_fp == roots.node, "left").select("vx_fp", "least", F.coalesce("root", "vx_fp").alias("root")))
        smallest = stage(rooted.groupBy("root").agg(F.min("least").alias("vx_component")))
        return stage(rooted.join(smallest, "root").select("vx_fp", F.col("root").alias("vx_root"), "vx_component"), kept)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("vx_fp")), 16, "0").alias("fingerprint"), F.col("vx_component").alias("component_id"))
