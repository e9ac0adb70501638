"""Near copies of five-word similarity 0.8 or more, by multi-index hashing of SimHash fingerprints in short segments.

op9_simhash's contract fixes four words, 64 bits and four of them differing.  Two texts that share 0.8 of their
five-word shingles differ in about 15 of 100 bits, so here fingerprints have 128 bits; they are searched in four
segments of 16 bits, complete distances are verified, and then the texts themselves, shingle by shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_with_ids, scratch, stage
from .components import components
from .simhash import SHORT_RUN

#: Words of a shingle, and share of shingles that links.
WORDS, SIMILARITY = 5, 0.8

#: Differing bits within which texts are compared.  At similarity 0.8 they are 19.4 in the mean, with a deviation of
#: 4.1; at random 64, with 5.7.
BITS = 32

#: Segments of the first half and their bits.  Texts of similarity 0.8 meet in one of them with probability 0.96; a
#: table value has 17 of 2^16 of all fingerprints, so beyond some ten million texts wider ones pay.
SEGMENTS, WIDTH = 4, 16

#: Links a member up to which a run of equal values gives all of its links; what denser runs leave out is compared in blocks.
LINKS = 4

#: Bytes of text of a block, about: what a task holds while other texts pass by.
BLOCK = 1 << 20


def shingles(text: str | None, words: int = WORDS) -> set[bytes]:
    """The word runs of a text (fewer words: the whole sequence; none: nothing), A-Z in lower case."""
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def similarity(a: set[bytes], b: set[bytes]) -> float:
    """Shared shingles of all; two texts without words are alike."""
    return len(a & b) / len(a | b) if a or b else 1.0


def fingerprint(text: str | None, words: int = WORDS) -> tuple[int, int]:
    """The 128 bits, in two halves, that over half of the text's different shingles have set; zeros without words."""
    own = list(shingles(text, words))
    bits = np.zeros(128, np.int64)
    for at in range(0, len(own), 1 << 15):
        part = b"".join(map(xxhash.xxh3_128_digest, own[at : at + (1 << 15)]))
        bits += np.unpackbits(np.frombuffer(part, np.uint8).reshape(-1, 16), axis=1).sum(axis=0, dtype=np.int64)
    first, second = np.packbits(2 * bits > len(own)).view("<i8").tolist()
    return first, second


def fingerprints(docs: DataFrame, text_col: str = "text", words: int = WORDS) -> DataFrame:
    """docs with vx_fp and vx_more, the halves of their fingerprints, row by row."""
    names = [*docs.columns, "vx_fp", "vx_more"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", vx_fp long, vx_more long"
    at = docs.columns.index(text_col)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = np.array([fingerprint(x.as_py(), words) for x in batch.column(at)], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found[:, 0]), pa.array(found[:, 1])], names=names)

    return docs.mapInArrow(batches, schema)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of each of a and each of b."""
    return np.bitwise_count(a[:, None, 0] ^ b[None, :, 0]) + np.bitwise_count(a[:, None, 1] ^ b[None, :, 1])


def _sparse(fps: np.ndarray) -> np.ndarray | None:
    """Places of all links among fps (rows of two halves), or None if there are more than LINKS a member."""
    found, n = [np.zeros((0, 2), np.int64)], 0
    for a in range(0, len(fps), 256):
        for b in range(a, len(fps), 8192):
            i, j = np.nonzero(_distances(fps[a : a + 256], fps[b : b + 8192]) <= BITS)
            i, j = i + a, j + b
            i, j = i[i < j], j[i < j]
            n += len(i)
            if n > LINKS * len(fps):
                return None
            found.append(np.stack([i, j], axis=1))
    return np.concatenate(found)


def _dense(fps: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Places of links that connect what all links connect, and how many of those here each end has.

    The members of a group are linked to its hub, the one nearest to the group's majority of bits: what many near
    copies have in common is the text that they are copies of.  A member also keeps the link by which it was reached
    if that is shorter, or if the hub is too far from either end.  So a member is reached by two links at most in each
    run that it is in, never by all; remaining_links compares the other pairs.
    """
    left = np.arange(len(fps))
    while len(left):
        group, reached, todo, left = [left[:1]], [], [int(left[0])], left[1:]
        while todo and len(left):
            x = todo.pop()
            d = _distance(fps[left], fps[x])
            near = d <= BITS
            found = left[near]
            reached += zip([x] * len(found), found.tolist(), d[near].tolist(), strict=True)
            left = left[~near]
            group.append(found)
            todo += found.tolist()
        own = np.concatenate(group)
        if len(own) < 2:
            continue
        one = np.unpackbits(fps[own].view(np.uint8).reshape(len(own), 16), axis=1).sum(axis=0, dtype=np.int64)
        centre = np.packbits(2 * one > len(own)).view("<u8")
        hub = int(own[np.argmin(_distance(fps[own], centre))])
        to_hub = dict(zip(own.tolist(), _distance(fps[own], fps[hub]).tolist(), strict=True))
        star = [y for y, d in to_hub.items() if d <= BITS and y != hub]
        yield from ((hub, y, len(star), 1) for y in star)
        yield from ((x, y, 1, 1) for x, y, d in reached if (d < to_hub[y] or to_hub[x] > BITS) and hub not in (x, y))


def _links_of_runs(key: np.ndarray, fps: np.ndarray) -> Iterator[tuple[int, int, int, int, bool]]:
    """Places of links among fingerprints with equal keys, how many links each end has there, and if they are of a dense run; key is sorted.

    A dense run gives some of its links, which connect what all of them connect; all other runs give all.
    """
    cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
    length = np.diff(cuts)
    own = np.repeat(length, length)
    short = np.flatnonzero((own > 1) & (own <= SHORT_RUN))
    for d in range(1, SHORT_RUN):
        i = short[(own[short] > d) & (short + d < len(key))]
        i = i[key[i] == key[i + d]]
        i = i[_distance(fps[i], fps[i + d]) <= BITS]
        yield from ((x, x + d, 1, 1, False) for x in i.tolist())
    for k in np.flatnonzero(length > SHORT_RUN):
        run, at = fps[cuts[k] : cuts[k + 1]], int(cuts[k])
        links = _sparse(run)
        if links is None:
            yield from ((at + x, at + y, n, m, True) for x, y, n, m in _dense(run))
        elif len(links):
            n = np.bincount(links.ravel(), minlength=len(run))
            yield from ((at + x, at + y, int(n[x]), int(n[y]), False) for x, y in links.tolist())


def candidate_links(distinct: DataFrame, segments: int = SEGMENTS, width: int = WIDTH) -> DataFrame:
    """Pairs of fingerprints (hi, hi_more; lo, lo_more) within BITS bits that lie at most 2 bits apart in some segment.

    hi_n and lo_n are the most links that an end was seen with among rows of one table value; dense tells links of dense runs.

    Each fingerprint is entered into a table for each segment under the values at most 1 bit from its own (its
    Hamming ball): segments * (width + 1) short rows.  Balls meet just where segments differ in at most 2
    bits.  Complete distances are verified among rows of one value; a dense run, one with very many links, gives
    stars about the groups' hubs, which connect the same fingerprints, and remaining_links the pairs of these groups.
    """
    each = width + 1
    entered = distinct.select("vx_fp", "vx_more", F.explode(F.sequence(F.lit(0), F.lit(segments * each - 1))).alias("i")).select("vx_fp", "vx_more", F.expr(f"i div {each}").alias("seg"), F.expr(f"i % {each}").alias("bit"))
    value = F.expr(f"(shiftrightunsigned(vx_fp, cast(seg * {width} as int)) & {(1 << width) - 1}L) ^ if(bit = {width}, 0L, shiftleft(1L, bit)) | shiftleft(seg, {width})")
    entered = entered.select(value.cast("int").alias("key"), "vx_fp", "vx_more")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int, int, int], tuple[int, int, bool]] = {}  # links given out, with their ends' counts
        held: list[tuple[np.ndarray, np.ndarray]] = []  # rows of the value that the last batch ended in

        def edges(key: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            name, new = [tuple(x) for x in fps.view(np.int64).tolist()], {}
            for i, j, n, m, dense in _links_of_runs(key, fps):
                link, ends = (name[i] + name[j], (n, m, dense)) if name[i] > name[j] else (name[j] + name[i], (m, n, dense))
                if link not in seen or any(map(int.__gt__, ends, seen[link])):
                    seen[link] = new[link] = tuple(map(max, ends, seen.get(link, ends)))
            pairs = np.array([link + ends for link, ends in new.items()], np.int64).reshape(-1, 7)
            return pa.RecordBatch.from_arrays([*(pa.array(pairs[:, i]) for i in range(6)), pa.array(pairs[:, 6] > 0)], names=["hi", "hi_more", "lo", "lo_more", "hi_n", "lo_n", "dense"])

        for batch in it:
            key, fps = batch.column(0).to_numpy(), np.stack([batch.column(i).to_numpy().view(np.uint64) for i in (1, 2)], axis=1)
            if not len(key):
                continue
            start = int(np.searchsorted(key, key[-1]))
            if start == 0 and (not held or held[-1][0][-1] == key[0]):
                held.append((key, fps))
                continue
            yield edges(np.concatenate([*(k for k, _ in held), key[:start]]), np.concatenate([*(f for _, f in held), fps[:start]]))
            held = [(key[start:], fps[start:])]
        if held:
            yield edges(np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held]))

    return entered.repartition("key").sortWithinPartitions("key").mapInArrow(batches, "hi long, hi_more long, lo long, lo_more long, hi_n long, lo_n long, dense boolean").groupBy("hi", "hi_more", "lo", "lo_more").agg(*(F.max(c).alias(c) for c in ("hi_n", "lo_n", "dense")))


def verified(edges: DataFrame, texts: DataFrame, words: int, least: float) -> DataFrame:
    """Those of the edges (hi, lo) whose texts (node, text) are alike: shingle by shingle, in whole texts."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, of_last = None, set()
        for batch in it:
            keep = []
            for lo, a, b in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if lo != last:
                    last, of_last = lo, shingles(a.as_py(), words)
                keep.append(similarity(of_last, shingles(b.as_py(), words)) >= least)
            yield batch.filter(pa.array(keep, pa.bool_())).select(["hi", "lo"])

    of = lambda end, name: texts.select(F.col("node").alias(end), F.col("text").alias(name))
    pairs = edges.join(of("hi", "b"), "hi").join(of("lo", "a"), "lo").select("hi", "lo", "a", "b")
    return pairs.mapInArrow(batches, "hi long, lo long")


class _Block:
    """The texts of a block, as a table of the places that have each shingle."""

    def __init__(self, rows: list[tuple[int, int, set[bytes]]]):
        self.node, self.root, sets = zip(*rows, strict=True)
        self.size, self.groups = np.array([len(s) for s in sets], np.int64), np.array(self.root, np.int64)
        places: dict[bytes, list[int]] = {}
        for at, s in enumerate(sets):
            for x in s:
                places.setdefault(x, []).append(at)
        self.places = {x: np.array(p, np.int32) for x, p in places.items()}
        self.up: dict[int, int] = {}

    def _top(self, root: int) -> int:
        while root in self.up:
            root = self.up[root]
        return root

    def new_links(self, node: int, root: int, own: set[bytes], least: float) -> Iterator[tuple[int, int]]:
        """Links (hi, lo) of a text to texts of the block whose groups no link has united with its own yet."""
        met = [self.places[x] for x in own if x in self.places]
        shared = np.bincount(np.concatenate(met), minlength=len(self.size)) if met else np.zeros(len(self.size), np.int64)
        union = self.size + len(own) - shared
        alike = np.flatnonzero(((shared / np.maximum(union, 1) >= least) | (union == 0)) & (self.groups != root))
        for at in alike.tolist():
            one, other = self._top(root), self._top(self.root[at])
            if one != other:
                self.up[one] = other
                yield max(node, self.node[at]), min(node, self.node[at])


def remaining_links(dense: DataFrame, good: DataFrame, texts: DataFrame, words: int, least: float, block: int = BLOCK) -> DataFrame:
    """Verified links (hi, lo) among the nodes that dense runs connect, beyond `good`: together they connect what all their links connect.

    dense: links (hi, lo) of dense runs.  In each group that they connect, the texts that `good` doesn't link to its
    largest part are compared with all texts of the group, shingle by shingle, whatever their fingerprints.  Each pair
    of blocks of some `block` bytes is a key of its own, so that a large group is dealt out to many tasks, and a task holds
    one block; it gives only links that unite what was apart.
    """
    named = lambda df, name: df.select("node", F.col("root").alias(name))
    parts = named(components(dense), "group").join(named(components(good), "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    members = stage(parts.join(texts.select("node", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("bytes")), "node"))
    each = members.groupBy("group", "root").agg(F.sum("bytes").alias("bytes"))
    whole = each.groupBy("group").agg(F.max(F.struct("bytes", "root")).alias("main"), F.sum("bytes").alias("bytes"), F.count("*").alias("parts")).where("parts > 1")
    blocks = lambda b: F.greatest(F.lit(1), F.ceil(b / F.lit(block))).cast("long")
    whole = stage(whole.select("group", F.col("main.root").alias("main"), blocks(F.col("bytes") - F.col("main.bytes")).alias("few"), blocks(F.col("main.bytes")).alias("more")))
    # blocks 0 to few - 1 have the texts outside the largest part, the next ones that part; a pair has one of the first
    dealt = members.join(whole, "group").withColumn("at", F.expr("if(root = main, few + pmod(xxhash64(node), more), pmod(xxhash64(node), few))"))
    dealt = dealt.select("group", "node", "root", "at", "few", F.explode(F.expr("sequence(0L, few + more - 1)")).alias("mate"))
    dealt = dealt.where("least(at, mate) < few").select("group", F.least("at", "mate").alias("one"), F.greatest("at", "mate").alias("other"), F.expr("at > mate").alias("passes"), "node", "root")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, table = None, [], None

        def within() -> Iterator[tuple[int, int]]:
            """Links inside the block that is held, if its key is the pair of it with itself."""
            nonlocal table
            if held and table is None:
                table = _Block(held)
                if last[1] == last[2]:
                    for row in held:
                        yield from table.new_links(*row, least)

        for batch in it:
            found = []
            for group, one, other, passes, node, root, text in zip(*(c.to_pylist() for c in batch.columns[:6]), batch.column(6), strict=True):
                if (group, one, other) != last:
                    found += within()
                    last, held, table = (group, one, other), [], None
                row = (node, root, shingles(text.as_py(), words))
                if passes:
                    found += within()
                    if table:
                        found += table.new_links(*row, least)
                else:
                    held.append(row)
            yield pairs(found)
        yield pairs(list(within()))

    def pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
        both = np.array(found, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["hi", "lo"])

    dealt = dealt.join(texts, "node").select("group", "one", "other", "passes", "node", "root", "text")
    return dealt.repartition("group", "one", "other").sortWithinPartitions("group", "one", "other", "passes").mapInArrow(batches, "hi long, lo long")


def links(rows: DataFrame, nodes: DataFrame, words: int = WORDS, least: float = SIMILARITY, text_col: str = "text") -> DataFrame:
    """Verified links (hi, lo) among nodes, enough of them to connect every group.

    rows: vx_row, text_col.  nodes: vx_fp, vx_more, node (a row that stands for the fingerprint).  First each node is
    compared with that of its neighbours that has the most links, as a text has that others were copied from; then all
    pairs are compared whose groups those links leave apart.  So a large group costs about one comparison a member, and
    a pass over it in blocks for those that are not alike to its hub.
    """
    named = lambda end: nodes.select(F.col("vx_fp").alias(end), F.col("vx_more").alias(f"{end}_more"), F.col("node").alias(f"{end}_node"))
    pairs = candidate_links(nodes.select("vx_fp", "vx_more")).join(named("hi"), ["hi", "hi_more"]).join(named("lo"), ["lo", "lo_more"])
    up = F.col("hi_node") > F.col("lo_node")
    edges = stage(pairs.select(F.greatest("hi_node", "lo_node").alias("hi"), F.least("hi_node", "lo_node").alias("lo"), F.when(up, F.col("hi_n")).otherwise(F.col("lo_n")).alias("hi_n"), F.when(up, F.col("lo_n")).otherwise(F.col("hi_n")).alias("lo_n"), "dense"))
    ends = F.array(F.struct(F.col("hi").alias("u"), F.col("lo").alias("v"), F.col("lo_n").alias("n")), F.struct(F.col("lo").alias("u"), F.col("hi").alias("v"), F.col("hi_n").alias("n")))
    best = stage(edges.select(F.explode(ends).alias("e")).groupBy(F.col("e.u").alias("u")).agg(F.max(F.struct("e.n", "e.v")).alias("b")))
    texts = stage(rows.join(best.select(F.col("u").alias("vx_row")), "vx_row").select(F.col("vx_row").alias("node"), F.col(text_col).alias("text")))
    first = stage(best.select(F.greatest("u", "b.v").alias("hi"), F.least("u", "b.v").alias("lo")).distinct())
    good = stage(verified(first, texts, words, least))
    roots = stage(components(good))
    rest = edges.where("not dense").select("hi", "lo").join(first, ["hi", "lo"], "left_anti")
    for end in ("hi", "lo"):
        rest = rest.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")), end, "left")
    apart = rest.where("coalesce(hi_root, hi) != coalesce(lo_root, lo)").select("hi", "lo")
    more = remaining_links(edges.where("dense").select("hi", "lo"), good, texts, words, least)
    return stage(good.unionByName(verified(stage(apart), texts, words, least)).unionByName(more))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, least: float = SIMILARITY) -> DataFrame:
    """docs with one row of each group of near copies: the smallest id (null after all others), of equal ids the first row.

    A group is what links of at least `least` connect.  Null texts and texts without words are copies of each
    other.  Rows of equal fingerprints are one node, so exact copies cost nothing beyond the first.  Repeated rows are
    one group; an empty table gives no rows; columns may have any names but vx_row, vx_fp and vx_more.

    Rows meet their verdict in a sort-merge join whatever the size, so that a plan that is measured on a
    small table is the one that a large table gets.
    """
    spark = docs.sparkSession
    rows = stage(rows_with_ids(fingerprints(docs, text_col, words), "vx_row"))
    with scratch(spark) as kept:
        first = F.expr(f"min(struct(`{id_col}` is null, `{id_col}`, vx_row))").alias("first")
        nodes = stage(rows.groupBy("vx_fp", "vx_more").agg(F.min("vx_row").alias("node"), first))
        roots = stage(components(links(rows, nodes, words, least, text_col)))
        rooted = nodes.join(roots, "node", "left").groupBy(F.coalesce("root", "node")).agg(F.min("first").alias("first"))
        firsts = stage(rooted.select(F.col("first.vx_row").alias("vx_row")), kept)
    return rows.hint("merge").join(firsts, "vx_row", "left_semi").drop("vx_row", "vx_fp", "vx_more")
