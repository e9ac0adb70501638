"""Packing token pieces into fixed-length sequences: dominance reduction, then best fit."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, table

TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
CAPACITY, END = 2048, 0

#: Texts of these characters only are cut into words here; the tokenizer's own classes for them are settled.
#: Other texts go to the tokenizer whole.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
BLANKS = "\\x09-\\x0d\\x20\x85\xa0"
PLAIN = re.compile(r"[\x00-ɏ‐-‧‰-⁞₠-₵]*")
WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{BLANKS}{LETTERS}{NUMBERS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
)


class Encoder:
    """Token ids of whole texts, exactly as a plain call of the tokenizer file gives them.

    Texts that hold one of its special tokens, or characters beyond the settled ones, go through it whole.
    In all others words repeat, so a word's ids are kept (up to `words` of them, then afresh); a new word goes through
    the same vocabulary as ranks, which is fast on single words.
    """

    def __init__(self, tokenizer: str, ranks: str, words: int = 1_000_000):
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as f:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.word = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=merges, special_tokens={})._encode_single_piece
        self.known: dict[str, list[int]] = {}
        self.words = words

    def __call__(self, text: str | None) -> np.ndarray:
        """Ids of the text, then END; null: END alone."""
        if not text:
            return np.array([END], "<u4")
        if not PLAIN.fullmatch(text) or any(x in text for x in self.special):
            return np.array([*self.whole.encode(text, add_special_tokens=False).ids, END], "<u4")
        out: list[int] = []
        known = self.known
        for w in WORDS.findall(text):
            try:
                out += known[w]
            except KeyError:
                if len(known) >= self.words:
                    known.clear()
                known[w] = ids = self.word(w.encode())
                out += ids
        out.append(END)
        return np.array(out, "<u4")


def pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, ranks: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every document's pieces of at most `capacity` ids, numbered within (part, length).

    Only a longer document is cut, into pieces of `capacity` ids; what is over is its first piece.
    """
    names = [id_col, "piece", "start", "length", "ids_crc32", "part", "nth", *(["ids"] if with_ids else [])]
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long" + ", ids array<int>" * with_ids

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = Encoder(tokenizer, ranks), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in it:
            rows: list[tuple] = []
            source: list[int] = []
            for i, x in enumerate(batch.column(1)):
                ids = encode(x.as_py())
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    source.append(i)
                    rows.append((k, a, b - a, zlib.crc32(ids[a:b].tobytes()), part, int(seen[b - a]), *([ids[a:b].astype(np.int32)] if with_ids else [])))
                    seen[b - a] += 1
            columns = list(zip(*rows, strict=True)) or [[] for _ in names[1:]]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(source, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, types, strict=False)]], names=names)

    return docs.select(id_col, text_col).mapInArrow(batches, schema)


Groups = list[tuple[list[tuple[int, int]], int]]  # ([(size, how many of it in a sequence)], how many such sequences)


def reduce_dominated(counts: list[int], capacity: int) -> Groups:
    """Fix, and take out of counts, small sets that dominate every other way to fill a sequence with their largest item.

    With j the largest item left and R the room beside it, a set dominates another if the other's items can
    be shared out among its own, each share no larger than the item it goes to.  So
    - j stands alone if nothing fits beside it;
    - j and k dominate if k fills R exactly, or if no two others fit (k the largest that fits), or if no three
      fit and the best two together are no larger than k.
    Items of one size are dealt with together.
    """
    fixed: Groups = []
    for s in range(capacity, 0, -1):
        while counts[s]:
            room = capacity - s
            counts[s] -= 1  # j itself
            sizes = [x for x in range(1, room + 1) if counts[x]] if room else []
            low: list[int] = []
            for x in sizes:
                low += [x] * min(3 - len(low), counts[x])
                if len(low) == 3:
                    break
            counts[s] += 1
            if not sizes:
                n = counts[s] if s > room else 1
                fixed.append(([(s, 1)], n))
                counts[s] -= n
                continue
            k = sizes[-1]
            two = len(low) > 1 and low[0] + low[1] <= room
            three = len(low) > 2 and sum(low) <= room
            if k != room and two and (three or _best_pair(sizes, counts, room, s) > k):
                break
            if k == s:
                n = counts[s] // 2
                fixed.append(([(s, 2)], n))
                counts[s] -= 2 * n
            else:
                n = min(counts[s], counts[k])
                if k != room:
                    n = max(1, n - 4)  # while more than three of both are left, nothing that was asked above changes
                fixed.append(([(s, 1), (k, 1)], n))
                counts[s] -= n
                counts[k] -= n
    return fixed


def _best_pair(sizes: list[int], counts: list[int], room: int, s: int) -> int:
    best, i, j = 0, 0, len(sizes) - 1
    while i <= j:
        pair = sizes[i] + sizes[j]
        if pair > room:
            j -= 1
        else:
            if i < j or counts[sizes[i]] - (sizes[i] == s) > 1:
                best = max(best, pair)
            i += 1
    return best


def best_fit(counts: list[int], capacity: int) -> Groups:
    """Best fit, largest first, of the sizes that counts holds; sequences with equal contents are one group.

    An item goes where the least room is left that it fits.  All items of a size are placed group by group,
    so the work depends on the capacity and not on the number of items.
    """
    open_: list[list] = [[] for _ in range(capacity + 1)]  # by room left
    for s in range(capacity, 0, -1):
        n, counts[s] = counts[s], 0
        room = s
        while n:
            while room < capacity and not open_[room]:
                room += 1
            if room < capacity:
                inside, bins = open_[room].pop()
            else:
                inside, bins = [], n
            each = room // s
            full = min(bins, n // each)
            if full:
                open_[room - each * s].append(([*inside, (s, each)], full))
                n -= full * each
            if full < bins and n and n < each:
                open_[room - n * s].append(([*inside, (s, n)], 1))
                full, n = full + 1, 0
            if full < bins and inside:
                open_[room].append((inside, bins - full))
    return [g for groups in open_ for g in groups]


def pack_counts(counts: list[int], capacity: int = CAPACITY) -> Groups:
    """Sequences for counts[s] items of each size s: the dominant sets, then best fit of the rest."""
    left = list(counts)
    return reduce_dominated(left, capacity) + best_fit(left, capacity)


def slots(groups: Groups) -> dict[int, tuple[np.ndarray, ...]]:
    """For each size, runs of its items by number: first item, items a sequence, first sequence, offset."""
    taken: dict[int, int] = {}
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for inside, bins in groups:
        offset = 0
        for s, each in inside:
            first = taken.get(s, 0)
            runs.setdefault(s, []).append((first, each, sequence, offset))
            taken[s] = first + each * bins
            offset += s * each
        sequence += bins
    return {s: tuple(np.array(x, np.int64).T) for s, x in runs.items()}


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, ranks: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pack all documents, as token pieces, into as few sequences of `capacity` ids as the method finds.

    1. Texts are tokenized where they lie; the pieces (not the texts) are written, each numbered among the
       pieces of its length in its partition.
    2. How many pieces there are of each length, at most `capacity` numbers, is all that the driver gets.
       It fixes dominant sets, then packs the rest by best fit, for whole groups of equal sequences at once.
    3. A piece's number among all of its length (its partition's start plus its own) tells its sequence and
       offset.  A length that a third of all pieces have is just a large count; nothing is gathered by length.

    Result, a row for each piece: id_col, piece, start, length, ids_crc32, sequence_id, offset, and ids if
    asked for.  Null or empty text is one END id.  Repeated rows and null ids are documents like any other;
    an empty table gives no rows.  tokenizer and ranks are paths of the same vocabulary in two forms.
    """
    import public_tokenizers

    tokenizer, ranks = tokenizer or public_tokenizers.path(TOKENIZER), ranks or public_tokenizers.path(RANKS)
    cut = stage(pieces(docs, id_col, text_col, tokenizer, ranks, capacity, with_ids))
    by_part = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = [0] * (capacity + 1)
    for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[r.length] = r.n
    where = slots(pack_counts(counts, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    numbered = cut.hint("merge").join(starts, ["part", "length"]).withColumn("nth", F.col("nth") + F.col("before")).drop("part", "before")
    out = [id_col, "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.select(*out).schema) + ", sequence_id long, `offset` long"

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            length, nth = (batch.column(c).to_numpy() for c in ("length", "nth"))
            sequence, offset = np.zeros(len(nth), np.int64), np.zeros(len(nth), np.int64)
            order = np.argsort(length, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if not len(own):
                    continue
                s = int(length[own[0]])
                first, each, base, at = where[s]
                run = np.searchsorted(first, nth[own], "right") - 1
                bin_, k = np.divmod(nth[own] - first[run], each[run])
                sequence[own], offset[own] = base[run] + bin_, at[run] + k * s
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in out], pa.array(sequence), pa.array(offset)], names=[*out, "sequence_id", "offset"])

    return numbered.select(*out, "nth").mapInArrow(place, schema)


def op3_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
