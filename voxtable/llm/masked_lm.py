"""Masked pseudo-likelihood: a bidirectional window network that predicts every token from both sides."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, rows_with_ids, stage, table

#: Frequent words with an id of their own; other words share one of the rest of the ids by hash.
FREQUENT, CLASSES, MEMBERS = 3072, 64, 64
SIZE = CLASSES * MEMBERS
#: Words at most whose counts are sent to every task; the counts of all others are joined.
SENT = 100_000
WIDTH, SIDE = 16, 2
#: Places of a context, from that of its target.
OFFSETS = [*range(-SIDE, 0), *range(1, SIDE + 1)]
STEP, RATE = 8192, 0.25
CHUNK = 512
#: Tokens that one network learns from, and networks at most (beyond them each learns from more).
SHARD, MOST_SHARDS = 1 << 22, 1 << 14
#: Tokens that are made into positions at once.
PART = 1 << 18

SHAPES = {
    "embed": (SIZE + 1, WIDTH), "place": (2 * SIDE, WIDTH), "hidden": (WIDTH,), "class_w": (WIDTH, CLASSES), "class_b": (CLASSES,),
    "word_w": (CLASSES, WIDTH, MEMBERS), "word_b": (CLASSES, MEMBERS),
}
LENGTH = sum(int(np.prod(s)) for s in SHAPES.values())


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    """Named arrays that share flat's memory."""
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape)
        at += n
    return out


def initial(seed: int = 7) -> np.ndarray:
    flat = np.random.default_rng(seed).normal(0, 0.1, LENGTH).astype(np.float32)
    v = views(flat)
    v["place"][:] = 1
    for name in ("hidden", "class_b", "word_b"):
        v[name][:] = 0
    return flat


class Ids(dict):
    """Ids of words in lower case, as bytes; a hashed id takes less time anew than from a large dictionary."""

    def __init__(self, frequent: list[str]):
        super().__init__((w.encode(), i) for i, w in enumerate(frequent))
        self.base = len(frequent)

    def __missing__(self, w: bytes) -> int:
        return self.base + zlib.crc32(w) % (SIZE - self.base)

    def of(self, words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """Ids of all words; the words without an id of their own."""
        out = np.fromiter(map(self.get, words, repeat(-1)), np.int32, len(words))
        at = np.flatnonzero(out < 0)
        rare = [words[i] for i in at.tolist()]
        out[at] = self.base + np.fromiter(map(zlib.crc32, rare), np.int64, len(rare)) % max(SIZE - self.base, 1)
        return out, rare


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def encode(text: str | None, ids: Ids) -> np.ndarray:
    return ids.of(words_of((text or "").encode()))[0]


def _exp_and_sums(x: np.ndarray, safe: bool) -> tuple[np.ndarray, np.ndarray]:
    """exp of the logits, in place, and the sums of its rows; logits that may lie beyond +-60 are cut to it."""
    if not safe:
        np.clip(x, -60, 60, out=x)
    np.exp(x, out=x)
    return x, x @ np.ones(x.shape[1], np.float32)


class Network:
    """Learns and scores places of a line: ids of texts, each between SIDE places of the id SIZE."""

    def __init__(self, flat: np.ndarray):
        self.flat = flat
        self.p = views(flat)
        self.seen = np.full(LENGTH, 1e-6, np.float32)  # squared gradients
        self.s = views(self.seen)
        self.rooms: dict[str, np.ndarray] = {}

    def _room(self, name: str, rows: int, width: int) -> np.ndarray:
        """Memory that each step uses again: new pages for large arrays cost as much as what is done with them."""
        if name not in self.rooms or len(self.rooms[name]) < rows:
            self.rooms[name] = np.empty((rows, width), np.float32)
        return self.rooms[name][:rows]

    def _safe(self) -> bool:
        """Whether no logit can lie beyond +-60, hidden units being within +-1."""
        p = self.p
        most = lambda w, b: float((np.abs(p[w]).sum(axis=-2) + np.abs(p[b])).max())
        return max(most("class_w", "class_b"), most("word_w", "word_b")) < 60

    def _outputs(self, line: np.ndarray, at: np.ndarray) -> tuple:
        """What follows from the contexts of the ids at these (ascending) places, in order of the ids' classes."""
        p, n, safe, first = self.p, len(at), self._safe(), at[0]
        window = line[first - SIDE : at[-1] + SIDE + 1]
        near, m = np.take(p["embed"], window, axis=0, out=self._room("near", len(window), WIDTH), mode="clip"), len(window) - 2 * SIDE
        x, part = self._room("x", m, WIDTH), self._room("part", m, WIDTH)
        x[:] = p["hidden"]
        for j, o in enumerate(OFFSETS):
            x += np.multiply(near[SIDE + o : SIDE + o + m], p["place"][j], out=part)
        target = line[at]
        order = np.argsort(target.astype(np.uint16) if SIZE <= 1 << 16 else target, kind="stable")
        kind, member = np.divmod(target[order], MEMBERS)
        cuts, where = np.searchsorted(kind, np.arange(CLASSES + 1)).tolist(), at[order] - first
        h = self._room("h", n, WIDTH + 1)  # and a unit that is always 1, for the biases
        np.tanh(np.take(x, where, axis=0, out=self._room("own", n, WIDTH), mode="clip"), out=h[:, :WIDTH])
        h[:, WIDTH] = 1
        of_class = np.dot(h, np.vstack([p["class_w"], p["class_b"]]), out=self._room("class", n, CLASSES))
        of_word, weights = self._room("word", n, MEMBERS), np.concatenate([p["word_w"], p["word_b"][:, None]], axis=1)
        for c in range(CLASSES):
            if cuts[c] < cuts[c + 1]:
                np.dot(h[cuts[c] : cuts[c + 1]], weights[c], out=of_word[cuts[c] : cuts[c + 1]])
        return order, window, near, where, h, kind, member, cuts, _exp_and_sums(of_class, safe), _exp_and_sums(of_word, safe)

    def score(self, line: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-probabilities of the ids at these places."""
        order, *_, kind, member, _, (of_class, class_sum), (of_word, word_sum) = self._outputs(line, at)
        rows, out = np.arange(len(at)), np.empty(len(at), np.float32)
        out[order] = np.log(of_class[rows, kind] / class_sum) + np.log(of_word[rows, member] / word_sum)
        return out

    def step(self, line: np.ndarray, at: np.ndarray) -> None:
        """One step of adaptive gradient descent on the mean log-probability of the ids at these places."""
        p, n = self.p, len(at)
        _, window, near, where, h, kind, member, cuts, (dc, class_sum), (dw, word_sum) = self._outputs(line, at)
        rows, m = np.arange(n), len(window) - 2 * SIDE
        # gradients of the logits, but for a factor of each row that narrower arrays get instead
        dc[rows, kind] -= class_sum
        dw[rows, member] -= word_sum
        by_class, by_word = (1 / (n * class_sum))[:, None], (1 / (n * word_sum))[:, None]
        dh, part = np.dot(dc, p["class_w"].T, out=self._room("dh", n, WIDTH)), self._room("own", n, WIDTH)
        scaled = np.multiply(h, by_class, out=self._room("scaled", n, WIDTH + 1))
        gc, gw = scaled.T @ dc, np.zeros((CLASSES, WIDTH + 1, MEMBERS), np.float32)
        np.multiply(h, by_word, out=scaled)
        for c in range(CLASSES):
            if cuts[c] < cuts[c + 1]:
                own = slice(cuts[c], cuts[c + 1])
                np.dot(dw[own], p["word_w"][c].T, out=part[own])
                np.dot(scaled[own].T, dw[own], out=gw[c])
        dh *= by_class
        part *= by_word
        dh += part
        h = h[:, :WIDTH]
        np.multiply(h, h, out=part)
        dh *= np.subtract(1, part, out=part)
        dx, part, de = self._room("x", m, WIDTH), self._room("part", m, WIDTH), self._room("de", len(window), WIDTH)
        dx[:], de[:] = 0, 0
        dx[where] = dh
        place = np.empty(SHAPES["place"], np.float32)
        for j, o in enumerate(OFFSETS):  # summed for each place of the line before it goes to the place's id
            own = slice(SIDE + o, SIDE + o + m)
            de[own] += np.multiply(dx, p["place"][j], out=part)
            place[j] = np.einsum("nd,nd->d", dx, near[own])
        cells = (window.astype(np.intp)[:, None] * WIDTH + np.arange(WIDTH)).ravel()
        grads = {
            "class_w": gc[:WIDTH], "class_b": gc[WIDTH], "word_w": gw[:, :WIDTH], "word_b": gw[:, WIDTH], "hidden": np.ones(n, np.float32) @ dh, "place": place,
            "embed": np.bincount(cells, de.ravel(), (SIZE + 1) * WIDTH).reshape(-1, WIDTH),
        }
        for name, g in grads.items():
            self._move(name, g.astype(np.float32, copy=False))

    def forward(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probabilities of targets within contexts of their own."""
        return self.score(*apart(context, target))

    def learn(self, context: np.ndarray, target: np.ndarray) -> None:
        """A step on targets within contexts of their own."""
        self.step(*apart(context, target))

    def _move(self, name: str, g: np.ndarray) -> None:
        self.s[name][...] += g * g
        self.p[name][...] -= RATE * g / np.sqrt(self.s[name])


def lines(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids as one line (with SIDE times SIZE before, between and behind texts), the places of the texts' ids there and each one's text."""
    gap = np.full(SIDE, SIZE, np.int32)
    line = np.concatenate([gap, *(x for t in texts for x in (t, gap))]) if texts else gap
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    of = np.repeat(np.arange(len(texts)), lengths)
    return line, np.arange(lengths.sum()) + SIDE * (of + 1), of


def positions(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts (SIDE ids before, SIDE behind; SIZE beyond a text's ends), targets and each target's text."""
    line, at, of = lines(texts)
    return np.stack([line[at + o] for o in OFFSETS], axis=1) if len(at) else np.zeros((0, 2 * SIDE), np.int32), line[at], of


def apart(context: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A line of contexts with their targets in the middle, and the targets' places."""
    line = np.concatenate([context[:, :SIDE], target[:, None], context[:, SIDE:]], axis=1)
    return line.ravel(), np.arange(len(target)) * line.shape[1] + SIDE


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(w, n) for every word of all documents."""
    words = docs.select(F.explode(F.split(F.coalesce(text_col, F.lit("")), r"[\x20\x09-\x0D]+")).alias("w")).where("w != ''")
    # lower() is the faster of the two and the same for words of ASCII only
    words = words.select(F.when(F.octet_length("w") == F.char_length("w"), F.lower("w")).otherwise(F.translate("w", UPPER, LOWER)).alias("w"))
    return words.groupBy("w").agg(F.count("*").alias("n"))


def most_frequent(counts: DataFrame, n: int = FREQUENT) -> list[str]:
    return [r.w for r in counts.orderBy(F.desc("n"), "w").limit(n).collect()]


def frequent_words(docs: DataFrame, text_col: str = "text", n: int = FREQUENT) -> list[str]:
    """The n most frequent words of all documents, most first; of equally frequent ones the smaller first."""
    return most_frequent(word_counts(docs, text_col), n)


def own_logs(counts: DataFrame, frequent: list[str], sent: int = SENT) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of the largest counts, `sent` at most, but for those with an id of their own; log n of each; for each id the log of its hashed words' total."""
    base, left, least = len(frequent), sent, None
    for r in counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).collect():  # one row a count, not a word
        left -= r.words
        if left < 0:
            break
        least = r.n
    own = set(frequent)
    logs = {} if least is None else {r.w.encode(): float(np.log(r.n)) for r in counts.where(F.col("n") >= least).collect() if r.w not in own}
    totals = np.zeros(SIZE)
    rare = counts.where(~F.col("w").isin(frequent)) if frequent else counts
    for r in rare.groupBy((F.crc32(F.col("w").cast("binary")) % (SIZE - base)).alias("b")).agg(F.sum("n").alias("n")).collect():
        totals[base + r.b] = r.n
    return pa.array(list(logs), pa.binary()), np.fromiter(logs.values(), np.float64, len(logs)), np.log(np.maximum(totals, 1))


def shards_of(tokens: int) -> int:
    return max(1, min(MOST_SHARDS, round(tokens / SHARD)))


def train(docs: DataFrame, frequent: list[str], text_col: str = "text", id_col: str = "doc_id", shards: int = 1, start: np.ndarray | None = None) -> np.ndarray:
    """One pass over every token of all documents.

    Documents are dealt to `shards` networks, each of which learns from its own in one task, from the same start, in
    the order of a hash of id and text; the networks, rows of a table, are averaged by an aggregation,
    weighted with the tokens that each has seen.  So the result depends on the documents and not on how
    the table is divided or ordered; sums are of whole numbers, so that the order of adding changes nothing.
    The driver gets one network.
    """
    start = initial() if start is None else start

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, ids, seen, held, n = Network(start.copy()), Ids(frequent), 0, [], 0

        def learn() -> None:
            line, at, _ = lines(held)
            for i in range(0, len(at), STEP):
                net.step(line, at[i : i + STEP])
            held.clear()

        for batch in it:
            for x in batch.column(0).cast(pa.binary()):
                held.append(ids.of(words_of(x.as_py()))[0])
                n += len(held[-1])
                if n >= PART:  # counted over documents, never over batches
                    learn()
                    seen, n = seen + n, 0
        learn()
        seen += n
        if seen:
            chunks = [net.flat[i : i + CHUNK] for i in range(0, LENGTH, CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(chunks)), pa.int32()), pa.array([seen] * len(chunks), pa.int64()), pa.array(chunks, pa.list_(pa.float32()))], names=["chunk", "seen", "v"])

    order = F.xxhash64(F.col(id_col).cast("string"), text_col)
    dealt = docs.select(F.col(text_col).alias("t"), order.alias("h")).repartitionById(shards, F.pmod("h", F.lit(shards)).cast("int"))
    nets = dealt.sortWithinPartitions("h").select("t").mapInArrow(batches, "chunk int, seen long, v array<float>")
    whole = F.round(F.col("x").cast("double") * 2.0**24).cast("decimal(20, 0)") * F.col("seen").cast("decimal(17, 0)")
    mean = nets.select("chunk", "seen", F.posexplode("v").alias("i", "x")).groupBy("chunk", "i").agg((F.sum(whole).cast("double") / F.sum("seen") / 2.0**24).alias("x"))
    out = start.copy()
    for r in mean.collect():  # LENGTH rows
        out[r.chunk * CHUNK + r.i] = r.x
    return out


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sent: int = SENT) -> DataFrame:
    """For each document the sum of the log-probabilities of its tokens, each predicted from both sides.

    Tokens are words in lower case; all of every document are counted, learnt from and scored.  A word
    without an id of its own has the probability of its hashed id by context times its share of all tokens
    with that id by full counts; so each word of the corpus, however rare, has a probability of its own and
    those of all words sum to one.  The counts of the most frequent words are sent to the tasks, all others
    are joined: they are rare, so no key of that join is large.  Scores don't depend on how the table is divided.

    Result, a row for each input row: id_col, n_tokens, log_likelihood (0.0 without tokens), mean_log_prob
    (null without tokens).  Null text is empty.  Repeated rows get equal scores; an empty table gives no rows.
    """
    counts = stage(word_counts(docs, text_col))
    frequent = most_frequent(counts)
    tokens = counts.agg(F.sum("n")).first()[0] or 0
    flat = train(docs, frequent, text_col, id_col, shards_of(tokens))
    *own, log_totals = own_logs(counts, frequent, sent)
    known = docs.sparkSession.sparkContext.broadcast(own)  # of a bounded size
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, ids, (words, log_n) = Network(flat.copy()), Ids(frequent), known.value

        def scored(texts: list[np.ndarray], rare: list[bytes], of_rare: list[int]) -> tuple[np.ndarray, pa.Array]:
            """For each text its sum without the logs of words to be joined, and these words."""
            line, at, of = lines(texts)
            p = np.concatenate([net.score(line, at[i : i + STEP]) for i in range(0, len(at), STEP)] or [np.zeros(0)])
            sums, by = np.bincount(of, p - log_totals[line[at]], len(texts)), np.repeat(np.arange(len(texts)), np.array(of_rare, np.int64))
            rare = pa.array(rare, pa.binary())
            place = pc.fill_null(pc.index_in(rare, value_set=words), -1).to_numpy()
            here = place >= 0
            sums += np.bincount(by[here], log_n[place[here]], len(texts))
            ends = np.concatenate([[0], np.bincount(by[~here], minlength=len(texts)).cumsum()])
            return sums, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rare.filter(pa.array(~here)).cast(pa.string()))

        for batch in it:
            texts, rare, of_rare, counts, parts, n = [], [], [], [], [], 0
            for x in batch.column(1).cast(pa.binary()):
                found, rest = ids.of(words_of(x.as_py()))
                texts.append(found)
                rare += rest
                of_rare.append(len(rest))
                counts.append(len(found))
                n += len(found)
                if n >= PART:
                    parts.append(scored(texts, rare, of_rare))
                    texts, rare, of_rare, n = [], [], [], 0
            parts.append(scored(texts, rare, of_rare))
            sums, joined = zip(*parts, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(np.concatenate(sums)), pa.concat_arrays(joined)], names=[id_col, "n_tokens", "vx_sum", "vx_words"])

    rows = stage(rows_with_ids(docs.select(id_col, text_col).mapInArrow(batches, f"`{id_col}` {kind}, n_tokens long, vx_sum double, vx_words array<string>")))
    # a word that occurs once has a log of zero and needs no join
    rest = rows.select("vx_row", F.explode("vx_words").alias("w")).join(counts.where("n > 1").hint("shuffle_hash"), "w")
    # summed as whole numbers: the order of the rows changes nothing, so that repeated rows get equal scores
    rest = rest.groupBy("vx_row").agg((F.sum(F.round(F.log("n") * 2.0**32).cast("long")) / 2.0**32).alias("vx_rest"))
    total = F.col("vx_sum") + F.coalesce("vx_rest", F.lit(0.0))
    found = rows.drop("vx_words").hint("merge").join(rest, "vx_row", "left")
    return found.select(id_col, "n_tokens", total.alias("log_likelihood"), F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_prob"))


def op5_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(table(spark, sf_dir, "documents"))
