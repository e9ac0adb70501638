"""Quality rules as a short-circuit cascade, ordered by rejection per cost."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Fixed values of the base metrics.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
RUN = 5


class Text:
    """One text and what has been found out about it, each part worked out once, when it is first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode("utf-8", "surrogatepass").split()  # of bytes: at exactly the six SPACES

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def n_dup_lines(self) -> int:
        if "\n" not in self.text:
            return 0
        lines = [x for x in self.text.split("\n") if x.strip(SPACES)]
        return len(lines) - len(set(lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return n_repeat_words(self)

    def measured(self) -> list[int]:
        return [getattr(self, m) for m in METRICS]


#: The base metrics, in the result's order.
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def n_repeat_words(t: Text) -> int:
    """Words inside runs of RUN words that the text has twice or more.

    Runs are told apart by exact numbers: a pair's number and the next word's give the longer run's number.
    """
    n = len(t.words)
    if n <= RUN:
        return 0
    ids: dict[bytes, int] = {}
    run = np.fromiter((ids.setdefault(w, len(ids)) for w in t.words), np.int64, n)
    last = run
    for i in range(1, RUN):
        run = run[:-1] * np.int64(len(ids)) + last[i:]
        _, run, seen = np.unique(run, return_inverse=True, return_counts=True)
        if seen.max() == 1:
            return 0
    hit = np.zeros(n, bool)
    starts = np.flatnonzero(seen[run] > 1)
    for i in range(RUN):
        hit[starts + i] = True
    return int(hit.sum())


@dataclass(frozen=True)
class Rule:
    """A text fails the rule if `fails` is true of it."""

    name: str
    fails: Callable[[Text], bool]


def _mean_word(t: Text) -> float:
    return t.word_chars / max(1, t.n_words)


def _tagged(t: Text) -> float:
    """Share of words that end in a run of marks, as the words of link farms and shouted texts do."""
    return sum(w[-1:] in b"#*$%&|!~^=" for w in t.words) / max(1, t.n_words)


def _stutter(t: Text) -> float:
    """Share of words that are the word before them."""
    return sum(map(bytes.__eq__, t.words, t.words[1:])) / max(1, t.n_words)


def _letters(t: Text) -> float:
    return sum(map(str.isalpha, t.text)) / max(1, t.word_chars)


def _shouted(t: Text) -> float:
    upper = sum(map(str.isupper, t.text))
    return upper / max(1, sum(map(str.isalpha, t.text)))


#: The verdict's own rules; a text is kept if none fails.
RULES = (
    Rule("mean_word_length", lambda t: not 2 <= _mean_word(t) <= 18),
    Rule("symbols", lambda t: t.n_symbols > 0.3 * max(1, t.n_words)),
    Rule("duplicate_lines", lambda t: t.n_dup_lines > 0.5 * (t.text.count("\n") + 1)),
    Rule("marked_words", lambda t: _tagged(t) > 0.5),
    Rule("stutter", lambda t: _stutter(t) > 0.3),
    Rule("letters", lambda t: _letters(t) < 0.3),
    Rule("shouting", lambda t: t.n_words >= 20 and _shouted(t) > 0.7),
)


def order_rules(rules: tuple[Rule, ...], texts: list[str | None]) -> list[Rule]:
    """The rules by rejections per second on the sample, most first.

    Each rule is timed on every text, on a Text of its own whose base metrics are there already, as they are
    when the cascade runs: so a rule costs what it adds, and none gets another's work for nothing.
    The order changes what the cascade costs, never which texts it keeps.
    """
    found = []
    for i, rule in enumerate(rules):
        ready = [Text(x) for x in texts]
        for t in ready:
            t.measured()
        began = time.perf_counter()
        rejected = sum(map(rule.fails, ready))
        found.append((-rejected / max(1e-9, time.perf_counter() - began), i, rule))
    return [rule for _, _, rule in sorted(found, key=lambda x: x[:2])]


def passes(rules: list[Rule], t: Text) -> bool:
    return not any(rule.fails(t) for rule in rules)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample: int = 200, least_words: int = 10, most_repeat: int = 20) -> DataFrame:
    """Base metrics of every whole text and the verdict of the cascade.

    About `sample` texts from all over the table, drawn by a hash of their ids, and 2 * sample at most, are taken to
    the driver to order the rules (what they cost and reject there sets nothing but the order).  Then each text is read once, row by row, with no shuffle.  The base test comes
    first, since its metrics are wanted of every text; the rules run only on texts that pass it, and stop
    at the first that fails.

    Result, a row for each input row: id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept.  Null text is empty: no words, so base_failed.  Repeated rows, null ids and an
    empty table need nothing special; other columns are ignored.
    """
    one_in = max(1, docs.select(id_col).count() // max(1, sample))
    drawn = docs.where(F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(one_in)) == 0).select(text_col).limit(2 * sample)
    texts = [r[0] for r in drawn.collect()]  # for timing only
    ordered = order_rules(rules, texts)
    fields = [docs.select(id_col).schema[0].dataType, *["long"] * 5, "boolean", "boolean"]
    names = [id_col, *METRICS, "base_failed", "kept"]
    schema = ", ".join(f"`{n}` {t if isinstance(t, str) else t.simpleString()}" for n, t in zip(names, fields, strict=True))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out: list[list] = [[] for _ in range(7)]
            for x in batch.column(1):
                t = Text(x.as_py())
                row = t.measured()
                failed = row[0] < least_words or 100 * row[4] > most_repeat * row[0]
                for column, value in zip(out, [*row, failed, not failed and passes(ordered, t)], strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in out[:5]], *[pa.array(c, pa.bool_()) for c in out[5:]]], names=names)

    return docs.select(id_col, text_col).mapInArrow(batches, schema)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))
