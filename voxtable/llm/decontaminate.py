"""Benchmark decontamination by a prefix-filtered set join, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, rows_with_ids, scratch, stage, table

#: Fixed value: what a word is, after A-Z are lower-cased; and what lies between words.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Words of a window, and of the shingles that windows and documents are joined on.
WINDOW, SHINGLE = 10, 3

#: Windows, and bytes of their words, that one pass over the documents looks for.
PASS_WINDOWS, PASS_BYTES = 250_000, 64 << 20


def words_of(text: Column) -> Column:
    """All words.  Cutting between words costs a quarter of extracting them; only the ends can be empty."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(ascii_lower(text))  # the same, sooner, for ASCII
    return F.array_remove(F.split(low, BETWEEN), "")


def shingle_key(q: int, word) -> Column:
    """A number for the q words that word(0), word(1), ... give."""
    return F.xxhash64(F.lit(q), *[word(i) for i in range(q)])


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(each distinct window once, its items).

    The first: wid, win (its words), len, key and off, the number and place of its rarest shingle.  A window must
    be contained whole, all of its shingles with it, so its necessary prefix in the order of rarity is one
    shingle: that which the fewest windows have, of equal ones the longest, then the first.  A window
    shorter than a shingle is one shingle.  The second: wid, item, a row for each item of a window.
    """
    words = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), words_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    starts = words.select("item", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))).alias("at"))
    of_items = stage(starts.select("item", F.slice("w", F.col("at") + 1, F.lit(window)).alias("win")).distinct())
    windows = stage(rows_with_ids(of_items.select("win").distinct(), "wid").withColumn("len", F.size("win")).withColumn("q", F.least(F.col("len"), F.lit(shingle))))
    token = F.expr("transform(sequence(0, len - q), i -> slice(win, i + 1, q))")
    shingles = windows.select("wid", "q", F.posexplode(token).alias("off", "token"))
    seen = shingles.groupBy("token").agg(F.count("*").alias("seen"))
    first = Window.partitionBy("wid").orderBy("seen", F.desc(F.length(F.array_join("token", " "))), "off")
    prefix = shingles.join(seen, "token").select("*", F.row_number().over(first).alias("nth")).where("nth = 1")
    key = F.when(F.col("q") < 0, F.lit(0).cast("long"))
    for q in range(1, shingle + 1):
        key = key.when(F.col("q") == q, shingle_key(q, lambda i: F.get("token", F.lit(i))))
    return stage(prefix.select("wid", "q", "off", key.alias("key")).join(windows.drop("q"), "wid")), stage(of_items.join(windows, "win").select("wid", "item"))


def marked(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...], text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """(documents: row, doc, text; those with a hit: row, n_hit, items).  doc is a struct of the columns in keep.

    1. Documents are numbered and written once, so that repeated rows and null ids keep their own results.
    2. Windows are ordered by their rarest shingle, which is all of them that documents are joined on: each
       place of a document meets the prefix shingles only, by number.
    3. A meeting gives a candidate start, bounded by position (the window's first word may not lie before
       the text) and by length (nor its last word behind it).
    4. A candidate is verified where it is: the document's words there are the words of a window.  It meets the
       windows by a number of all of its words, and then word for word, so windows that share their
       rarest shingle cost no more than others, and a hit is exact.

    The benchmark's windows are sent to the tasks, PASS_WINDOWS of them at most at once; more take
    another pass over the documents, with the same plan.  Places that only one shingle matches never leave their task.
    """
    spark, own = docs.sparkSession, text_col in keep
    texts = stage(rows_with_ids(docs.select(F.struct(*[F.col(c) for c in keep]).alias("doc"), *([] if own else [F.col(text_col).alias("text")])), "row"))
    texts = texts.withColumn("text", F.col("doc")[text_col]) if own else texts
    with scratch(spark) as kept:
        windows, items = item_windows(benchmark, item_col, item_text_col, window, shingle)
        n, held = windows.agg(F.count("*"), F.sum(F.octet_length(F.array_join("win", " ")))).first()
        passes = max(-(-n // PASS_WINDOWS), -(-(held or 0) // PASS_BYTES), 1)
        sizes = sorted(r.q for r in windows.select("q").distinct().collect())  # at most `shingle` values
        found = [_found(texts, windows.where(F.pmod("wid", F.lit(passes)) == i), sizes) for i in range(passes)]
        hits = found[0]
        for more in found[1:]:
            hits = hits.unionByName(more)
        before = F.max(F.col("start") + F.col("len")).over(Window.partitionBy("row").orderBy("start", "len", "wid").rowsBetween(Window.unboundedPreceding, -1))
        fresh = F.greatest(F.col("start") + F.col("len") - F.greatest("start", F.coalesce(before, F.lit(0))), F.lit(0))
        n_hit = hits.withColumn("fresh", fresh).groupBy("row").agg(F.sum("fresh").cast("long").alias("n_hit"))
        which = hits.select("row", "wid").distinct().join(items, "wid").groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
        result = stage(n_hit.join(which, "row"), kept)
    return texts, result


def _found(texts: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """row, start, len, wid of every occurrence of the windows."""
    # outer: of an inner one Spark infers a filter that cuts every text twice; wordless texts get no key
    at = texts.select("row", words_of(F.col("text")).alias("words")).select("row", "words", F.posexplode_outer("words").alias("pos", "word"))
    keys = [F.when(F.col("pos") + q <= F.size("words"), shingle_key(q, lambda i: F.get("words", F.col("pos") + i) if i else F.col("word"))) for q in sizes] or [F.lit(None).cast("long")]
    at = at.withColumn("key", F.explode(F.array(*keys)) if len(keys) > 1 else keys[0])
    prefix = windows.select("key", "off", "len").distinct()
    candidates = at.join(F.broadcast(prefix), "key").withColumn("start", F.col("pos") - F.col("off")).where("start >= 0 and start + len <= size(words)")
    there = candidates.select("row", "start", "len", F.slice("words", F.greatest(F.col("start") + 1, F.lit(1)), F.col("len")).alias("there")).withColumn("number", F.xxhash64("there"))
    return stage(there.join(F.broadcast(windows.select("wid", "win", F.xxhash64("win").alias("number"))), "number").where("there = win").select("row", "start", "len", "wid"))


def contaminated(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), **columns) -> DataFrame:
    """For each document the words inside any occurrence of an item's window, and the items that occur.

    Result, a row for each document row: the columns in keep, n_words, n_hit, n_items, items (sorted
    strings).  Null or wordless text: zeros.  A null item id is the item "null"; items with equal ids are
    one item.  An item of no words has no window.  Empty tables give no rows or no hits.  See marked().
    """
    texts, found = marked(docs, benchmark, keep, **columns)
    rows = texts.select("row", "doc", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    empty = F.expr("cast(array() as array<string>)")
    return rows.join(found, "row", "left").select("doc.*", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.size(F.coalesce("items", empty)).cast("long").alias("n_items"), F.coalesce("items", empty).alias("items"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """docs without the rows that hold any window of a benchmark item; all columns as they are.

    Null, empty and wordless texts hold none and stay; repeated rows stay or go together.
    """
    texts, found = marked(docs, benchmark, tuple(docs.columns), **columns)
    return texts.join(found.select("row"), "row", "left_anti").select("doc.*")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )
