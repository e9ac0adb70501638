"""Secret spans and multipart credential linking, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import rows_with_ids, stage, table

#: The base kinds in their order, each with its pattern.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MIN = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
BASE = ("assign", "access", "hex")

#: Weak candidates: each is reported only beside its complement.
IDENTIFIER = r"""(?i)(?:user(?:name)?|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@+/_.-]{3,}"""
MATERIAL = r"[A-Za-z0-9+/]{32,}={0,2}"
ENDPOINT = r"(?i)(?:https?|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]{3,}|(?i)(?:host|endpoint)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.:-]{3,}"
WEAK = (("weak_id", "id", IDENTIFIER), ("weak_secret", "secret", MATERIAL), ("endpoint", "endpoint", ENDPOINT))

#: Code points that parts of one credential may lie apart.
SCOPE = 300

#: Matches that are folded into an array at once.
CHUNK = 128

SPAN = "struct<start:int,rank:int,end:int,kind:string>"


def bound(value: Column, use) -> Column:
    """use(value), with value worked out once however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def in_chunks(items: Column, size: int = CHUNK) -> Column:
    """An array cut into arrays of `size`: a fold that appends copies what it has, so it runs over short arrays only."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.size(items), F.lit(1)) - 1) / size).cast("int")), lambda c: F.slice(items, c * size + 1, F.lit(size)))


def chunk_states(chunks: Column, zero: Column, step) -> Column:
    """step(state, chunk) run over the chunks from zero: the state before each chunk, and the last one."""
    return F.aggregate(chunks, F.array(zero), lambda acc, c: F.concat(acc, F.array(step(F.element_at(acc, -1), c))))


def spans_of(text: Column, pattern: str, kind: str, rank: int, keep=None) -> Column:
    """All leftmost non-overlapping matches as structs; `keep` tests a match's text.

    The pieces between the matches and the matches themselves give the places, in code points.  Work grows
    with the matches: chunk by chunk, each starting where the lengths of those before it end.
    """
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = bound(hits, lambda h: F.arrays_zip(F.transform(F.slice(pieces, 1, F.size(h)), F.length).alias("gap"), h.alias("hit")))

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))
        more = F.concat(acc["out"], F.array(span))
        return F.struct(end.alias("at"), (F.when(keep(x["hit"]), more).otherwise(acc["out"]) if keep else more).alias("out"))

    none = F.expr(f"cast(array() as array<{SPAN}>)")
    of_chunk = lambda z: F.aggregate(z["chunk"], F.struct(z["at"].alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    starts = lambda chunks: chunk_states(chunks, F.lit(0), lambda at, c: at + F.aggregate(c, F.lit(0), lambda n, x: n + x["gap"] + F.length(x["hit"])))
    found = bound(bound(pairs, lambda p: in_chunks(p)), lambda chunks: F.flatten(F.transform(F.arrays_zip(chunks.alias("chunk"), F.slice(starts(chunks), F.lit(1), F.size(chunks)).alias("at")), of_chunk)))
    return F.when(text.rlike(pattern), found).otherwise(none)


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def cells(start: str, end: str, scope: int, out: str = "cell") -> Column:
    return F.explode(F.expr(f"sequence(({start}) div {scope}, ({end}) div {scope})")).alias(out)


def linked_weak(rows: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak spans that overlap no base span and have a complement within `scope` code points, a list for each row.

    rows: row, parts (array of start, end, rank, part, weak kind or null).  Identifiers and endpoints complete a
    secret and a secret completes them.  Both interval joins are equi-joins on (row, cell): a part lies in
    all cells that it touches, and a candidate looks into those within the scope; they are an anti and a semi
    join, so that no pairs are made.
    """
    part = rows.select("row", F.explode("parts").alias("p")).select("row", "p.*")
    base = part.where("kind is null")
    covered = base.select(F.col("row").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"), cells("start", "end - 1", scope, "c"))
    clear = part.where("kind is not null").select("*", cells("start", "end - 1", scope))
    hidden = clear.join(covered, F.expr("row = r and cell = c and s < end and start < e"), "left_semi").select("row", "start", "end", "kind").distinct()
    weak = stage(part.where("kind is not null").join(hidden, ["row", "start", "end", "kind"], "left_anti").select(*part.columns))
    near = base.unionByName(weak).select(F.col("row").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"), F.col("part").alias("other"), cells("start", "end", scope, "c"))
    beside = F.expr(f"row = r and cell = c and (part = 'secret') != (other = 'secret') and s - end <= {scope} and start - e <= {scope} and (e <= start or end <= s)")
    found = weak.select("*", cells(f"greatest(start - {scope}, 0)", f"end + {scope}", scope)).join(near, beside, "left_semi")
    return found.groupBy("row").agg(F.collect_set(F.struct("start", "rank", "end", "kind")).alias("weak"))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE, keep: tuple[str, ...] = ()) -> DataFrame:
    """Base secrets of every whole text, and the weak parts of credentials that lie beside their complement.

    Result, a row for each input row: id_col, the columns named in keep, assign, access, hex (base spans),
    weak (linked parts) - arrays of (start, rank, end, kind), in code points, end exclusive.

    A text is read once, row by row, with no shuffle; its spans are written, and only rows with a weak
    part and its complement go through the interval join.  Rows are told apart by a number, so repeated
    rows and null ids keep their own results and no key is hot.  Null text is empty: no spans.  A weak part
    that overlaps a base span is not a candidate.  Columns in keep may have any name but id_col's.  Spans with equal starts go by kind in the listed order.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    group2 = lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= ASSIGN_MIN
    weak_text = [(kind, part, spans_of(F.col("vx_text"), pattern, kind, len(BASE) + i)) for i, (kind, part, pattern) in enumerate(WEAK)]
    rows = docs.select(F.col(id_col).alias("vx_id"), *[F.col(c).alias(f"keep_{c}") for c in keep], text.alias("vx_text"))
    base = rows.select(
        "*",
        spans_of(F.col("vx_text"), ASSIGN, "assign", 0, group2).alias("assign"),
        spans_of(F.col("vx_text"), ACCESS, "access", 1).alias("access"),
        spans_of(F.col("vx_text"), HEX, "hex", 2).alias("hex"),
        *[x.alias(kind) for kind, _, x in weak_text],
    )
    as_part = lambda spans, part, weak: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank"), F.lit(part).alias("part"), (s["kind"] if weak else F.lit(None).cast("string")).alias("kind")))
    parts = F.concat(
        as_part(F.col("assign"), "secret", False),
        as_part(F.col("access"), "id", False),
        as_part(F.col("hex"), "secret", False),
        *[as_part(F.col(kind), part, True) for kind, part, _ in WEAK],
    )
    found = F.when(F.size("weak_id") + F.size("weak_secret") + F.size("endpoint") > 0, parts)
    both = F.exists("parts", lambda p: p["part"] == "secret") & F.exists("parts", lambda p: p["part"] != "secret") & F.exists("parts", lambda p: p["kind"].isNotNull())
    done = stage(
        rows_with_ids(base.withColumn("parts", found), "row")
        .withColumn("parts", F.when(both, F.col("parts")))
        .select("row", "vx_id", *[f"keep_{c}" for c in keep], "assign", "access", "hex", "parts")
    )
    weak = stage(linked_weak(done.where("parts is not null").select("row", "parts"), scope))
    return done.drop("parts").join(weak, "row", "left").select(
        F.col("vx_id").alias(id_col), *[F.col(f"keep_{c}").alias(c) for c in keep], "assign", "access", "hex", F.coalesce("weak", F.expr(f"cast(array() as array<{SPAN}>)")).alias("weak")
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with the spans, merged where they overlap, replaced by a mark.

    Chunk by chunk: a chunk of spans cuts up only the piece of text from the greatest end before it to its own.
    """
    ends = lambda chunks: chunk_states(chunks, F.lit(0), lambda at, c: F.greatest(at, F.array_max(F.transform(c, lambda s: s["end"]))))

    def of_chunk(z):
        base, piece = z["at"], F.substring(text, z["at"] + 1, z["to"] - z["at"])

        def step(acc, s):
            new = F.concat(acc["out"], F.array(F.substring(acc["piece"], acc["at"] - base + 1, s["start"] - acc["at"]), F.lit(mark)))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["piece"].alias("piece"), F.when(s["start"] >= acc["at"], new).otherwise(acc["out"]).alias("out"))

        return F.aggregate(z["chunk"], F.struct(base.alias("at"), piece.alias("piece"), F.expr("cast(array() as array<string>)").alias("out")), step, lambda acc: F.array_join(acc["out"], ""))

    def cut(z):
        last = F.element_at(z["ends"], -1)
        parts = F.arrays_zip(z["chunks"].alias("chunk"), F.slice(z["ends"], F.lit(1), F.size(z["chunks"])).alias("at"), F.slice(z["ends"], F.lit(2), F.size(z["chunks"])).alias("to"))
        return F.concat(F.array_join(F.transform(parts, of_chunk), ""), F.substring(text, last + 1, F.length(text) - last))

    with_ends = bound(in_chunks(F.array_sort(spans)), lambda chunks: F.struct(chunks.alias("chunks"), ends(chunks).alias("ends")))
    return F.when(F.size(spans) > 0, bound(with_ends, cut)).otherwise(text)


def without_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """docs with every span, base and linked, replaced by a mark in text_col; length_col, if there, follows.

    Texts without secrets, and null, stay as they are.
    """
    spans = secret_spans(docs, id_col, text_col, keep=tuple(c for c in docs.columns if c != id_col))
    found = F.concat("assign", "access", "hex", "weak")
    text = redacted(F.col(text_col), found)
    changed = {text_col: text} | ({length_col: F.when(F.size(found) > 0, F.length(text)).otherwise(F.col(length_col)).cast(docs.schema[length_col].dataType)} if length_col in docs.columns else {})
    return spans.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])


def op6_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.concat("assign", "access", "hex")
    return secret_spans(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.size("assign").cast("long").alias("n_assign"),
        F.size("access").cast("long").alias("n_access"),
        F.size("hex").cast("long").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.concat(base, F.col("weak"))).alias("spans"),
    )
