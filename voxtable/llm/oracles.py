"""DuckDB texts of the queries that SQL can express.

Fingerprints (XXH64), token ids, page trees and trained models are beyond it; tests hold those against
plain versions.
"""

from __future__ import annotations

from .quality_rules import RULES
from .secrets import ACCESS, ASSIGN, ASSIGN_MIN, HEX, SCOPE, WEAK

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP2 = f"""
WITH items AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM benchmark),
wins AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + 10], ' ') AS win FROM items, LATERAL (SELECT unnest(range(greatest(len(w) - 9, 1))) AS i) WHERE len(w) > 0),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
places AS (SELECT r, n, w, unnest(range(len(w) - n + 1)) AS i FROM docs, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n),
hits AS (SELECT places.r, places.i, places.n, wins.item FROM places JOIN wins ON wins.n = places.n AND wins.win = array_to_string(places.w[places.i + 1 : places.i + places.n], ' ')),
cover AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
which AS (SELECT r, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS ids FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN cover USING (r) LEFT JOIN which USING (r)"""

OP4 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), g AS (SELECT h, max(page_id) AS first FROM p WHERE strlen(h) >= 1000 GROUP BY h)
SELECT page_id, strlen(p.h)::BIGINT AS payload_bytes, sha1(p.h) AS payload_digest, CASE WHEN first != page_id OR (first IS NOT NULL AND page_id IS NULL) THEN 'revisit' ELSE 'response' END AS record_type,
CASE WHEN first != page_id OR (first IS NOT NULL AND page_id IS NULL) THEN first END AS refers_to FROM p LEFT JOIN g ON g.h = p.h"""


def _sql(pattern: str) -> str:
    return pattern.replace("'", "''")


def _spans(kind: str, rank: int, part: str, pattern: str, keep: str = "true") -> str:
    p = _sql(pattern)
    return f"""SELECT r, '{kind}' AS kind, {rank} AS rank, '{part}' AS part, a - length(m) AS a, a AS b FROM (
SELECT r, m, sum(length(g) + length(m)) OVER (PARTITION BY r ORDER BY i) AS a FROM (SELECT r, unnest(regexp_extract_all(t, '{p}')) AS m, unnest(string_split_regex(t, '{p}')[1 : len(regexp_extract_all(t, '{p}'))]) AS g, unnest(range(len(regexp_extract_all(t, '{p}')))) AS i FROM docs WHERE regexp_matches(t, '{p}'))) WHERE {keep}"""


OP6 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
base AS ({_spans("assign", 0, "secret", ASSIGN, f"length(regexp_extract(m, '{_sql(ASSIGN)}', 2)) >= {ASSIGN_MIN}")} UNION ALL {_spans("access", 1, "id", ACCESS)} UNION ALL {_spans("hex", 2, "secret", HEX)}),
weak AS (SELECT * FROM ({" UNION ALL ".join(_spans(kind, 3 + i, part, pattern) for i, (kind, part, pattern) in enumerate(WEAK))}) w WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = w.r AND b.a < w.b AND w.a < b.b)),
parts AS (FROM base UNION ALL FROM weak),
linked AS (SELECT * FROM weak w WHERE EXISTS (SELECT 1 FROM parts p WHERE p.r = w.r AND (p.part = 'secret') != (w.part = 'secret') AND p.a - w.b <= {SCOPE} AND w.a - p.b <= {SCOPE} AND (p.b <= w.a OR w.b <= p.a))),
n AS (SELECT r, count(*) FILTER (WHERE rank = 0) AS x, count(*) FILTER (WHERE rank = 1) AS y, count(*) FILTER (WHERE rank = 2) AS z, string_agg(kind || ':' || a::BIGINT || ':' || b::BIGINT, ',' ORDER BY a, rank) AS s FROM base GROUP BY r),
every AS (SELECT r, string_agg(kind || ':' || a::BIGINT || ':' || b::BIGINT, ',' ORDER BY a, rank) AS s FROM (FROM base UNION ALL FROM linked) GROUP BY r)
SELECT doc_id, coalesce(x, 0)::BIGINT AS n_assign, coalesce(y, 0)::BIGINT AS n_access, coalesce(z, 0)::BIGINT AS n_hex, sha256(coalesce(n.s, '')) AS base_sha256, coalesce(every.s, '') AS spans
FROM docs LEFT JOIN n USING (r) LEFT JOIN every USING (r)"""

#: The verdict's rules, by name, as conditions on which a text fails.
_FAILS = {
    "mean_word_length": "NOT chars / greatest(1, n) BETWEEN 2 AND 18",
    "symbols": "sym > 0.3::DOUBLE * greatest(1, n)",
    "duplicate_lines": r"dup > 0.5::DOUBLE * (len(string_split(t, chr(10))))",
    "marked_words": r"len(list_filter(w, lambda x: regexp_matches(x, '[#*$%&|!~^=]$'))) / greatest(1, n) > 0.5",
    "stutter": "len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) / greatest(1, n) > 0.3::DOUBLE",
    "letters": r"length(regexp_replace(t, '\P{L}', '', 'g')) / greatest(1, chars) < 0.3::DOUBLE",
    "shouting": r"n >= 20 AND length(regexp_replace(t, '\P{Lu}', '', 'g')) / greatest(1, length(regexp_replace(t, '\P{L}', '', 'g'))) > 0.7::DOUBLE",
}
assert list(_FAILS) == [r.name for r in RULES]

OP7 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
runs AS (SELECT r, i, array_to_string(w[i + 1 : i + 5], ' ') AS run FROM (SELECT r, w, unnest(range(len(w) - 4)) AS i FROM docs WHERE len(w) >= 5)),
twice AS (SELECT r, run FROM runs GROUP BY ALL HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT p) AS rep FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM runs JOIN twice USING (r, run)) GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT x) AS dup FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM docs) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT doc_id, t, w, len(w) AS n, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS sym, coalesce(dup, 0) AS dup, coalesce(rep, 0) AS rep FROM docs LEFT JOIN rep USING (r) LEFT JOIN lines USING (r))
SELECT doc_id, n::BIGINT AS n_words, chars::BIGINT AS word_chars, sym::BIGINT AS n_symbols, dup::BIGINT AS n_dup_lines, rep::BIGINT AS n_repeat_words, n < 10 OR 100 * rep > 20 * n AS base_failed,
NOT (n < 10 OR 100 * rep > 20 * n OR {" OR ".join(f"({x})" for x in _FAILS.values())}) AS kept FROM m"""

#: The table of the CRC-32 polynomial, made by its rule: eight steps for each byte.
_TABLE = "(SELECT list(c ORDER BY b) AS crc FROM (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) AS c FROM (SELECT unnest(range(256)) AS b)))"

OP10 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
sums AS (SELECT r, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::BIGINT)), lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]))) AS crc32 FROM docs, {_TABLE}),
sized AS (SELECT *, strlen(t)::BIGINT + 1 AS size FROM docs),
line AS (SELECT *, sum(size) OVER (ORDER BY r) AS upto, sum(size) OVER () AS total FROM sized),
cut AS (SELECT *, least(15, ((2 * upto - size) * 16) // (2 * total))::INT AS shard FROM line)
SELECT doc_id, size, crc32::BIGINT AS text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY r) - 1 AS slot, NULL::INT AS grown_shard FROM cut JOIN sums USING (r)"""

ORACLES = {
    "op2_decontaminate": OP2, "op4_warc_round_trip": OP4, "op6_secret_spans": OP6, "op7_quality_rules": OP7, "op10_byte_shards": OP10,
}
