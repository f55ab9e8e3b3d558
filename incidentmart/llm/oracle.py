"""DuckDB SQL for the operator queries that SQL can express, over whole tables."""

from .sharding import ROUNDS
from .words import stream

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIXING = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
         CAST('0x' || substr(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS u
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS n FROM d GROUP BY source
), w AS (
  SELECT *, 2 * n AS cap,
         CAST([3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS DOUBLE) AS weight
  FROM s
), o AS (
  SELECT *, cap / weight AS ratio,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM w
), l AS (
  SELECT min_by((b - used) / free, ratio) AS level
  FROM o, (SELECT 1.5 * sum(n) AS b FROM s) WHERE (b - used) / free <= ratio
), t AS (
  SELECT source, n, least(cap, weight * level) AS target,
         CASE WHEN n > 0 THEN floor(least(cap, weight * level) / n) ELSE 0 END AS whole
  FROM w, l
), k AS (
  SELECT source, u, sum(size) AS n FROM d GROUP BY source, u
), m AS (
  SELECT source, u, sum(n) OVER (PARTITION BY source ORDER BY u) - n + n / 2 AS middle FROM k
), c AS (
  SELECT t.source, max(m.u) AS cut FROM t JOIN m ON t.source IS NOT DISTINCT FROM m.source
  WHERE m.middle <= t.target - t.whole * t.n AND t.target > t.whole * t.n GROUP BY t.source
)
SELECT d.doc_id, d.size, CAST(t.n AS BIGINT) AS source_size, t.target,
       CAST((t.whole + CASE WHEN d.u <= c.cut THEN 1 ELSE 0 END) * d.size AS BIGINT) AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
LEFT JOIN c ON d.source IS NOT DISTINCT FROM c.source
"""

EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) AS place
  FROM d
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g
"""

SUBSTRING_DEDUP = rf"""
WITH w AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos
  FROM (SELECT doc_id, {_WORDS} AS words FROM documents)
), s AS (
  SELECT doc_id, pos, word,
         string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS win,
         count(*) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS full_len
  FROM w
), f AS (
  SELECT win, min(doc_id) AS first_doc FROM s WHERE full_len = 13 GROUP BY win HAVING min(doc_id) < max(doc_id)
), h AS (
  SELECT s.doc_id, s.pos FROM s JOIN f USING (win) WHERE s.full_len = 13 AND f.first_doc < s.doc_id
), r AS (
  SELECT w.doc_id, w.pos, w.word,
         coalesce(max(CASE WHEN h.pos IS NOT NULL THEN w.pos END)
           OVER (PARTITION BY w.doc_id ORDER BY w.pos ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) IS NOT NULL, false) AS gone
  FROM w LEFT JOIN h ON w.doc_id = h.doc_id AND w.pos = h.pos
), k AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone), '') AS kept
  FROM r GROUP BY doc_id
)
SELECT d.doc_id, coalesce(k.n_words, 0) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id
"""

_RULES = {
    "word_length": "100 * word_chars // greatest(n_words, 1)",
    "symbol_rate": "10000 * n_symbols // greatest(word_chars, 1)",
    "line_rate": "10000 * n_dup_lines // greatest(n_words, 1)",
    "repeat_rate": "10000 * n_repeat_words // greatest(n_words, 1)",
}
_SLACK = {"word_length": 50, "symbol_rate": 50, "line_rate": 50, "repeat_rate": 250}
_END = {"word_length": 1 << 40, "symbol_rate": 10_000, "line_rate": 10_000, "repeat_rate": 2_000}
_LONG = " UNION ALL ".join(
    f"SELECT lang, source, '{r}' AS rule, {_SLACK[r]} AS slack, {_END[r]} AS finish, {e} AS v FROM b WHERE NOT base_failed" for r, e in _RULES.items())
_INSIDE = " OR ".join(
    f"(f.rule = '{r}' AND ({e} > f.upper{' OR ' + e + ' < f.lower' if r == 'word_length' else ''}))" for r, e in _RULES.items())

QUALITY = rf"""
WITH t AS (
  SELECT doc_id, lang, source, {_WORDS} AS words, coalesce(text, '') AS body FROM documents
), win AS (
  SELECT doc_id, p, words[p:p + 4] AS five FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS p FROM t)
), rep AS (
  SELECT doc_id, p FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1
), cov AS (
  SELECT doc_id, count(DISTINCT w) AS n FROM (SELECT doc_id, unnest(range(p, p + 5)) AS w FROM rep) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT t.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM t LEFT JOIN cov ON t.doc_id = cov.doc_id LEFT JOIN lines ON t.doc_id = lines.doc_id
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
), x AS (
  SELECT lang, source, rule, slack, finish,
         CASE WHEN v < 64 THEN v ELSE (v >> (length(bin(v)) - 6)) << (length(bin(v)) - 6) END AS low
  FROM ({_LONG})
), q AS (
  SELECT lang, source, rule, slack, finish, quantile_disc(low, 0.1) AS q10, quantile_disc(low, 0.5) AS q50, quantile_disc(low, 0.9) AS q90
  FROM x GROUP BY ALL
), f AS (
  SELECT lang, source, rule, q50 - least(8 * greatest(q50 - q10, slack), 3 * (q50 - 100) // 4) AS lower,
         q50 + greatest(least(8 * greatest(q90 - q50, slack), 3 * (finish - q50) // 4), q50 // 32) AS upper FROM q
), bad AS (
  SELECT DISTINCT b.doc_id FROM b JOIN f ON b.lang IS NOT DISTINCT FROM f.lang AND b.source IS NOT DISTINCT FROM f.source
  WHERE {_INSIDE}
)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND bad.doc_id IS NULL AS kept
FROM b LEFT JOIN bad ON b.doc_id = bad.doc_id
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, {_ITEM_WORDS} AS words FROM documents
), i AS (
  SELECT item_id, words, least(len(words), 10) AS l FROM (SELECT item_id, {_ITEM_WORDS} AS words FROM benchmark) WHERE len(words) > 0
), iw AS (
  SELECT DISTINCT item_id, l, array_to_string(words[p:p + l - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(words) - l + 2)) AS p FROM i)
), dw AS (
  SELECT doc_id, p, l, array_to_string(words[p:p + l - 1], ' ') AS win
  FROM (SELECT doc_id, words, l, unnest(range(1, len(words) - l + 2)) AS p FROM d, (SELECT DISTINCT l FROM iw) WHERE len(words) >= l)
), h AS (
  SELECT doc_id, p, l, win FROM dw WHERE win IN (SELECT win FROM iw)
), c AS (
  SELECT doc_id, count(DISTINCT w) AS n FROM (SELECT doc_id, unnest(range(p, p + l)) AS w FROM h) GROUP BY doc_id
), m AS (
  SELECT DISTINCT h.doc_id, coalesce(CAST(iw.item_id AS VARCHAR), '') AS item FROM h JOIN iw ON h.win = iw.win
), g AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM m GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(g.n, 0) AS n_items,
       sha256(coalesce(g.items, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN g ON d.doc_id = g.doc_id
"""

_ROUNDS = 5


def _nearest(name: str, centroids: str) -> str:
    """Each vector's nearest centroid, the smaller number on ties."""
    return f"""{name} AS MATERIALIZED (
  SELECT row, arg_min(c, (far, c)) AS c, min(far) AS far
  FROM (SELECT l.row, m.c, sum((l.x - m.x) * (l.x - m.x)) AS far FROM l JOIN {centroids} m ON l.d = m.d GROUP BY l.row, m.c)
  GROUP BY row
)"""


def _move(r: int) -> str:
    """Round ``r``: assign, then move the centroids that have vectors to the floor of the mean."""
    return f"""{_nearest(f"a{r}", f"m{r}")}, m{r + 1} AS MATERIALIZED (
  SELECT m.c, m.d, coalesce(s.x, m.x) AS x FROM m{r} m
  LEFT JOIN (SELECT a.c, l.d, CAST((sum(l.x) - ((sum(l.x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
             FROM a{r} a JOIN l ON a.row = l.row GROUP BY a.c, l.d) s ON m.c = s.c AND m.d = s.d
)"""


CLUSTERING = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS xs
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), l AS MATERIALIZED (
  SELECT row, unnest(xs) AS x, unnest(range(64)) AS d FROM v
), m0 AS MATERIALIZED (
  SELECT c, unnest(xs) AS x, unnest(range(64)) AS d
  FROM (SELECT xs, row_number() OVER (ORDER BY sha256('2:' || vec_id), xs) - 1 AS c FROM v WHERE vec_id IS NOT NULL) WHERE c < 40
), {", ".join(_move(r) for r in range(_ROUNDS))}, {_nearest("a", f"m{_ROUNDS}")}, g AS (
  SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM m{_ROUNDS} GROUP BY c
)
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.far AS BIGINT) AS distance,
       CAST(sum(a.far) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.far) OVER () AS BIGINT) AS inertia, g.centroid_sha256
FROM a JOIN v ON a.row = v.row JOIN g ON a.c = g.c
"""

_M64 = "18446744073709551616::UHUGEINT"


def _shift_multiply(z: str, bits: int, factor: int) -> str:
    """``(z xor z >> bits) * factor`` in 64 bits; factor 1 leaves the product out."""
    mixed = f"xor({z}, {z} >> {bits})"
    return mixed if factor == 1 else f"CAST(({mixed}::UHUGEINT * {factor}::UHUGEINT) % {_M64} AS UBIGINT)"


def _feistel(of: str, keys: list[int]) -> str:
    """One pass of the network over ``of`` (columns row, x, n, half): the same columns with the new x."""
    q = f"SELECT row, n, half, x >> half AS l, x & ((1::UBIGINT << half) - 1) AS r FROM {of}"
    for k in keys:
        q = f"SELECT *, CAST((r::UHUGEINT + {k}::UHUGEINT) % {_M64} AS UBIGINT) AS z FROM ({q})"
        for bits, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            q = f"SELECT * REPLACE ({_shift_multiply('z', bits, factor)} AS z) FROM ({q})"
        q = f"SELECT row, n, half, r AS l, xor(l, z & ((1::UBIGINT << half) - 1)) AS r FROM ({q})"
    return f"SELECT row, (r << half) | l AS x, n, half FROM ({q})"


def _crc_of_byte(b: int) -> int:
    for _ in range(8):
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return b


# CRC-32 of the text's bytes, one table step a byte
_CRC32 = (
    "CAST(xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)), "
    f"lambda c, b: xor(c >> 8, {[_crc_of_byte(b) for b in range(256)]}[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS BIGINT)")

# the keys of the network for seed 17, and its walk: numbers of n or more are permuted again
SHARDING = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, {_CRC32} AS text_crc32 FROM documents
), o AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS row FROM d
), b AS (
  SELECT CAST(row AS UBIGINT) AS row, n, CAST(greatest(1, (length(bin(greatest(n - 1, 1))) + 1) // 2) AS INTEGER) AS half
  FROM o, (SELECT count(*) AS n FROM d)
), w AS (
  {_feistel("(SELECT *, row AS x FROM b)", [int(k) for k in stream(17, ROUNDS)])}
  UNION ALL
  {_feistel("(SELECT * FROM w WHERE x >= n)", [int(k) for k in stream(17, ROUNDS)])}
)
SELECT o.doc_id, o.size, o.text_crc32, 'rows' AS law, CAST(w.x % 8 AS INTEGER) AS shard, CAST(w.x // 8 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM o JOIN w ON o.row = w.row AND w.x < w.n
"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(h, {5 * i + 1}, 5) AS INTEGER) >> {s}) & 31) + 1, 1)"
    for i in range(8) for s in (15, 10, 5, 0))

WARC = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id < last THEN last END AS refers_to
FROM g
"""

# every pair of different texts that share a shingle, compared exactly; classes by reachability
JACCARD_JOIN = rf"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, words, CASE WHEN len(words) > 0 THEN dense_rank() OVER (ORDER BY words) END AS v
  FROM (SELECT doc_id, {_WORDS} AS words FROM documents)
), t AS MATERIALIZED (
  SELECT v, any_value(words) AS words, count(*) AS copies, min(doc_id) AS least FROM d WHERE v IS NOT NULL GROUP BY v
), s AS MATERIALIZED (
  SELECT DISTINCT v, array_to_string(words[p:p + 4], ' ') AS shingle FROM (SELECT v, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS p FROM t)
), n AS (
  SELECT v, count(*) AS n FROM s GROUP BY v
), i AS (
  SELECT a.v, b.v AS w, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.v <> b.v GROUP BY a.v, b.v
), e AS MATERIALIZED (
  SELECT i.v, i.w FROM i JOIN n a ON i.v = a.v JOIN n b ON i.w = b.v WHERE 5 * shared >= 4 * (a.n + b.n - shared)
), r AS (
  SELECT v, v AS w FROM t UNION SELECT r.v, e.w FROM r JOIN e ON r.w = e.v
), c AS (
  SELECT r.v, min(t.least) AS class_id FROM r JOIN t ON r.w = t.v GROUP BY r.v
), l AS (
  SELECT e.v, sum(t.copies) AS links FROM e JOIN t ON e.w = t.v GROUP BY e.v
)
SELECT d.doc_id, CASE WHEN d.v IS NULL THEN d.doc_id ELSE c.class_id END AS class_id,
       CAST(coalesce(t.copies - 1 + coalesce(l.links, 0), 0) AS BIGINT) AS n_links, d.v IS NULL OR d.doc_id = c.class_id AS kept
FROM d LEFT JOIN t ON d.v = t.v LEFT JOIN c ON d.v = c.v LEFT JOIN l ON d.v = l.v
"""

ORACLE = {
    "op2_mixing": MIXING,
    "op3_exact_dedup": EXACT_DEDUP,
    "op4_sharding": SHARDING,
    "op5_warc": WARC,
    "op6_substring_dedup": SUBSTRING_DEDUP,
    "op9_quality_rules": QUALITY,
    "op10_jaccard_join": JACCARD_JOIN,
    "op12_decontamination": DECONTAMINATION,
    "op13_clustering": CLUSTERING,
}
