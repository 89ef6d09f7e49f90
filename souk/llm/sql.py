"""DuckDB statements that must return the same rows as the queries of the same name."""

from __future__ import annotations

from souk.llm.url_filter import BLOCKED_PATTERNS

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP3 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS n,
         array_to_string(list_slice(ws, s, s + least(10, len(ws)) - 1), ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS s FROM b WHERE len(ws) > 0)
),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, n, s, array_to_string(list_slice(ws, s, s + n - 1), ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM d, sizes WHERE len(ws) >= n)
),
found AS (SELECT g.doc_id, g.s, g.n, win.item_id FROM grams g JOIN win ON win.w = g.w AND win.n = g.n),
hits AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS pos FROM found) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP4 = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY sha) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha AS text_sha256
FROM t WINDOW w AS (PARTITION BY sha ORDER BY points DESC, doc_id)
"""

_OP7 = rf"""
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
rules(verdict, h, r) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
  SELECT page_id, max_by(h || r, length(h || r)) AS rule, max_by(verdict, length(h || r)) AS verdict
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, r)
  GROUP BY page_id
)
SELECT p.page_id, host, path, rule,
       coalesce(fits.verdict, CASE WHEN list_has_any(string_split_regex(host || path, '[./]'),
         ['adserver', 'casino', 'doubleclick', 'poker', 'porn', 'torrent', 'warez', 'xxx'])
           OR regexp_matches(host || path, '{"|".join(f"(?:{r})" for _, r, _ in BLOCKED_PATTERNS)}')
         THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fits USING (page_id)
"""

_OP2 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS n FROM pages
),
g AS (SELECT body, max(page_id) AS holder FROM p WHERE n >= 1000 GROUP BY body)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(p.body) AS payload_digest,
       CASE WHEN page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> holder THEN holder END AS refers_to
FROM p LEFT JOIN g ON p.body = g.body AND n >= 1000
"""

_OP11_MERGED = "list_slice(list_sort(list_distinct(list_concat({0}, {1}))), 1, 128)"
_OP11_BOTH = f"len(list_intersect(list_intersect({{0}}, {{1}}), {_OP11_MERGED}))"
_OP11_NEAR = f"""CASE WHEN len({{0}}) + len({{1}}) = 0 THEN 1.0
  ELSE CAST({_OP11_BOTH} AS DOUBLE) / greatest(len({_OP11_MERGED}), 1) END"""
_OP11 = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
ids AS (SELECT doc_id, min(sha256(text)) AS sha FROM t GROUP BY doc_id),
nx AS (
  SELECT doc_id, coalesce(lead(s) OVER w, first_value(s) OVER w) AS nxt
  FROM (SELECT doc_id, struct_pack(id := doc_id, sha := sha) AS s FROM ids) WINDOW w AS (
    ORDER BY doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
),
e AS (
  SELECT row_number() OVER () AS r, t.doc_id, t.text, n.text AS next_text,
         left(t.text, length(t.text) - length(t.text) // 2) || left(n.text, length(t.text) // 2) AS edited
  FROM t JOIN nx ON t.doc_id IS NOT DISTINCT FROM nx.doc_id
  JOIN (SELECT DISTINCT doc_id, text, sha256(text) AS sha FROM t) n
    ON n.doc_id IS NOT DISTINCT FROM nx.nxt.id AND n.sha = nx.nxt.sha
),
w AS (
  SELECT r, k, {_WORDS} AS ws
  FROM (SELECT r, 'own' AS k, text FROM e UNION ALL SELECT r, 'other', edited FROM e UNION ALL SELECT r, 'after', next_text FROM e)
),
wd AS (SELECT r, k, len(ws) AS n, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM w),
sh AS (
  SELECT DISTINCT r, k, substr(md5(concat_ws(' ', x, a, b, c, d)), 1, 16) AS h
  FROM (SELECT *, lead(x, 1) OVER o AS a, lead(x, 2) OVER o AS b, lead(x, 3) OVER o AS c, lead(x, 4) OVER o AS d
        FROM wd WINDOW o AS (PARTITION BY r, k ORDER BY p)) WHERE p <= greatest(n - 4, 1)
),
found AS (
  SELECT r, list_slice(list(h ORDER BY h) FILTER (k = 'own'), 1, 128) AS own,
         list_slice(list(h ORDER BY h) FILTER (k = 'other'), 1, 128) AS other,
         list_slice(list(h ORDER BY h) FILTER (k = 'after'), 1, 128) AS after
  FROM sh GROUP BY r
),
s AS (SELECT r, coalesce(own, []) AS own, coalesce(other, []) AS other, coalesce(after, []) AS after FROM e LEFT JOIN found USING (r))
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
       array_to_string(own, '') AS fingerprint, array_to_string(other, '') AS edited_fingerprint,
       {_OP11_NEAR.format("own", "other")} AS near_edited, {_OP11_NEAR.format("own", "after")} AS near_next,
       CASE WHEN len(own) < 128 THEN CAST(len(own) AS DOUBLE)
            ELSE CAST(127 * 4503599627370496 AS DOUBLE) / (CAST(('0x' || substr(own[128], 1, 13)) AS BIGINT) + 1.0::DOUBLE) END AS n_shingles,
       CASE WHEN len(own) = 0 THEN 1.0 ELSE coalesce(CAST({_OP11_BOTH.format("own", "other")} AS DOUBLE)
            / nullif(len(list_intersect(own, {_OP11_MERGED.format("own", "other")})), 0), 0.0) END AS in_edited
FROM e JOIN s USING (r)
"""

#: The CRC-32 polynomial (reflected) and its start.
_CRC32 = """xor(4294967295, list_reduce([4294967295] || list_transform(string_split({0}, ''), lambda c: CAST(ord(c) AS BIGINT)),
  lambda crc, b: list_reduce([xor(crc, b)] || range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


def _framed(*fields: str) -> str:
    """Digest of the fields, each '-' if null, else its bytes' count, a colon and the value."""
    parts = [f"coalesce(CAST(octet_length(encode({f})) AS VARCHAR) || ':' || {f}, '-')" for f in fields]
    return f"sha256({' || '.join(parts)})"


_OP12_FIELDS = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars")]
# Every row climbs its tree by itself: one step of the recursion joins it with its run of nodes.
_OP12_CLIMB = """
{0}(row_id, tree, level, pos, h, folded, proof) AS (
  SELECT * FROM {1}
  UNION ALL
  SELECT row_id, tree, level + 1, pos // 3, sha256(array_to_string(run, '')),
         sha256(array_to_string(list_slice(run, 1, nth - 1) || [folded] || list_slice(run, nth + 1, len(run)), '')),
         proof || array_to_string(list_slice(run, 1, nth - 1) || list_slice(run, nth + 1, len(run)), '')
  FROM (SELECT row_id, tree, level, pos, folded, proof, CAST(pos % 3 + 1 AS BIGINT) AS nth,
               list_transform(list_sort(list(DISTINCT {{'p': pos, 'h': h}}) OVER (PARTITION BY tree, pos // 3)), lambda x: x.h) AS run,
               max(pos) OVER (PARTITION BY tree) AS most
        FROM {0})
  WHERE most > 0
)"""
_OP12 = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row_id, doc_id, source,
         {_framed(*_OP12_FIELDS, "text")} AS leaf,
         CASE WHEN {_CRC32.format("CAST(doc_id AS VARCHAR)")} % 2 = 0 AND text IS NOT NULL
              THEN {_framed(*_OP12_FIELDS, "replace(text, chr(10), '')")} END AS other
  FROM documents
),
start AS (
  SELECT row_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, 0 AS level,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         leaf AS h, coalesce(other, leaf) AS folded, '' AS proof
  FROM d
),
{_OP12_CLIMB.format("climb", "start")},
ends AS (
  SELECT row_id, any_value(tree) AS tree, arg_max(h, level) AS subroot, arg_max(folded, level) AS folded,
         arg_max(proof, level) AS proof
  FROM climb GROUP BY row_id
),
top_start AS (SELECT row_id, CAST(0 AS BIGINT), 0, tree, subroot, folded, proof FROM ends),
{_OP12_CLIMB.format("top", "top_start")},
tops AS (
  SELECT row_id, arg_max(h, level) AS root, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof
  FROM top GROUP BY row_id
)
SELECT doc_id, leaf, subroot, root, sha256(tops.proof) AS proof_sha256, tops.folded AS folded_root,
       tops.folded = root AS verified
FROM d JOIN ends USING (row_id) JOIN tops USING (row_id)
"""

_OP13_PARTS = """
v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
p AS MATERIALIZED (
  SELECT r, part, list_slice(e, part * len(e) // 4 + 1, (part + 1) * len(e) // 4) AS x
  FROM v, range(4) AS t(part)
),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS c FROM p WHERE r <= 256)"""
_OP13_NEAREST = """
a{0} AS MATERIALIZED (
  SELECT r, part, min({{'d': d, 'entry': entry}}) AS best
  FROM (SELECT r, p.part, entry, list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS d
        FROM p JOIN b{0} USING (part)) GROUP BY r, part
)"""
_OP13_MOVED = """
b{1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m, c) AS c FROM b{0} LEFT JOIN (
    SELECT part, entry, list(s ORDER BY k) AS m FROM (
      SELECT part, best.entry AS entry, k, floor(sum(x[k + 1]) / count(*)) AS s
      FROM a{0} JOIN p USING (r, part), range((SELECT max(len(x)) FROM p)) AS t(k) GROUP BY ALL) GROUP BY part, entry
  ) USING (part, entry)
)"""
_OP13 = f"""
WITH {_OP13_PARTS},
{",".join(_OP13_NEAREST.format(k) + "," + _OP13_MOVED.format(k, k + 1) for k in range(4))},
{_OP13_NEAREST.format(4)},
books AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, k)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(c) AS x, generate_subscripts(c, 1) AS k FROM b4)
),
coded AS (
  SELECT r, string_agg(printf('%02x', CAST(best.entry AS INT)), '' ORDER BY part) AS code,
         CAST(sum(best.d) AS BIGINT) AS error FROM a4 GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN coded USING (r), books
"""

ORACLE_SQL: dict[str, str] = {
    "op2_warc_zip": _OP2,
    "op3_decontaminate": _OP3,
    "op4_exact_dedup": _OP4,
    "op7_url_filter": _OP7,
    "op11_fingerprints": _OP11,
    "op12_merkle": _OP12,
    "op13_vector_codes": _OP13,
}
