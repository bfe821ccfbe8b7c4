"""DuckDB SQL for the queries that SQL can express: other roads to the same rows, over all documents.

Trained scores (op2), approximate passages (op6), alignments (op9) and merges by rank (op10) have none.
"""

from __future__ import annotations

from .quality_rules import LADDERS, PATH, RiskSpec

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACE_WORD = r"[^\x20\x09-\x0D]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

RATIOS = {
    "symbol_ratio": "n_symbols / greatest(n_words, 1)",
    "duplicate_line_ratio": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_word_ratio": "n_repeat_words / greatest(n_words, 1)",
    "mean_word_length": "word_chars / greatest(n_words, 1)",
}


def _rules() -> str:
    spec = RiskSpec()
    points = ", ".join(f"('{rule}', {i}, {cutoff})" for i, (rule, cutoff) in enumerate(PATH))
    value = "CASE p.rule " + " ".join(f"WHEN '{r}' THEN {r}" for r in LADDERS) + " END"
    cutoffs = ", ".join(f"min(cutoff) FILTER (rule = '{r}') AS {r}_cutoff" for r in LADDERS)
    over = " OR ".join(f"coalesce({r} > {r}_cutoff, FALSE)" for r in LADDERS)
    return f"""
WITH cut AS (SELECT doc_id, lang, text, regexp_extract_all(coalesce(text, ''), '{SPACE_WORD}') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{SPACE_WORD}')) AS lines FROM documents),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS often
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM cut)),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, range(3) AS t(k) WHERE often > 1 GROUP BY doc_id),
counts AS (SELECT doc_id, lang, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  coalesce(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')), 0) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines
  FROM cut LEFT JOIN repeated USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  {", ".join(f"{v} AS {r}" for r, v in RATIOS.items())} FROM counts),
points(rule, point, cutoff) AS (VALUES {points}),
good AS (SELECT * FROM judged JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 1) USING (doc_id) WHERE NOT base_failed),
firsts AS (SELECT g.doc_id, any_value(lang) AS lang, coalesce(min(CASE WHEN {value} > cutoff THEN point END), {len(PATH)}) AS first
  FROM good g, points p GROUP BY g.doc_id),
tested AS (SELECT lang, point, count(*) AS n, count(*) FILTER (first <= point) AS k FROM firsts, points GROUP BY lang, point),
proven AS (SELECT *, list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1)
  - CASE WHEN i = n THEN 0 ELSE lgamma(n - i + 1) END + i * ln({spec.risk}) + (n - i) * ln(1 - {spec.risk}))))
  <= {spec.error} / (SELECT greatest(count(*), 1) FROM (SELECT DISTINCT lang FROM tested WHERE n >= {spec.fewest()})) AS ok FROM tested),
reached AS (SELECT lang, coalesce(min(point) FILTER (NOT ok), {len(PATH)}) AS broken FROM proven GROUP BY lang),
cutoffs AS (SELECT lang, {cutoffs} FROM reached r LEFT JOIN points p ON p.point < broken GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({over}) AS kept,
  {", ".join(LADDERS)}, {", ".join(f"{r}_cutoff" for r in LADDERS)}
FROM judged j LEFT JOIN cutoffs c ON j.lang IS NOT DISTINCT FROM c.lang"""


ASSIGN = (
    "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
SECRETS = (
    ("assign", ASSIGN, f"length(regexp_extract(m, '{ASSIGN}', 1)) >= 6"),
    ("access", "AKIA[A-Z0-9]+", "length(m) >= 20"),
    ("hex", "[0-9a-f]+", "length(m) >= 24"),
    ("code_host", "gh[pousr]_[A-Za-z0-9]{36,}", "TRUE"),
    ("chat", "xox[abprs]-[A-Za-z0-9-]{10,}", "TRUE"),
    ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "TRUE"),
)


def _secrets() -> str:
    """A match starts after the texts between matches and the matches before it."""
    kinds = " UNION ALL ".join(
        f"""SELECT doc_id, {order} AS place, '{kind}' AS kind, start, start + length(m) AS finish FROM (
  SELECT doc_id, ms[i] AS m, CAST(coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
   + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
  FROM (SELECT doc_id, ms, gaps, unnest(range(1, len(ms) + 1)) AS i FROM (
   SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS gaps FROM documents)))
 WHERE {condition}"""
        for order, (kind, pattern, condition) in enumerate(SECRETS)
    )
    listed = "coalesce(string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, place) {filter}, '')"
    return f"""
WITH found AS ({kinds})
SELECT d.doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in ("assign", "access", "hex"))},
 sha256({listed.format(filter="FILTER (place < 3)")}) AS base_sha256, {listed.format(filter="FILTER (kind IS NOT NULL)")} AS spans,
 sha256(coalesce(any_value(d.text), '')) AS blob, any_value(d.scan) AS scan
FROM (SELECT *, CASE WHEN bool_or(coalesce(lang = 'en', FALSE)) OVER (PARTITION BY coalesce(text, '')) THEN 1 ELSE 2 END AS scan FROM documents) d
LEFT JOIN found f ON d.doc_id = f.doc_id GROUP BY d.doc_id"""


REPEATS = """
WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM raw)),
seen AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM strings) WHERE first < doc_id),
marked AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, TRUE) AS opens FROM seen),
numbered AS (SELECT doc_id, i, count(*) FILTER (opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, run),
pieces AS (SELECT doc_id, run, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
cut AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
  string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS left_over
  FROM pieces JOIN raw USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
 sha256(unhex(coalesce(left_over, h))) AS kept_sha256
FROM raw LEFT JOIN cut USING (doc_id)"""

CLASSES = f"""
WITH RECURSIVE cut AS (SELECT doc_id, regexp_extract_all({LOWER}, '{SPACE_WORD}') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM cut WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y ON x.s = y.s
  AND x.doc_id <> y.doc_id GROUP BY ALL) JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 75 * (p.n + q.n - common)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT c.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM cut c LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)"""

CONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS k FROM (
  SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
places AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k FROM (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows))),
hits AS (SELECT doc_id, n, i, item_id FROM places JOIN windows USING (n, k)),
words AS (SELECT doc_id, count(DISTINCT i + o) AS n_hit FROM (SELECT doc_id, i, unnest(range(0, n)) AS o FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed FROM (
  SELECT DISTINCT doc_id, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
 sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)"""

BITS = "0000000100100011010001010110011110001001101010111100110111101111"
ARCHIVE = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages),
bits AS (SELECT *, array_to_string(list_transform(string_split(sha1(html), ''),
  lambda c: substr('{BITS}', 4 * strpos('0123456789abcdef', c) - 3, 4)), '') AS b FROM p)
SELECT page_id, strlen(html) AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum(list_transform(range(1, 6),
   lambda j: CAST(substr(b, 5 * i + j, 1) AS INTEGER) * (1 << (5 - j)))) AS INTEGER), 1)), '') AS payload_digest,
 CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to, url
FROM bits"""

FILL_IN_MIDDLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (SELECT doc_id, t, length(t) AS n, list_transform(range(0, 4), lambda i: CAST('0x' || substr(h, CAST(8 * i + 1 AS BIGINT), 8) AS BIGINT)) AS r FROM d),
cut AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 90 THEN 'plain'
   WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
pieces AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
 sha256(t) AS restored_sha256
FROM pieces"""

TRIE = r"""
WITH turns AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p,
  {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS x FROM conversations WHERE conv_id IS NOT NULL),
seqs AS (SELECT c, list(x ORDER BY p) AS xs FROM turns GROUP BY c),
drawn AS (SELECT c, xs, xor(4294967295, list_reduce(flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
   lambda d: [CAST(ascii(d) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
   lambda a, v: CASE WHEN v >= 0 THEN xor(a, v) ELSE xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END) END,
   4294967295)) % 4 AS h FROM seqs),
built AS (SELECT d.c, coalesce(g.xs[1:d.h], []) || d.xs[d.h + 1:] AS xs FROM drawn d LEFT JOIN seqs g ON g.c = d.c - d.c % 20),
paths AS (SELECT c, d, xs[1:d] AS prefix, len(xs) = d AS ends FROM (SELECT c, xs, unnest(range(0, len(xs) + 1)) AS d FROM built)),
nodes AS (SELECT prefix, d, min(c) AS conv_id, count(*) AS n_convs, string_agg(c, ',' ORDER BY c) FILTER (ends) AS ended,
  CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(prefix[d].text, '[^\x20\x09-\x0D]+')) END AS words FROM paths GROUP BY prefix, d),
kids AS (SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
placed AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.d = n.d AND k.prefix = n.prefix),
over AS (SELECT prefix[1:e] AS prefix, e AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM placed) GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
 sha256(coalesce(n.ended, '')) AS ends_sha256
FROM placed n JOIN over o ON o.d = n.d AND o.prefix = n.prefix LEFT JOIN nodes u ON u.d = n.d - 1 AND u.prefix = n.prefix[1:n.d - 1]"""

ORACLE_SQL: dict[str, str] = {
    "op1_risk_rules": _rules(),
    "op3_blob_ledger": _secrets(),
    "op4_bwt_merge": REPEATS,
    "op5_heavy_light_join": CLASSES,
    "op7_prefix_windows": CONTAMINATION,
    "op8_dictionary_warc": ARCHIVE,
    "op11_rank_index_fim": FILL_IN_MIDDLE,
    "op13_block_trie": TRIE,
}
