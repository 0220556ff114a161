"""DuckDB SQL for the queries that SQL can express; written from the contracts, not from the operators."""

from __future__ import annotations

from rankmill.llm import licenses, quality
from rankmill.llm.secret_scan import BASE, RULES

_STRIP = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_SPACE = r"[\x20\x09-\x0D]"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, {_LOWER.format(f"trim(line, {_STRIP})")} AS key FROM lines
), shared AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1
)
SELECT k.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE s.keeper <> k.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE s.keeper IS NULL OR s.keeper = k.doc_id), ''))
         AS kept_sha256
FROM keyed k LEFT JOIN shared s USING (key)
GROUP BY k.doc_id
"""


def _op2() -> str:
    ends = r"([.!?;:])[\x20\x09-\x0D]"
    table = ", ".join(f"('{sentence}', '{name}')" for name, sentence in licenses.SENTENCES.items())
    plain = "trim(regexp_replace(" + _LOWER.format("s") + ", '[^a-z0-9]+', ' ', 'g'))"
    hits: dict[str, str] = {}
    for name, ids, over in licenses.RULES:
        hit = " AND ".join([f"seq LIKE '%|{'|%|'.join(ids)}|%'", *[f"NOT ({hits[other]})" for other in over]])
        hits[name] = f"({hits[name]}) OR ({hit})" if name in hits else hit
    named = ", ".join(f"CASE WHEN {hit} THEN '{name}' END" for name, hit in hits.items())
    return f"""
WITH known(sentence, id) AS (VALUES {table}),
texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '(?i)(spdx-license-identifier):', '\\1', 'g') AS t FROM documents
), ways AS (
  SELECT doc_id, 0 AS way, regexp_replace(regexp_replace(t, '{_SPACE}+', ' ', 'g'), '{ends}', '\\1' || chr(10), 'g') AS t FROM texts
  UNION ALL
  SELECT doc_id, 1, regexp_replace(t, '{ends}', '\\1' || chr(10), 'g') FROM texts
  UNION ALL
  SELECT doc_id, 2, replace(regexp_replace(regexp_replace(regexp_replace(t, '\\n([^A-Za-z0-9\\n]*\\n)+', chr(1), 'g'),
         '{_SPACE}+', ' ', 'g'), '{ends}', '\\1' || chr(10), 'g'), chr(1), chr(10)) FROM texts
), cut AS (
  SELECT doc_id, way, unnest(string_split(t, chr(10))) AS s, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM ways
), plain AS (
  SELECT doc_id, way, pos, {plain} AS sentence, length(replace({plain}, ' ', '')) AS size FROM cut
), placed AS (
  SELECT doc_id, sentence, size, sum(size) OVER (PARTITION BY doc_id, way ORDER BY pos) AS stop FROM plain
), found AS (
  SELECT DISTINCT doc_id, stop - size AS start, stop, id FROM placed JOIN known USING (sentence)
), sequences AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY start, stop) AS ids FROM found GROUP BY doc_id
), all_docs AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_sentences, coalesce(ids, '') AS sentences,
         '|' || replace(coalesce(ids, ''), ',', '||') || '|' AS seq
  FROM documents d LEFT JOIN sequences USING (doc_id)
)
SELECT doc_id, n_sentences, sentences, concat_ws(',', {named}) AS licenses FROM all_docs
"""


OP4 = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS seq
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)
), ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY seq ORDER BY doc_id, i) AS place FROM win
), gone AS (
  SELECT DISTINCT doc_id, i + k AS pos FROM ranked, range(0, 20) r(k) WHERE place > 1
), word AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS t
  FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, len(ws)::BIGINT - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def _op5() -> str:
    least = {"access": 18, "hex": 16, "github": 40, "slack": 20, "google": 39, "stripe": 24, "private_key": 1}
    parts = []
    for place, rule in enumerate(RULES):
        pattern = {
            "hex": "[0-9a-f]+",
            "assign": "(?i:password|passwd|secret|token|api_?key)[\"'']?\\x20*[:=]\\x20*[\"'']?[A-Za-z0-9+/_.=-]+",
        }.get(rule.kind, rule.pattern)
        long_enough = (
            "length(regexp_extract(m, '^[^:=]*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 12"
            if rule.kind == "assign"
            else f"length(m) >= {least[rule.kind]}"
        )
        parts.append(
            f"""SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, start, start + length(m) AS stop FROM (
  SELECT doc_id, unnest(ms) AS m, unnest(list_transform(range(1, len(ms) + 1), lambda i:
    list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda g: length(g))), 0))) AS start
  FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, regexp_split_to_array(t, '{pattern}') AS gaps
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
) WHERE {long_enough}"""
        )
    base = ", ".join(f"'{kind}'" for kind in BASE)
    told = "string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, place)"
    return f"""
WITH spans AS ({" UNION ALL ".join(parts)}),
lists AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in BASE)},
         coalesce({told} FILTER (WHERE kind IN ({base})), '') AS base, {told} AS spans
  FROM spans GROUP BY doc_id
)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN lists USING (doc_id)
"""


_QUALITY = (
    "(1.0::DOUBLE / (1.0::DOUBLE + 20.0::DOUBLE * len(regexp_extract_all(t, '[#*$%&|<>]')) / greatest(length(t), 1)))"
)
OP6 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, len({_WORDS})::BIGINT AS size FROM documents
), drawn AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(md5(doc_id::VARCHAR || '/' || md5(t)), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0::DOUBLE)
           / {_QUALITY} AS key
  FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS weight
  FROM d GROUP BY source
), rounds AS (
  -- a source that is above its stop in one round is fixed for the next
  SELECT 0 AS n, source, source_size, weight, FALSE AS fixed FROM s
  UNION ALL
  SELECT n + 1, source, source_size, weight,
         fixed OR weight * ((1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) FILTER (WHERE fixed) OVER (), 0))
           / sum(weight) FILTER (WHERE NOT fixed) OVER ()) > 2 * source_size
  FROM rounds WHERE n < (SELECT count(*) FROM s)
), targets AS (
  SELECT source, source_size,
         CASE WHEN fixed THEN (2 * source_size)::DOUBLE
              ELSE weight * ((1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) FILTER (WHERE fixed) OVER (), 0))
                   / sum(weight) FILTER (WHERE NOT fixed) OVER ()) END AS target
  FROM rounds WHERE n = (SELECT count(*) FROM s)
), placed AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs,
         coalesce(sum(size) OVER (PARTITION BY drawn.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM drawn JOIN targets ON drawn.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - ahead)))::BIGINT AS taken
FROM placed
"""

OP8 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), firsts AS (
  SELECT html, min(page_id) AS first FROM p WHERE strlen(html) >= 100 GROUP BY html
)
SELECT p.page_id, strlen(p.html)::BIGINT AS payload_bytes, sha256(p.html) AS payload_digest,
       CASE WHEN first < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < p.page_id THEN first END AS refers_to
FROM p LEFT JOIN firsts USING (html)
"""


def _op9() -> str:
    def count(text: str, pattern: str) -> str:
        return f"len(regexp_extract_all({text}, '{pattern.replace(chr(39), chr(39) * 2)}'))"

    def has(text: str, pattern: str) -> str:
        return f"regexp_matches({text}, '{pattern.replace(chr(39), chr(39) * 2)}')"

    chars = f"length({{0}}) - {count('{0}', _SPACE)}"
    fails = f"""l <> '' AND (
      {count("l", quality.SEPARATORS)} >= 3 OR (nw <= 4 AND {has("l", quality.MENU_WORDS)})
      OR {count("l", quality.SYMBOLS)} * 10 > length(l)
      OR ({count("l", "!!")} > 0 AND {count("l", "!!")} * 4 >= nw)
      OR (nw < 4 AND NOT {has("l", quality.CLOSING)})
      OR (nw <= 30 AND {has("l", quality.STOCK_PHRASES)}))"""
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
lines AS (
  SELECT doc_id, raw, pos, l, {count("l", "[^ \\x09-\\x0D]+")} AS nw FROM (
    SELECT doc_id, raw, pos, trim(raw, {_STRIP}) AS l FROM (
      SELECT doc_id, unnest(string_split(t, chr(10))) AS raw, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d))
), judged AS (SELECT *, {fails} AS fails FROM lines),
by_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE l <> '') - count(DISTINCT raw) FILTER (WHERE l <> '') AS n_dup_lines,
         count(*) FILTER (WHERE fails) AS n_lines_removed,
         coalesce(sum({chars.format("raw")}) FILTER (WHERE NOT fails), 0)::BIGINT AS chars_left
  FROM judged GROUP BY doc_id
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS seq
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d WHERE len(ws) >= 8)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, seq) AS n FROM win) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n_repeat_words FROM twice, range(0, 8) r(k) GROUP BY doc_id
), figures AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words, ({chars.format("t")})::BIGINT AS word_chars,
         {count("t", quality.SYMBOLS)}::BIGINT AS n_symbols, n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, n_lines_removed, chars_left
  FROM d JOIN by_doc USING (doc_id) LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * chars_left >= 50 * word_chars AS kept,
       n_lines_removed
FROM figures
"""


OP11 = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
         list_dot_product(a.v, r.v)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.other_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id)::INTEGER AS rank,
       n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n
  ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""

ORACLES = {
    "op1_line_dedup": OP1,
    "op2_license_scan": _op2(),
    "op4_substring_dedup": OP4,
    "op5_secret_scan": _op5(),
    "op6_source_mix": OP6,
    "op8_warc": OP8,
    "op9_quality_rules": _op9(),
    "op11_hard_negatives": OP11,
}
