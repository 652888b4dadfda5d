"""SQL (DuckDB) equivalents of those queries of this package that SQL can express.

Packing, token counts, token shards and shuffled shards depend on a tokenizer or a seeded order,
web-page texts on a trained model; they are tested against brute force and round trips.
"""

from __future__ import annotations

from wellspring.llm.quality import STOP_WORDS

_BLANK = r"[\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str, gap: str = _BLANK) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{gap}'), lambda w: w <> '')"


OP1 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_words(_LOWER.format("coalesce(text, '')"))} AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 90 * (x.n + y.n - c)
), both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
  SELECT a, b FROM both_ways
  UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a
), least_id AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_id l ON l.a = d.doc_id
"""

OP3 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), r AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(23 + length(role) + length(text)
      + len(regexp_extract_all(role, '[<\[]\\*(?:s>|/s>|INST\]|/INST\])'))
      + len(regexp_extract_all(text, '[<\[]\\*(?:s>|/s>|INST\]|/INST\])'))) OVER w AS chars
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) FILTER (role = 'assistant' OR i = n) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""

OP4 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
    {_words("coalesce(text, '')")} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), g AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), again AS (
  SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
), hit AS (
  SELECT rid, count(DISTINCT i + k) AS c FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid
), f AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '{_BLANK}', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(c, 0) AS n_repeat_words,
    len(list_intersect(list_transform(w, lambda x: lower(x)), {sorted(set(STOP_WORDS))})) AS n_stop,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•·]'))) AS n_list,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_cut,
    coalesce(list_max(list_transform(w, lambda x: length(x))), 0) AS longest
  FROM d LEFT JOIN hit USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND word_chars BETWEEN 2 * n_words AND 15 * n_words
    AND n_symbols <= 0.3::DOUBLE * n_words AND n_stop >= 2
    AND n_dup_lines <= 0.3::DOUBLE * n_lines AND n_list <= 0.9::DOUBLE * n_lines
    AND n_cut <= 0.3::DOUBLE * n_lines AND longest <= 1000 AS kept
FROM f
"""

OP5 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages
), f AS (
  SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h,
    min(page_id) OVER (PARTITION BY html) AS first_id
  FROM p
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
    (list_sum(list_transform(range(5), lambda j: CAST(
      (strpos('0123456789abcdef', substr(h, CAST(5 * (k // 4) + j + 1 AS BIGINT), 1)) - 1) AS BIGINT)
      << CAST(4 * (4 - j) AS BIGINT)))::BIGINT >> CAST(15 - 5 * (k % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '')
    AS payload_digest,
  CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id < page_id THEN first_id END AS refers_to
FROM f
"""

_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP6 = f"""
WITH d AS (
  SELECT doc_id, {_words(_LOWER.format("coalesce(text, '')"), _GAP)} AS w FROM documents
), b AS (
  SELECT item_id, {_words(_LOWER.format("coalesce(text, '')"), _GAP)} AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bw
), dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), m AS (SELECT doc_id, item_id, i, n FROM dw JOIN bw USING (n, g)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS c FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY 1
), items AS (
  SELECT doc_id, count(*) AS c, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY 1
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(hit.c, 0) AS n_hit, coalesce(items.c, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.c, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP13 = f"""
WITH d AS (SELECT doc_id, {_words("coalesce(text, '')")} AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)
), later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM win
  ) WHERE k > 1
), covered AS (SELECT DISTINCT doc_id, i + unnest(range(0, 20)) AS i FROM later
), word AS (SELECT doc_id, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS i FROM d
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS text
  FROM word ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op1_jaccard_join": OP1,
    "op3_chat_examples": OP3,
    "op4_quality_rules": OP4,
    "op5_warc": OP5,
    "op6_decontaminate": OP6,
    "op13_substring_dedup": OP13,
}
