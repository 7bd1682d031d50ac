"""The same queries in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

import re

from tidemark.llm import chat
from tidemark.llm.rules import RULES, STOP_WORDS, Rule

_WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH rows AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '/' || coalesce(text, '')), 1, 15))::BIGINT AS key
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
turns AS (
  SELECT *, (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) AS turn,
    source_size * 2.0::DOUBLE AS cap FROM sizes),
weighted AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][(turn % 3 + 1)::INT] AS weight FROM turns),
placed AS (
  SELECT *, row_number() OVER w AS place, sum(source_size) OVER () * 1.5::DOUBLE AS budget,
    coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped,
    sum(weight) OVER () - coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open
  FROM weighted WINDOW w AS (ORDER BY cap / weight, turn)),
levels AS (SELECT *, (budget - stopped) / open AS level FROM placed),
first AS (SELECT min(place) AS spot FROM levels WHERE level * weight <= cap),
targets AS (
  SELECT source, source_size, CASE WHEN place >= (SELECT spot FROM first)
    THEN (SELECT level FROM levels WHERE place = (SELECT spot FROM first)) * weight ELSE cap END AS target FROM levels),
starts AS (
  SELECT r.*, t.source_size, t.target, round(t.target)::BIGINT AS budget,
    coalesce(sum(size) OVER (PARTITION BY r.source ORDER BY key, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target::DOUBLE AS target,
  (CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * size
   + greatest(0, least(size, CASE WHEN source_size > 0 THEN budget % source_size ELSE budget END - start)))::BIGINT AS taken
FROM starts
"""

OP3 = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{_WORD}') AS w FROM documents),
tokens AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS token
  FROM texts, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * common.n >= 75 * (a.n + b.n - common.n)),
reach AS (SELECT doc_id AS node, doc_id AS other FROM documents UNION SELECT node, y FROM reach JOIN links ON other = x)
SELECT d.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reach r ON r.node = d.doc_id GROUP BY d.doc_id
"""

_BLANK = r"[\x20\x09\x0B-\x0D]"


def _checks(rules: tuple[Rule, ...]) -> str:
    """The threshold table as a condition over the measures."""
    parts = []
    for rule in rules:
        measure = re.sub(r"try_divide\((.*), (\w+)\)", r"((\1)::DOUBLE / nullif(\2, 0))", rule.measure)
        bounds = [f"{measure} >= {rule.least}"] * (rule.least is not None) + [f"{measure} <= {rule.most}"] * (rule.most is not None)
        parts += [f"coalesce({bound}, false)" for bound in bounds]
    return " AND ".join(parts)


OP4 = rf"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS lines FROM documents),
runs AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS run FROM texts, unnest(range(1, len(w) - 1)) AS t(i)),
twice AS (SELECT r, run FROM runs GROUP BY ALL HAVING count(*) > 1),
places AS (SELECT DISTINCT r, i + k AS place FROM runs JOIN twice USING (r, run), (SELECT unnest([0, 1, 2]) AS k)),
repeats AS (SELECT r, count(*) AS n FROM places GROUP BY r),
measures AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, len(regexp_replace(text, '[ 	-]+', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines) AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
    len(list_intersect(list_transform(w, lambda x: lower(x)), {list(STOP_WORDS)})) AS n_stop_words,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_alpha_words,
    len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…){_BLANK}*$'))) AS n_ellipsis_lines,
    len(list_filter(lines, lambda l: regexp_matches(l, '^{_BLANK}*[•‣*-][ 	]'))) AS n_bullet_lines
  FROM texts LEFT JOIN repeats USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  NOT ({_checks(tuple(rule for rule in RULES if rule.base))}) AS base_failed, {_checks(RULES)} AS kept FROM measures
"""

OP7 = rf"""
WITH split AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS number
  FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT *, regexp_extract_all(line, '{_WORD}') AS w, row_number() OVER (ORDER BY doc_id, number) AS place FROM split
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
tokens AS (
  SELECT DISTINCT place, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS token
  FROM lines, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i)),
sizes AS (SELECT place, count(*) AS n FROM tokens GROUP BY place),
common AS (
  SELECT a.place AS x, b.place AS y, count(*) AS n FROM tokens a JOIN tokens b ON a.token = b.token AND a.place < b.place
  GROUP BY ALL),
later AS (
  SELECT DISTINCT y AS place FROM common JOIN sizes a ON a.place = x JOIN sizes b ON b.place = y
  WHERE 100 * common.n >= 75 * (a.n + b.n - common.n)),
gone AS (SELECT doc_id, number FROM lines JOIN later USING (place)),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY number) AS text FROM split WHERE (doc_id, number) NOT IN (SELECT * FROM gone)
  GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id),
final AS (
  SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
    coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(c.n_removed, 0)::BIGINT AS n_removed
  FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN counts c USING (doc_id))
SELECT doc_id, n_lines, n_removed, length(text)::BIGINT AS n_chars, md5(text) AS text_md5 FROM final
"""

_BROKEN = rf"regexp_replace(%s, '([<\[])(\\*)({chat._rests(chat.CONTROL)})', '\1\\\2\3', 'g')"

OP12 = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', '{chat.REPLY}']), '</s>[INST] ok [/INST]'),
formatted AS (
  SELECT *, '{chat.START}' || {_BROKEN % "replace(replace(role, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n')"}
    || chr(10) || {_BROKEN % "text"} || '{chat.END}' || chr(10) AS segment FROM turns),
placed AS (
  SELECT *, row_number() OVER w AS position, sum(len(segment)) OVER (w ROWS UNBOUNDED PRECEDING) AS ends_at,
    count(*) OVER (PARTITION BY conv_id) AS n FROM formatted WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, segment))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY position)) AS turns_sha256,
  coalesce(sum(len(text)) FILTER (role = '{chat.REPLY}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY position) FILTER (role = '{chat.REPLY}'), '')) AS loss_sha256,
  coalesce(sum(ends_at) FILTER (role = '{chat.REPLY}' OR position = n), 0)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""

ORACLES = {"op1_mixing": OP1, "op3_ngram_join": OP3, "op4_quality_rules": OP4, "op7_line_dedup": OP7, "op12_chat_format": OP12}
