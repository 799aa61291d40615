"""Queries of this package and their DuckDB SQL, by name."""

from __future__ import annotations

from starmart.llm.decontamination import op6_decontamination
from starmart.llm.embedding_dedup import op11_embedding_dedup
from starmart.llm.html_extraction import op1_html_extraction
from starmart.llm.jaccard_join import op9_jaccard_join
from starmart.llm.lm_scoring import op3_lm_scoring
from starmart.llm.mixing import op7_mixing
from starmart.llm.periodic_runs import op12_periodic_runs
from starmart.llm.pii_surrogates import op4_pii_surrogates
from starmart.llm.quality_rules import op5_quality_rules
from starmart.llm.secret_scan import RULES, op10_secret_scan
from starmart.llm.substring_dedup import op2_substring_dedup
from starmart.llm.token_alignment import op13_token_alignment
from starmart.llm.virtual_slots import op8_virtual_slots

QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_pii_surrogates": op4_pii_surrogates,
    "op5_quality_rules": op5_quality_rules,
    "op6_decontamination": op6_decontamination,
    "op7_mixing": op7_mixing,
    "op8_virtual_slots": op8_virtual_slots,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_secret_scan": op10_secret_scan,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE_SQL: dict[str, str] = {}

# The words of a text, and every window of 20 with its first place.
ORACLE_SQL["op2_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
wins AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM starts),
firsts AS (SELECT h, min({'d': doc_id, 'i': i}) AS f FROM wins GROUP BY h HAVING count(*) > 1),
later AS (SELECT doc_id, i FROM wins JOIN firsts USING (h) WHERE f.d <> doc_id OR f.i <> i),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps
         FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM later) GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed,
         CASE WHEN ps IS NULL THEN w
              ELSE list_filter(w, lambda x, k: NOT list_contains(ps, k)) END AS kw
  FROM d LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
       sha256(array_to_string(kw, ' ')) AS kept_sha256
FROM kept
"""

# Counts of 1-, 2- and 3-grams, less those of the document itself.
ORACLE_SQL["op3_lm_scoring"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
g AS (
  SELECT doc_id, i, w[i] AS a, CASE WHEN i > 1 THEN array_to_string(w[i - 1:i], ' ') END AS b,
         CASE WHEN i > 2 THEN array_to_string(w[i - 2:i], ' ') END AS c FROM p),
n AS (
  SELECT *, count(*) OVER () - count(*) OVER (PARTITION BY doc_id) AS others,
         count(*) OVER (PARTITION BY a) - count(*) OVER (PARTITION BY a, doc_id) AS n1,
         CASE WHEN b IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY b) - count(*) OVER (PARTITION BY b, doc_id) END AS n2,
         CASE WHEN c IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY c) - count(*) OVER (PARTITION BY c, doc_id) END AS n3
  FROM g),
s AS (
  SELECT *, lag(n1) OVER w AS m1, lag(n2) OVER w AS m2 FROM n WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
v AS (
  SELECT doc_id, CASE WHEN n3 > 0 THEN 3 WHEN n2 > 0 THEN 2 WHEN n1 > 0 THEN 1 ELSE 0 END AS level,
         CASE WHEN n3 > 0 THEN n3 / m2 WHEN n2 > 0 THEN n2 / m1 * CASE WHEN c IS NULL THEN 1 ELSE 0.4 END
              ELSE greatest(n1, 0.5::DOUBLE) / greatest(others, 1) * CASE WHEN c IS NOT NULL THEN 0.16 WHEN b IS NOT NULL THEN 0.4 ELSE 1 END
         END::DOUBLE AS x
  FROM s),
t AS (
  SELECT doc_id, sum(log10(x)) AS score, count(*) FILTER (level = 0) AS l0, count(*) FILTER (level = 1) AS l1,
         count(*) FILTER (level = 2) AS l2, count(*) FILTER (level = 3) AS l3
  FROM v GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, round(coalesce(score, 0), 5)::DOUBLE AS log10_score, coalesce(l0, 0)::BIGINT AS n_order_0,
       coalesce(l1, 0)::BIGINT AS n_order_1, coalesce(l2, 0)::BIGINT AS n_order_2, coalesce(l3, 0)::BIGINT AS n_order_3,
       round(pow(10.0, -coalesce(score, 0) / greatest(len(w), 1)), 3)::DOUBLE AS perplexity
FROM d LEFT JOIN t USING (doc_id)
"""

_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Windows of the items, and every run of as many words in a document.
ORACLE_SQL["op6_decontamination"] = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT item_id, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i, w FROM b WHERE len(w) > 0),
wanted AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM bw),
spots AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, (SELECT DISTINCT n FROM wanted) WHERE len(w) >= n),
hits AS (
  SELECT doc_id, item_id, i, wanted.n FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t FROM spots) AS x
  JOIN wanted ON x.t = wanted.t AND x.n = wanted.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# Raking as a recursion over the cells; one row per cell and sweep.
ORACLE_SQL["op7_mixing"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || source, 'null') AS source, coalesce('=' || lang, 'null') AS lang,
         '=' || CASE WHEN contains(t, ' | ') OR contains(t, '!! ') THEN 'marked'
                     WHEN regexp_matches(t, '[0-9]{3}') THEN 'figures'
                     WHEN strlen(t) < 1000 THEN 'short' ELSE 'prose' END AS topic,
         len(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))::BIGINT AS tokens,
         ('0x' || md5(coalesce(doc_id::VARCHAR, 'null') || ':' || md5(t))[1:13])::BIGINT / 4503599627370496.0 AS u
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)),
cells AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS n FROM d GROUP BY ALL HAVING sum(tokens) > 0),
ts AS (SELECT source, sum(n) ** 0.5 / sum(sum(n) ** 0.5) OVER () AS t_source FROM cells GROUP BY source),
tl AS (SELECT lang, sum(n) ** 0.7 / sum(sum(n) ** 0.7) OVER () AS t_lang FROM cells GROUP BY lang),
tt AS (SELECT topic, sum(n) ** 0.5 / sum(sum(n) ** 0.5) OVER () AS t_topic FROM cells GROUP BY topic),
raked AS (
  SELECT 0 AS sweep, cells.*, t_source, t_lang, t_topic, n AS w
  FROM cells JOIN ts USING (source) JOIN tl USING (lang) JOIN tt USING (topic)
  UNION ALL
  SELECT sweep + 1, source, lang, topic, n, t_source, t_lang, t_topic,
         w * t_topic / sum(w) OVER (PARTITION BY topic)
  FROM (SELECT * REPLACE (w * t_lang / sum(w) OVER (PARTITION BY lang) AS w)
        FROM (SELECT * REPLACE (w * t_source / sum(w) OVER (PARTITION BY source) AS w) FROM raked WHERE sweep < 60))),
final AS (SELECT source, lang, topic, n, w FROM raked WHERE sweep = 60),
scale AS (
  SELECT 0 AS i, 0.0::DOUBLE AS c
  UNION ALL
  SELECT i + 1, (SELECT (0.7 * sum(n) - coalesce(sum(n) FILTER (w * c >= n), 0)) / sum(w) FILTER (w * c < n) FROM final)
  FROM scale WHERE i < 30),
p AS (SELECT source, lang, topic, least(1.0, w * (SELECT c FROM scale WHERE i = 30) / n) AS p FROM final)
SELECT doc_id, CASE WHEN source <> 'null' THEN source[2:] END AS source, CASE WHEN lang <> 'null' THEN lang[2:] END AS lang,
       topic[2:] AS topic, tokens, round(coalesce(p, 0.0), 6)::DOUBLE AS p, u < coalesce(p, 0.0) AS sampled
FROM d LEFT JOIN p USING (source, lang, topic)
"""


def _spans_sql() -> str:
    """Text between the matches and the matches, measured, give the offsets."""
    parts = []
    for rank, r in enumerate(RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""
  SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
      'e': list_sum(list_transform(p[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))),
      'm': length(m[i]), 'v': length(v[i])}})) AS x
  FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS p, regexp_extract_all(text, '{pattern}', 0) AS m,
               regexp_extract_all(text, '{pattern}', {r.value}) AS v
        FROM documents WHERE regexp_matches(text, '{r.scan or pattern}'))""")
    least = " ".join(f"WHEN {i} THEN {r.least}" for i, r in enumerate(RULES))
    counts = ", ".join(f"coalesce(count(*) FILTER (kind = '{r.kind}'), 0)::BIGINT AS n_{r.kind}" for r in RULES if r.base)
    bases = sum(r.base for r in RULES)
    return f"""
WITH found AS ({" UNION ALL ".join(parts)}),
spans AS (
  SELECT doc_id, rank, kind, (x.e - x.m)::BIGINT AS s, concat_ws(':', kind, (x.e - x.m)::BIGINT, x.e::BIGINT) AS t
  FROM found WHERE x.v >= CASE rank {least} END),
per AS (
  SELECT doc_id, {counts}, string_agg(t, ',' ORDER BY s, rank) FILTER (rank < {bases}) AS base,
         string_agg(t, ',' ORDER BY s, rank) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in RULES if r.base)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN per USING (doc_id)
"""


ORACLE_SQL["op10_secret_scan"] = _spans_sql()
