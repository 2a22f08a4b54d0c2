"""The dealt operators applied to whole tables, with their SQL checks where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.llm import (
    attribution,
    centroids,
    exact,
    maxent,
    mixing,
    near,
    quality,
    sanitise,
    substring,
    suffixes,
    templates,
    training_order,
    whitening,
)
from millrace.plans.base import Cases, table

CASES = Cases()

#: SQL for the words of every document, in order
_WORDS = r"""
    worded AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents)
"""

#: SQL for a text with A-Z lower-cased
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@CASES.query(
    "op1_exact_dedup",
    f"""
    WITH hashed AS (SELECT doc_id, {_LOWER} AS body FROM documents),
    grouped AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY body)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
    FROM hashed JOIN grouped USING (body)
    """,
)
def op1_exact_dedup(spark, sf_dir):
    return exact.dedup(table(spark, sf_dir, "documents"))


@CASES.query("op2_quality_gbt")
def op2_quality_gbt(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@CASES.query(
    "op3_minhash_forest",
    rf"""
    WITH RECURSIVE worded AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
    shingles AS (SELECT DISTINCT doc_id, array_to_string(ws[s:s + 4], ' ') AS k
                 FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS s FROM worded WHERE len(ws) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
               FROM shingles a JOIN shingles b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
              WHERE 100 * c >= 75 * (p.n + q.n - c)),
    reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
    FROM documents d LEFT JOIN sizes USING (doc_id)
         JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) USING (doc_id)
    """,
)
def op3_minhash_forest(spark, sf_dir):
    return near.near_duplicates(table(spark, sf_dir, "documents"))


@CASES.query(
    "op5_substring_dedup",
    f"""
    WITH {_WORDS},
    win AS (SELECT doc_id, s, array_to_string(ws[s:s + 19], ' ') AS k
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM worded)),
    again AS (SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM win) WHERE n > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS pos FROM again),
    per_doc AS (SELECT doc_id, count(*) AS n_removed, list(pos) AS gone FROM gone GROUP BY doc_id)
    SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed,
           sha256(array_to_string(CASE WHEN gone IS NULL THEN ws
               ELSE list_transform(list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(gone, i)), lambda i: ws[i]) END,
               ' ')) AS kept_sha256
    FROM worded w LEFT JOIN per_doc USING (doc_id)
    """,
)
def op5_substring_dedup(spark, sf_dir):
    kept = substring.remove_repeats(table(spark, sf_dir, "documents"), width=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@CASES.query(
    "op7_suffix_dedup",
    """
    WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
    win AS (SELECT doc_id, s, substr(h, 2 * s - 1, 100) AS k FROM (SELECT doc_id, h, unnest(range(1, n - 48)) AS s FROM bytes)),
    again AS (SELECT doc_id, s FROM (SELECT *, min(doc_id) OVER (PARTITION BY k) AS least FROM win) WHERE doc_id > least),
    gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS pos FROM again),
    runs AS (SELECT doc_id, min(pos) AS a, max(pos) + 1 AS b
             FROM (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM gone)
             GROUP BY doc_id, run),
    gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER w, 1) AS from_pos, lead(a) OVER w IS NULL AS last
             FROM runs WINDOW w AS (PARTITION BY doc_id ORDER BY a)),
    per_doc AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans,
                       string_agg(substr(h, 2 * from_pos - 1, 2 * (a - from_pos))
                                  || CASE WHEN last THEN substr(h, 2 * b - 1) ELSE '' END, '' ORDER BY a) AS kept
                FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id)
    SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(coalesce(kept, h))) AS kept_sha256
    FROM bytes d LEFT JOIN per_doc USING (doc_id)
    """,
)
def op7_suffix_dedup(spark, sf_dir):
    kept = suffixes.remove_repeats(table(spark, sf_dir, "documents"), width=50)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@CASES.query(
    "op9_source_mix",
    rf"""
    WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                          md5('17:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
    by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    weighed AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, source_size * 3 AS cap FROM by_source),
    levelled AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                           / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE
                           AS own FROM weighed),
    goals AS (SELECT source, source_size, least(cap::DOUBLE, w * arg_min(own, cap / w) FILTER (own * w <= cap) OVER ()) AS target
              FROM levelled),
    line AS (SELECT doc_id, source, size,
                    sum(size) OVER (PARTITION BY source ORDER BY digest, doc_id, size) - size AS start FROM sized)
    SELECT doc_id, size, source_size, target,
           (floor(target)::BIGINT // greatest(source_size, 1) * size
            + greatest(0, least(start + size, floor(target)::BIGINT % greatest(source_size, 1)) - start))::BIGINT AS taken
    FROM line l JOIN goals g ON l.source IS NOT DISTINCT FROM g.source
    """,
)
def op9_source_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@CASES.query("op4_training_order")
def op4_training_order(spark, sf_dir):
    path = training_order.new_path(spark)
    training_order.materialise(table(spark, sf_dir, "documents"), path)
    records = training_order.read(spark, path)
    return records.select("slot", "seq", "shard", "offset", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"))


@CASES.query("op6_token_attribution")
def op6_token_attribution(spark, sf_dir):
    return attribution.attribute(table(spark, sf_dir, "documents"))


@CASES.query("op8_template_decontamination")
def op8_template_decontamination(spark, sf_dir):
    return templates.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@CASES.query("op10_maxent_scores")
def op10_maxent_scores(spark, sf_dir):
    return maxent.score(table(spark, sf_dir, "documents"))


@CASES.query("op11_embedding_whitening")
def op11_embedding_whitening(spark, sf_dir):
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


#: One round: the nearest centroid of every vector, then the floor of the mean of its vectors for every centroid that has any
_ROUND = """
    apart{i} AS (SELECT r, c, sum((e.x - m.x) * (e.x - m.x))::BIGINT AS distance FROM entries e JOIN centre{i} m USING (d) GROUP BY r, c),
    near{i} AS MATERIALIZED (SELECT r, best.c AS c, best.distance AS distance
              FROM (SELECT r, min(struct_pack(distance := distance, c := c)) AS best FROM apart{i} GROUP BY r))"""
_MOVED = """
    mean{j} AS (SELECT c, d, sum(x)::BIGINT AS s, count(*) AS n FROM near{i} JOIN entries USING (r) GROUP BY c, d),
    centre{j} AS MATERIALIZED (SELECT c, d, coalesce((s - ((s % n) + n) % n) // n, m.x) AS x FROM centre{i} m LEFT JOIN mean{j} USING (c, d))"""


@CASES.query(
    "op13_centroid_clustering",
    f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda v: floor(1024 * v::DOUBLE)::BIGINT) AS x FROM embeddings
        WHERE len(embedding) = {centroids.WIDTH} AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
    entries AS MATERIALIZED (SELECT r, d, x[d] AS x FROM kept, range(1, {centroids.WIDTH + 1}) AS places(d)),
    drawn AS (SELECT r, row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), x) - 1 AS c FROM kept),
    centre0 AS MATERIALIZED (SELECT c, d, x FROM drawn JOIN entries USING (r) WHERE c < {centroids.CENTROIDS}),
    {",".join(_ROUND.format(i=i) + "," + _MOVED.format(i=i, j=i + 1) for i in range(centroids.ROUNDS))},
    {_ROUND.format(i=centroids.ROUNDS)}
    SELECT vec_id, c::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
           sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
    FROM near{centroids.ROUNDS} JOIN kept USING (r)
         JOIN (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM centre{centroids.ROUNDS} GROUP BY c) USING (c)
    """,
)
def op13_centroid_clustering(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


#: The contract's patterns, and a check of what they match, in SQL
_DATA = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "list_max(list_transform(string_split(v, '.'), lambda x: x::HUGEINT)) <= 255"),
    "card": (
        r"[0-9]([\x20-]?[0-9])+",
        """len(regexp_replace(v, '[^0-9]', '', 'g')) BETWEEN 12 AND 19
           AND list_sum(list_transform(string_split(reverse(regexp_replace(v, '[^0-9]', '', 'g')), ''),
               lambda x, i: CASE WHEN i % 2 = 1 THEN x::INT WHEN x::INT > 4 THEN 2 * x::INT - 9 ELSE 2 * x::INT END)) % 10 = 0""",
    ),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "len(regexp_replace(v, '[^0-9]', '', 'g')) BETWEEN 9 AND 15"),
}


def _placed_sql(rows: str, pattern: str) -> str:
    """``r, v, s, e``: all matches of a pattern in the texts of ``rows``, with their places."""
    return f"""(SELECT r, v, e - length(v) AS s, e FROM (
        SELECT r, v, sum(length(gap) + length(v)) OVER (PARTITION BY r ORDER BY i)::BIGINT AS e FROM (
            SELECT r, unnest(m) AS v, unnest(g[1:len(m)]) AS gap, unnest(range(1, len(m) + 1)) AS i
            FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM {rows}))))"""


_BASE = " UNION ALL ".join(
    f"SELECT r, {rank} AS rank, '{kind}' AS kind, s, e FROM {_placed_sql('texts', pattern)} WHERE {check}"
    for rank, (kind, (pattern, check)) in enumerate(_DATA.items())
)
_VALUES = " UNION ALL ".join(
    f"""SELECT DISTINCT passage, '{kind}:' || {"lower(v)" if kind == "email" else "v" if kind == "ip" else "regexp_replace(v, '[^0-9]', '', 'g')"} AS value
        FROM (SELECT passage, unnest(regexp_extract_all(passage, '{pattern}')) AS v FROM held) WHERE {check}"""
    for kind, (pattern, check) in _DATA.items()
)
_REST = "passage"
for _pattern in (_DATA["email"][0], _DATA["phone"][0], _DATA["ip"][0], r"[0-9]([\x20-]?[0-9]){11,}"):
    _REST = f"regexp_replace({_REST}, '{_pattern}', ' ', 'g')"
_TERM_SQL = sanitise.TERM.replace("'", "''")


def _terms_sql(passage: str) -> str:
    signs = f"""['#'] || CASE WHEN regexp_matches({passage}, '\\p{{L}}') THEN ['#word'] ELSE [] END
                || CASE WHEN regexp_matches({passage}, '[0-9]') THEN ['#number'] ELSE [] END"""
    return f"list_distinct(regexp_extract_all(lower({passage}), '{_TERM_SQL}') || {signs})"


@CASES.query(
    "op12_sanitise",
    f"""
    WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    base AS MATERIALIZED ({_BASE}),
    cut AS MATERIALIZED (SELECT r, unnest(string_split_regex(t, '{sanitise.PASSAGE_END}')) AS passage FROM texts),
    passages AS MATERIALIZED (SELECT DISTINCT passage FROM cut WHERE passage <> ''),
    held AS MATERIALIZED (SELECT DISTINCT passage FROM cut WHERE r IN (SELECT r FROM base) AND passage <> ''),
    protected AS MATERIALIZED ({_VALUES}),
    beside AS (SELECT passage, unnest(list_intersect({_terms_sql("rest")}, {_terms_sql("passage")})) AS term FROM (SELECT passage, {_REST} AS rest FROM held WHERE passage IN (SELECT passage FROM protected))),
    found AS MATERIALIZED (SELECT value, term, count(*) AS both_n FROM beside JOIN protected USING (passage)
                           GROUP BY ALL HAVING count(*) >= {sanitise.SUPPORT}),
    of_term AS MATERIALIZED (SELECT term, count(*) AS n FROM (SELECT unnest({_terms_sql("passage")}) AS term FROM passages)
                             WHERE term IN (SELECT term FROM found) GROUP BY term),
    judged AS (SELECT value, term FROM found JOIN of_term USING (term)
                    JOIN (SELECT value, both_n AS n_value FROM found WHERE term = '#') USING (value), (SELECT n AS total FROM of_term WHERE term = '#')
               WHERE n_value < total
                 AND round(ln(total::DOUBLE * both_n / (n * n_value)) / ln(total::DOUBLE / n_value), 9) >= {sanitise.THRESHOLD}),
    telling AS MATERIALIZED (SELECT DISTINCT term FROM judged WHERE term NOT LIKE '#%'),
    marked AS (SELECT * FROM texts WHERE len(list_intersect(regexp_extract_all(lower(t), '{_TERM_SQL}'), (SELECT list(term) FROM telling))) > 0),
    terms AS (SELECT r, 4 AS rank, 'term' AS kind, s, e FROM {_placed_sql("marked", _TERM_SQL)} p
              WHERE lower(v) IN (SELECT term FROM telling)
                AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = p.r AND b.s < p.e AND p.s < b.e)),
    per_row AS (SELECT r, {", ".join(f"count(*) FILTER (WHERE kind = '{kind}') AS n_{kind}" for kind in _DATA)},
                       string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (WHERE rank < 4) AS own,
                       string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
                FROM (SELECT * FROM base UNION ALL SELECT * FROM terms) GROUP BY r)
    SELECT doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in _DATA)},
           sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM texts LEFT JOIN per_row USING (r)
    """,
)
def op12_sanitise(spark, sf_dir):
    found = sanitise.sanitise(table(spark, sf_dir, "documents"))
    counts = [sanitise.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in sanitise.KINDS]
    digest = F.sha2(sanitise.listed(F.col("base")), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), sanitise.listed(F.col("spans")).alias("spans"))
