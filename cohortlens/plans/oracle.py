"""Oracle SQL (DuckDB dialect) for each registered query.

Tables are the pre-registered views ``orders``, ``lineitem``, ``part``,
``customer``, ``embeddings``, ``labels``, ``documents``. Column names and
rounding match the Spark side exactly. The SQL restates each binding and
operator independently of the Spark code, with the textbook two-pass
deviation (join the mean back, then Σ (s − μ)² / m).
"""

from __future__ import annotations

# ---- shared CTE fragments -----------------------------------------------------

_LONG_COHORT = """
samples AS (
  SELECT o_orderkey AS sample_id,
         CASE WHEN substr(o_orderpriority, 1, 1) IN ('1') THEN 'control'
              WHEN substr(o_orderpriority, 1, 1) IN ('4', '5') THEN 'case' END AS grp
  FROM orders),
cohort AS (SELECT sample_id, grp FROM samples WHERE grp IS NOT NULL),
sizes AS (SELECT grp, count(*) AS n FROM cohort GROUP BY grp),
membership AS (SELECT p_partkey AS feature_id, unnest([p_brand, p_type]) AS cluster FROM part),
cells AS (
  SELECT c.sample_id, c.grp, l.l_partkey AS feature_id, CAST(l.l_quantity AS DOUBLE) AS value
  FROM lineitem l JOIN cohort c ON l.l_orderkey = c.sample_id),
scores AS (
  SELECT c.grp, m.cluster, c.sample_id, sum(c.value) AS score
  FROM cells c JOIN membership m ON c.feature_id = m.feature_id
  GROUP BY c.grp, m.cluster, c.sample_id)"""

_STATS = """
mu AS (
  SELECT s.grp, s.cluster, z.n, count(s.score) AS n_scored, sum(s.score) / z.n AS mean
  FROM scores s JOIN sizes z ON s.grp = z.grp
  GROUP BY s.grp, s.cluster, z.n),
stats AS (
  SELECT mu.grp, mu.cluster, mu.n, mu.n_scored, mu.mean,
         sqrt(sum((s.score - mu.mean) * (s.score - mu.mean)) / mu.n_scored) AS sd
  FROM mu JOIN scores s ON s.grp = mu.grp AND s.cluster = mu.cluster
  GROUP BY mu.grp, mu.cluster, mu.n, mu.n_scored, mu.mean),
tscores AS (
  SELECT a.cluster,
         (a.mean - b.mean) / nullif(sqrt(a.sd * a.sd / a.n + b.sd * b.sd / b.n), 0) AS t,
         a.mean AS mean_case, a.sd AS sd_case, b.mean AS mean_control, b.sd AS sd_control,
         a.n AS n_case, b.n AS n_control
  FROM stats a JOIN stats b ON a.cluster = b.cluster AND a.grp = 'case' AND b.grp = 'control'),
ranked AS (
  SELECT row_number() OVER (ORDER BY t DESC, cluster ASC) AS rank, *
  FROM tscores WHERE t IS NOT NULL AND NOT isnan(t)
  ORDER BY t DESC, cluster ASC LIMIT {k})"""

_ROUND_T = """(round(t, 6) + 0.0) AS t,
       (round(mean_case, 6) + 0.0) AS mean_case, (round(sd_case, 6) + 0.0) AS sd_case,
       (round(mean_control, 6) + 0.0) AS mean_control,
       (round(sd_control, 6) + 0.0) AS sd_control"""


def _features(k: int = 10) -> str:
    return ",\n       ".join(
        f"max(CASE WHEN r.rank = {i} THEN s.score END) AS f{i:02d}" for i in range(1, k + 1))


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts)


# ---- long binding -------------------------------------------------------------

COHORT_SIZES = _with(_LONG_COHORT) + "\nSELECT grp, n FROM sizes"

CLUSTER_SCORES = _with(_LONG_COHORT) + """
SELECT grp, cluster, sample_id, (round(score, 6) + 0.0) AS score FROM scores"""

COHORT_STATS = _with(_LONG_COHORT, _STATS.format(k=10)) + """
SELECT grp, cluster, n, n_scored, (round(mean, 6) + 0.0) AS mean, (round(sd, 6) + 0.0) AS sd FROM stats"""

T_SCORES_ALL = _with(_LONG_COHORT, _STATS.format(k=10)) + f"""
SELECT cluster, {_ROUND_T}, n_case, n_control FROM tscores"""

TOP_K_CLUSTERS = _with(_LONG_COHORT, _STATS.format(k=10)) + f"""
SELECT CAST(rank AS INTEGER) AS rank, cluster, {_ROUND_T} FROM ranked"""

CLUSTER_LOOKUP = _with(_LONG_COHORT, _STATS.format(k=10)) + f"""
SELECT cluster, {_ROUND_T}, n_case, n_control FROM tscores WHERE cluster = 'Brand#12'"""

SAMPLE_FEATURES = _with(_LONG_COHORT, _STATS.format(k=10)) + f""",
background AS (
  SELECT o_orderkey AS sample_id, CAST(floor(c_acctbal) AS INTEGER) AS age,
         o_orderstatus AS sex, c_mktsegment AS education
  FROM orders JOIN customer ON o_custkey = c_custkey),
wide AS (
  SELECT s.grp, s.sample_id,
       {_features(10)}
  FROM scores s JOIN ranked r ON s.cluster = r.cluster
  GROUP BY s.grp, s.sample_id)
SELECT w.grp, w.sample_id, CASE WHEN w.grp = 'case' THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
       b.age, b.sex, b.education,
       {", ".join(f"w.f{i:02d}" for i in range(1, 11))}
FROM wide w LEFT JOIN background b ON w.sample_id = b.sample_id"""

TAGGED_UNION = _with(_LONG_COHORT) + """
SELECT sample_id, grp, CAST(0 AS INTEGER) AS tag FROM cohort WHERE grp = 'control'
UNION ALL
SELECT sample_id, grp, CAST(1 AS INTEGER) AS tag FROM cohort WHERE grp = 'case'"""


# ---- wide binding: embeddings rendered as text, part as annotation -------------

_WIDE = """
lines AS (
  SELECT DISTINCT 'PATIENT_ID,DIAGNOSIS,' ||
         array_to_string(list_transform(range(0, len(embedding)), lambda i: CAST(i AS VARCHAR)), ',')
         AS value
  FROM embeddings
  UNION ALL
  SELECT concat_ws(',', CAST(vec_id AS VARCHAR), CAST(label AS VARCHAR),
         array_to_string(list_transform(embedding,
           lambda x: CAST(CAST(round(CAST(x AS DOUBLE) * 1e6) AS BIGINT) AS VARCHAR)), ','))
  FROM embeddings),
wrows AS (SELECT string_split(value, ',') AS cells FROM lines),
ann_lines AS (
  SELECT concat_ws(',', p_brand, p_type, species, CAST(count(*) AS VARCHAR),
                   array_to_string(list_sort(list_distinct(list(member))), ';')) AS value
  FROM (SELECT p_brand, p_type,
               ['Human', 'Mouse', 'Rat', 'Zebrafish', 'Yeast'][(p_size % 5) + 1] AS species,
               CAST(p_partkey % (SELECT max(len(embedding)) FROM embeddings) AS VARCHAR) AS member
        FROM part)
  GROUP BY p_brand, p_type, species),
ann AS (SELECT string_split(value, ',') AS c FROM ann_lines),
annotation AS (SELECT c[1] AS cluster, c[3] AS species, c[5] AS members FROM ann
               WHERE c[3] = 'Human'),
membership AS (SELECT cluster, unnest(string_split(members, ';')) AS feature_id FROM annotation),
positions AS (
  SELECT DISTINCT feature_id, CAST(position AS INTEGER) AS position FROM (
    SELECT unnest(cells) AS feature_id, unnest(generate_series(0, len(cells) - 1)) AS position
    FROM wrows WHERE cells[1] = 'PATIENT_ID')),
pos_map AS (SELECT p.position, m.cluster FROM membership m JOIN positions p
            ON m.feature_id = p.feature_id),
wcohort AS (
  SELECT cells[1] AS sample_id,
         CASE WHEN cells[2] IN ('1') THEN 'control'
              WHEN cells[2] IN ('4', '5') THEN 'case' END AS grp,
         cells
  FROM wrows),
cohort AS (SELECT sample_id, grp, cells FROM wcohort WHERE grp IS NOT NULL),
sizes AS (SELECT grp, count(*) AS n FROM cohort GROUP BY grp),
exploded AS (
  SELECT sample_id, grp, unnest(cells) AS raw,
         unnest(generate_series(0, len(cells) - 1)) AS position
  FROM cohort),
cells AS (
  SELECT sample_id, grp, CAST(position AS INTEGER) AS position, TRY_CAST(raw AS DOUBLE) AS value
  FROM exploded WHERE position >= 2 AND TRY_CAST(raw AS DOUBLE) IS NOT NULL),
scores AS (
  SELECT c.grp, m.cluster, c.sample_id, sum(c.value) AS score
  FROM cells c JOIN pos_map m ON c.position = m.position
  GROUP BY c.grp, m.cluster, c.sample_id)"""

DELIMITED_PARSE = _with(_WIDE) + """
SELECT cells[1] AS sample_id, cells[2] AS code, CAST(len(cells) AS BIGINT) AS n_cells,
       CAST(coalesce(list_sum(list_transform(cells,
         lambda x, i: CASE WHEN i >= 3 THEN TRY_CAST(x AS BIGINT) END)), 0) AS BIGINT) AS value_sum
FROM wrows"""

ANNOTATION_EXPLODE = _with(_WIDE) + "\nSELECT cluster, feature_id FROM membership"

HEADER_POSITIONS = _with(_WIDE) + "\nSELECT feature_id, position FROM positions"

POSITION_CLUSTER_MAP = _with(_WIDE) + "\nSELECT position, cluster FROM pos_map"

UNPIVOT_LONG = _with(_WIDE) + "\nSELECT sample_id, grp, position, value FROM cells"

COHORT_STATS_WIDE = _with(_WIDE, _STATS.format(k=10)) + """
SELECT grp, cluster, n, n_scored, (round(mean, 6) + 0.0) AS mean, (round(sd, 6) + 0.0) AS sd FROM stats"""

COHORT_SIZES_WIDE = _with(_WIDE) + "\nSELECT grp, n FROM sizes"

TOP_K_CLUSTERS_WIDE = _with(_WIDE, _STATS.format(k=10)) + f"""
SELECT CAST(rank AS INTEGER) AS rank, cluster, {_ROUND_T} FROM ranked"""

SAMPLE_FEATURES_WIDE = _with(_WIDE, _STATS.format(k=10)) + f"""
SELECT s.grp, s.sample_id, CASE WHEN s.grp = 'case' THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
       {_features(10)}
FROM scores s JOIN ranked r ON s.cluster = r.cluster
GROUP BY s.grp, s.sample_id"""

_BUCKET = "('0x' || substr(md5(CAST({id} AS VARCHAR)), 1, 8))::BIGINT % 200"
_FOLD = "CASE WHEN {b} < 67 THEN 0 WHEN {b} < 134 THEN 1 ELSE 2 END"

FOLD_ASSIGNMENT = f"""
SELECT vec_id AS sample_id, {_FOLD.format(b="b")} AS fold,
       CASE WHEN b < 140 THEN 'train' ELSE 'test' END AS holdout
FROM (SELECT vec_id, {_BUCKET.format(id="vec_id")} AS b FROM embeddings)"""

# ---- background and fixed-width text ------------------------------------------

BACKGROUND_PARSE = """
WITH lines AS (
  SELECT c_mktsegment || ' customers:' || CAST(count(*) AS VARCHAR) AS value
  FROM customer GROUP BY c_mktsegment
  UNION ALL
  SELECT concat_ws(',', CAST(o_orderkey AS VARCHAR),
                   CAST(CAST(floor(c_acctbal) AS INTEGER) AS VARCHAR), o_orderstatus, c_mktsegment)
  FROM orders JOIN customer ON o_custkey = c_custkey),
p AS (SELECT value, string_split(value, ',') AS c,
             TRY_CAST(trim(string_split(value, ',')[2]) AS INTEGER) AS age FROM lines),
q AS (SELECT *, (len(c) = 4 AND age IS NOT NULL) AS ok FROM p)
SELECT CASE WHEN ok THEN c[1] END AS sample_id, CASE WHEN ok THEN age END AS age,
       CASE WHEN ok THEN c[3] END AS sex, CASE WHEN ok THEN c[4] END AS education,
       CASE WHEN NOT ok THEN value END AS _corrupt_record
FROM q"""

_LABELED = _LONG_COHORT, _STATS.format(k=10), f"""
wide AS (
  SELECT s.grp, s.sample_id,
       {_features(10)}
  FROM scores s JOIN ranked r ON s.cluster = r.cluster
  GROUP BY s.grp, s.sample_id),
background AS (
  SELECT o_orderkey AS sample_id, CAST(floor(c_acctbal) AS INTEGER) AS age
  FROM orders JOIN customer ON o_custkey = c_custkey),
points AS (
  SELECT w.sample_id, CASE WHEN w.grp = 'case' THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
         {_FOLD.format(b=_BUCKET.format(id="w.sample_id"))} AS fold,
         {_BUCKET.format(id="w.sample_id")} AS bucket, b.age,
         {", ".join(f"(round(coalesce(w.f{i:02d}, 0), 6) + 0.0)::DOUBLE AS f{i:02d}" for i in range(1, 11))}
  FROM wide w LEFT JOIN background b ON w.sample_id = b.sample_id)"""
_SCORES = ", ".join(f"f{i:02d}" for i in range(1, 11))

LABELED_POINTS = _with(*_LABELED) + f"\nSELECT sample_id, label, fold, {_SCORES} FROM points"

LABELED_POINTS_LIFE_STATS = _with(*_LABELED) + f"""
SELECT sample_id, label, fold, age::DOUBLE AS age, {_SCORES} FROM points WHERE age IS NOT NULL"""

FOLD_SPLIT_SIZES = _with(*_LABELED) + """
SELECT CAST(f.fold AS INTEGER) AS fold, p.part, count(*) AS n, sum(label) AS n_case
FROM points JOIN (VALUES (0), (1), (2)) f(fold) ON true
JOIN (VALUES ('train'), ('test')) p(part) ON (points.fold = f.fold) = (p.part = 'test')
GROUP BY f.fold, p.part"""

MODEL_ROUNDTRIP = _with(*_LABELED) + """
SELECT label, count(*) AS n_test, count(*) AS n_alike FROM points WHERE bucket >= 140
GROUP BY label"""

_ITEMS = f"""
items AS (SELECT l_linenumber >= 4 AS positive,
                 {_BUCKET.format(id="l_orderkey * 16 + l_linenumber")} AS bucket FROM lineitem)"""

THRESHOLD_TREES = _with(_ITEMS) + f""",
folded AS (SELECT positive, {_FOLD.format(b="bucket")} AS fold FROM items)
SELECT m.model, CAST(fold AS INTEGER) AS fold, count(*) AS n,
       count(*) FILTER (WHERE NOT positive) AS tn, count(*) FILTER (WHERE positive) AS tp,
       0::BIGINT AS fp, 0::BIGINT AS fn, 0::BIGINT AS errors
FROM folded JOIN (VALUES ('tree_gini'), ('tree_entropy')) m(model) ON true
GROUP BY m.model, fold"""

THRESHOLD_HOLDOUT = _with(_ITEMS) + """
SELECT count(*) AS n, count(*) FILTER (WHERE NOT positive) AS tn,
       count(*) FILTER (WHERE positive) AS tp, 0::BIGINT AS fp, 0::BIGINT AS fn,
       0::BIGINT AS errors, 0.0::DOUBLE AS error
FROM items WHERE bucket >= 140"""

BACKGROUND_QUALITY = _with(_LONG_COHORT, _STATS.format(k=10)) + """,
q AS (SELECT (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey) AS used,
             (SELECT count(DISTINCT c_mktsegment) FROM customer) AS aside),
s AS (SELECT DISTINCT sample_id FROM scores JOIN ranked USING (cluster)),
a AS (SELECT count(*) AS n, count(*) FILTER (WHERE c_custkey IS NULL OR floor(c_acctbal) < 0) AS bad
      FROM s JOIN orders ON o_orderkey = sample_id LEFT JOIN customer ON o_custkey = c_custkey)
SELECT 'lines' AS what, used + aside AS n FROM q
UNION ALL SELECT 'lines used', used FROM q
UNION ALL SELECT 'lines set aside', aside FROM q
UNION ALL SELECT 'samples', n FROM a
UNION ALL SELECT 'samples without age', bad FROM a"""

TAGGED_PART = _with(_LONG_COHORT) + """
SELECT sample_id, grp FROM cohort WHERE grp = 'case'"""

FIXED_WIDTH_GROUPS = """
WITH lines AS (
  SELECT 'PATIENT_ID,DIAGNOSIS,STATUS' AS value
  UNION ALL
  SELECT concat_ws(',', lpad(CAST(o_orderkey AS VARCHAR), 12, '0'),
                   substr(o_orderpriority, 1, 1), o_orderstatus)
  FROM orders),
g AS (SELECT substr(value, 14, 1) AS key, count(*) AS n_lines FROM lines GROUP BY 1)
SELECT key, n_lines,
       CASE WHEN TRY_CAST(key AS INTEGER) = 1 THEN 'control'
            WHEN TRY_CAST(key AS INTEGER) > 3 AND TRY_CAST(key AS INTEGER) < 6 THEN 'case'
       END AS grp
FROM g WHERE TRY_CAST(key AS INTEGER) IS NOT NULL"""

# ---- evaluation pairs -----------------------------------------------------------

_PAIRS = """
pairs AS (SELECT doc_id, CAST(quality AS DOUBLE) AS label,
                 CAST(1 - toxic AS DOUBLE) AS prediction FROM labels)"""

CONFUSION_MATRIX = _with(_PAIRS) + """,
c AS (
  SELECT count(*) AS n,
         count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
         count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
         count(*) FILTER (WHERE label <> prediction) AS errors
  FROM pairs)
SELECT n, tn, tp, fp, fn, errors,
       (round(tn / n, 6) + 0.0) AS tn_frac, (round(tp / n, 6) + 0.0) AS tp_frac,
       (round(fp / n, 6) + 0.0) AS fp_frac, (round(fn / n, 6) + 0.0) AS fn_frac,
       (round(errors / n, 6) + 0.0) AS error
FROM c"""

FOLD_ERROR_MEAN = _with(_PAIRS) + f""",
folded AS (SELECT *, {_FOLD.format(b=_BUCKET.format(id="doc_id"))} AS fold FROM pairs),
f AS (SELECT fold, count(*) AS n, count(*) FILTER (WHERE label <> prediction) AS errors
      FROM folded GROUP BY fold)
SELECT count(errors / n) AS n_folds, (round(avg(errors / n), 6) + 0.0) AS mean_error FROM f"""

# ---- text counts ----------------------------------------------------------------

_WORDS = r"""
toks AS (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS token FROM documents),
counted AS (SELECT token, count(*) AS n FROM toks WHERE length(token) > 0
            GROUP BY token HAVING count(*) >= 3)"""

WORD_COUNT_THRESHOLD = _with(_WORDS) + "\nSELECT token, n FROM counted"

CHAR_COUNT = _with(_WORDS) + """,
chars AS (SELECT unnest(list_transform(range(1, length(token) + 1),
                                       lambda i: substring(token, i, 1))) AS ch
          FROM counted)
SELECT ch, count(*) AS n FROM chars GROUP BY ch"""

LINE_COUNT_THRESHOLD = """
WITH toks AS (SELECT unnest(string_split(text, chr(10))) AS token FROM documents)
SELECT token, count(*) AS n FROM toks GROUP BY token HAVING count(*) >= 2"""


ORACLE: dict[str, str] = {
    "cohort_sizes": COHORT_SIZES,
    "cluster_scores": CLUSTER_SCORES,
    "cohort_stats": COHORT_STATS,
    "t_scores_all": T_SCORES_ALL,
    "top_k_clusters": TOP_K_CLUSTERS,
    "cluster_lookup": CLUSTER_LOOKUP,
    "sample_features": SAMPLE_FEATURES,
    "tagged_union": TAGGED_UNION,
    "delimited_parse": DELIMITED_PARSE,
    "annotation_explode": ANNOTATION_EXPLODE,
    "header_positions": HEADER_POSITIONS,
    "position_cluster_map": POSITION_CLUSTER_MAP,
    "unpivot_long": UNPIVOT_LONG,
    "cohort_stats_wide": COHORT_STATS_WIDE,
    "cohort_sizes_wide": COHORT_SIZES_WIDE,
    "top_k_clusters_wide": TOP_K_CLUSTERS_WIDE,
    "sample_features_wide": SAMPLE_FEATURES_WIDE,
    "fold_assignment": FOLD_ASSIGNMENT,
    "background_parse": BACKGROUND_PARSE,
    "background_csv_parse": BACKGROUND_PARSE,
    "background_quality": BACKGROUND_QUALITY,
    "tagged_part": TAGGED_PART,
    "top_k_clusters_landed": TOP_K_CLUSTERS_WIDE,
    "labeled_points": LABELED_POINTS,
    "labeled_points_life_stats": LABELED_POINTS_LIFE_STATS,
    "fold_split_sizes": FOLD_SPLIT_SIZES,
    "threshold_trees": THRESHOLD_TREES,
    "threshold_holdout": THRESHOLD_HOLDOUT,
    "model_roundtrip": MODEL_ROUNDTRIP,
    "fixed_width_groups": FIXED_WIDTH_GROUPS,
    "confusion_matrix": CONFUSION_MATRIX,
    "fold_error_mean": FOLD_ERROR_MEAN,
    "word_count_threshold": WORD_COUNT_THRESHOLD,
    "char_count": CHAR_COUNT,
    "line_count_threshold": LINE_COUNT_THRESHOLD,
}
