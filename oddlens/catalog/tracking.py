"""Stability over months and splits, and correlation between features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from oddlens.catalog.base import CELLS_SQL, FEATURES, IDS, NUMERIC, PAIRS_SQL, SAMPLES_SQL, bad, check, dated, rounded, scored, split_samples
from oddlens.catalog.diagnosing import _MONTH_KS
from oddlens.operators import binning, correlation, discrimination, stability
from oddlens.sources.stages import stage

FULL = ["o_totalprice", "c_acctbal", "c_nationkey"]


def monthly_psi(spark: SparkSession, folder: str) -> DataFrame:
    rows = dated(spark, folder)
    return rounded(stability.monthly_psi(rows, binning.fit_bins(rows, FEATURES)))


def monthly_psi_plus_one(spark: SparkSession, folder: str) -> DataFrame:
    rows = dated(spark, folder)
    return rounded(stability.monthly_psi(rows, binning.fit_bins(rows, FEATURES), smoothing=1.0))


def monthly_psi_of_baseline(spark: SparkSession, folder: str) -> DataFrame:
    """The same against a chosen month."""
    rows = dated(spark, folder)
    return rounded(stability.monthly_psi(rows, binning.fit_bins(rows, FEATURES), baseline="199806"))


def psi_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = dated(spark, folder)
    return rounded(stability.psi_summary(stability.monthly_psi(rows, binning.fit_bins(rows, FEATURES))))


def monthly_sample(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stability.monthly_sample(dated(spark, folder), bad()))


def monthly_discrimination(spark: SparkSession, folder: str) -> DataFrame:
    rows = dated(spark, folder)
    fitted = binning.fit_bins(rows, FEATURES)
    psi = stability.monthly_psi(rows, fitted)
    return rounded(discrimination.monthly_discrimination(rows, fitted, bad(), IDS, monthly_psi=psi))


def monthly_discrimination_all_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Counts that include rows with a missing value."""
    rows = dated(spark, folder)
    fitted = binning.fit_bins(rows, FEATURES)
    return rounded(
        discrimination.monthly_discrimination(rows, fitted, bad(), IDS, include_missing=True).select(
            "feature", "event_month", "ks", "auc", "sample_count", "bad_count", "bad_rate", "sample_rate"
        )
    )


def split_psi(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stability.split_psi(split_samples(spark, folder), FEATURES))


def score_psi(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stability.score_psi(scored(spark, folder), "score"))


def score_psi_interpolated(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stability.score_psi(scored(spark, folder), "score", edges="linear", smoothing=1e-6))


def stability_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = dated(spark, folder)
    psi = stage(stability.monthly_psi(rows, binning.fit_bins(rows, FEATURES)))
    return rounded(stability.stability_summary(psi, stability.monthly_sample(rows, bad()), max_psi=0.10))


def pearson_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(correlation.pearson_pairs(dated(spark, folder), NUMERIC))


def spearman_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(correlation.spearman_pairs(dated(spark, folder), [*FULL, "sum_qty"]))


def spearman_pairs_of_all_columns(spark: SparkSession, folder: str) -> DataFrame:
    """The same for every numeric column."""
    return rounded(correlation.spearman_pairs(dated(spark, folder), NUMERIC))


def average_ranks(spark: SparkSession, folder: str) -> DataFrame:
    ranks = correlation.average_ranks(dated(spark, folder), ["c_nationkey", "line_cnt", "sum_qty"])
    return rounded(ranks)


def average_ranks_of_all_columns(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(correlation.average_ranks(dated(spark, folder), NUMERIC))


def correlation_matrix(spark: SparkSession, folder: str) -> DataFrame:
    pairs = correlation.pearson_pairs(dated(spark, folder), NUMERIC)
    return rounded(correlation.correlation_matrix(pairs, NUMERIC))


def filled_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(correlation.filled_pairs(dated(spark, folder), NUMERIC).drop("method"))


def max_correlation(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(correlation.max_correlation(correlation.filled_pairs(dated(spark, folder), NUMERIC)))


QUERIES = {
    f.__name__: f
    for f in (
        monthly_psi, monthly_psi_plus_one, monthly_psi_of_baseline, psi_summary, monthly_sample, monthly_discrimination,
        monthly_discrimination_all_rows, split_psi, score_psi, score_psi_interpolated, stability_summary, pearson_pairs,
        spearman_pairs, spearman_pairs_of_all_columns, average_ranks, average_ranks_of_all_columns, correlation_matrix, filled_pairs, max_correlation,
    )
}

_DIRECTION = _MONTH_KS + """,
gvc AS (SELECT feature, score, sum(n) AS n, sum(b) AS b FROM mvc GROUP BY 1, 2),
grk AS (SELECT *, sum(n) OVER (PARTITION BY feature ORDER BY score) AS cn, sum(n) OVER (PARTITION BY feature) AS tn, sum(b) OVER (PARTITION BY feature) AS tb FROM gvc),
dir AS (SELECT feature, (sum(b*(cn-n+(n+1)/2e0)) - max(tb)*(max(tb)+1)/2e0)/(max(tb)*CAST(max(tn)-max(tb) AS DOUBLE)) >= 0.5 AS down FROM grk GROUP BY 1),
lifted AS (
  SELECT m.event_month, m.feature, m.bad, row_number() OVER (PARTITION BY m.event_month, m.feature ORDER BY CASE WHEN d.down THEN -m.score ELSE m.score END, m.o_orderkey) AS rn,
    count(*) OVER (PARTITION BY m.event_month, m.feature) AS tn, sum(m.bad) OVER (PARTITION BY m.event_month, m.feature) AS tb
  FROM mscore m JOIN dir d USING (feature)),
lift AS (SELECT event_month, feature, (sum(bad) FILTER (rn <= ceil(tn*0.1e0))/ceil(max(tn)*0.1e0))/nullif(max(tb)/max(tn), 0) AS lift_10 FROM lifted GROUP BY 1, 2)
"""
_SPLIT_PSI = CELLS_SQL + """,
sc AS (SELECT c.*, t.dataset FROM cells c JOIN time_manifest t USING (event_month) WHERE c.num IS NOT NULL OR c.txt IS NOT NULL),
cuts AS (SELECT feature, quantile_cont(num, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS es FROM sc WHERE dataset = 'train' AND num IS NOT NULL GROUP BY 1),
alpha AS (SELECT feature, txt, row_number() OVER (PARTITION BY feature ORDER BY txt) AS p FROM (SELECT DISTINCT feature, txt FROM sc WHERE dataset = 'train' AND txt IS NOT NULL)),
sb AS (
  SELECT s.dataset, s.feature, CASE WHEN s.num IS NOT NULL THEN len(list_filter(list_distinct(c.es), lambda x: x < s.num)) WHEN a.p <= 9 THEN a.p - 1 ELSE 9 END AS bin, count(*) AS n
  FROM sc s LEFT JOIN cuts c ON s.feature = c.feature LEFT JOIN alpha a ON s.feature = a.feature AND s.txt = a.txt GROUP BY 1, 2, 3),
st AS (SELECT dataset, feature, sum(n) AS t FROM sb GROUP BY 1, 2),
sg AS (SELECT st.dataset, st.feature, b.bin, coalesce(sb.n, 0) AS n, st.t, count(*) OVER (PARTITION BY st.dataset, st.feature) AS k
  FROM st JOIN (SELECT DISTINCT feature, bin FROM sb) b ON st.feature = b.feature LEFT JOIN sb ON sb.dataset = st.dataset AND sb.feature = st.feature AND sb.bin = b.bin),
split_psi AS (
  SELECT g.feature, g.dataset, sum(((g.n+0.5e0)/(g.t+0.5e0*g.k) - (h.n+0.5e0)/(h.t+0.5e0*h.k)) * ln(((g.n+0.5e0)/(g.t+0.5e0*g.k)) / ((h.n+0.5e0)/(h.t+0.5e0*h.k)))) AS psi
  FROM sg g JOIN sg h ON g.feature = h.feature AND g.bin = h.bin AND h.dataset = 'train' GROUP BY 1, 2)
"""


def score_psi_sql(edges: str, pad: str) -> str:
    return SAMPLES_SQL + f""",
tv AS (SELECT score, count(*) AS n FROM scored WHERE dataset = 'train' GROUP BY 1),
tr AS (SELECT score, n, sum(n) OVER (ORDER BY score) AS cn, sum(n) OVER () AS tn FROM tv),
se AS ({edges}),
sbk AS (SELECT dataset, len(list_filter((SELECT es FROM se), lambda x: x < score)) AS bin, count(*) AS n FROM scored GROUP BY 1, 2),
sup AS (SELECT unnest(range(len(es) + 1)) AS bin, len(es) + 1 AS k FROM se),
sgd AS (SELECT t.dataset, sup.bin, coalesce(b.n, 0) AS n, t.t, sup.k FROM (SELECT dataset, count(*) AS t FROM scored GROUP BY 1) t, sup LEFT JOIN sbk b ON b.dataset = t.dataset AND b.bin = sup.bin),
score_psi AS (
  SELECT g.dataset, sum(((g.n+{pad})/(g.t+{pad}*g.k) - (h.n+{pad})/(h.t+{pad}*h.k)) * ln(((g.n+{pad})/(g.t+{pad}*g.k)) / ((h.n+{pad})/(h.t+{pad}*h.k)))) AS score_psi
  FROM sgd g JOIN sgd h ON g.bin = h.bin AND h.dataset = 'train' GROUP BY 1)
"""


QUANTILE_SCORE_EDGES = "SELECT list(DISTINCT score ORDER BY score) AS es FROM tr, generate_series(1, 9) AS g(i) WHERE round_even(CAST(i*(tn-1) AS DOUBLE)/10, 0) >= cn - n AND round_even(CAST(i*(tn-1) AS DOUBLE)/10, 0) < cn"
_LINEAR_SCORE_EDGES = "SELECT list_sort(list_distinct(quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) AS es FROM scored WHERE dataset = 'train'"
_FILLED = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM samples)) AS {c}" for c in NUMERIC)
_FILLED_PAIRS = SAMPLES_SQL + f",\nfilled AS (SELECT {_FILLED} FROM samples),\nfp AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr({a}, {b}) AS correlation, count(*) AS pair_count FROM filled"
    for i, a in enumerate(NUMERIC)
    for b in NUMERIC[i + 1 :]
) + ")"


def _spearman(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr(x, y) AS correlation, count(*) AS pair_count FROM (
      SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1)/2e0 AS x, rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1)/2e0 AS y
      FROM samples WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""
        for i, a in enumerate(columns)
        for b in columns[i + 1 :]
    )


_SPEARMAN = _spearman([*FULL, "sum_qty"])
_MATRIX = " UNION ALL ".join(
    f"SELECT '{a}' AS feature, "
    + ", ".join(
        "1.0 AS " + b if a == b else f"(SELECT correlation FROM pearson WHERE (feature_1 = '{a}' AND feature_2 = '{b}') OR (feature_1 = '{b}' AND feature_2 = '{a}')) AS {b}"
        for b in NUMERIC
    )
    for a in NUMERIC
)

CHECKS = {
    "monthly_psi": check(CELLS_SQL, "SELECT feature, event_month, baseline_month, psi FROM mpsi", ["psi"]),
    "monthly_psi_plus_one": check(CELLS_SQL, "SELECT feature, event_month, baseline_month, psi_one AS psi FROM mpsi", ["psi"]),
    "monthly_psi_of_baseline": check(
        CELLS_SQL.replace("(SELECT min(event_month) FROM months)", "'199806'"), "SELECT feature, event_month, baseline_month, psi FROM mpsi", ["psi"]
    ),
    "psi_summary": check(CELLS_SQL, "SELECT *, max_psi >= 0.25 AS psi_warning FROM psi_sum", ["average_psi", "max_psi"]),
    "monthly_sample": check(
        SAMPLES_SQL + ", b AS (SELECT * FROM months ORDER BY event_month LIMIT 1)",
        """SELECT m.event_month, m.sample_count, m.bad_count, m.sample_count - m.bad_count AS good_count, m.bad_count/m.sample_count AS bad_rate, b.event_month AS baseline_month,
          CASE WHEN m.event_month = b.event_month THEN 0 ELSE
          ((m.bad_count+0.5e0)/(m.sample_count+1) - (b.bad_count+0.5e0)/(b.sample_count+1)) * ln(((m.bad_count+0.5e0)/(m.sample_count+1))/((b.bad_count+0.5e0)/(b.sample_count+1)))
          + ((m.sample_count-m.bad_count+0.5e0)/(m.sample_count+1) - (b.sample_count-b.bad_count+0.5e0)/(b.sample_count+1)) * ln(((m.sample_count-m.bad_count+0.5e0)/(m.sample_count+1))/((b.sample_count-b.bad_count+0.5e0)/(b.sample_count+1))) END AS psi
        FROM months m, b""",
        ["bad_rate", "psi"], ["bad_count", "good_count"],
    ),
    "monthly_discrimination": check(
        _DIRECTION,
        """SELECT c.feature, c.event_month, k.ks, greatest(k.auc_raw, 1 - k.auc_raw) AS auc, l.lift_10, coalesce(k.sample_count, 0) AS sample_count, coalesce(k.bad_count, 0) AS bad_count,
          coalesce(k.sample_count - k.bad_count, 0) AS good_count, k.bad_count/k.sample_count AS bad_rate, coalesce(k.sample_count, 0)/(SELECT count(*) FROM samples) AS sample_rate,
          CASE WHEN d.down THEN 'descending' ELSE 'ascending' END AS direction, coalesce(p.psi, 0) AS psi
        FROM (SELECT DISTINCT feature, event_month FROM cells) c LEFT JOIN mks k USING (feature, event_month) LEFT JOIN lift l USING (feature, event_month)
          LEFT JOIN mpsi p USING (feature, event_month) JOIN dir d USING (feature)""",
        ["ks", "auc", "lift_10", "bad_rate", "sample_rate", "psi"], ["sample_count", "bad_count", "good_count"],
    ),
    "monthly_discrimination_all_rows": check(
        _MONTH_KS,
        """SELECT c.feature, c.event_month, k.ks, greatest(k.auc_raw, 1 - k.auc_raw) AS auc, c.n AS sample_count, c.b AS bad_count, c.b/c.n AS bad_rate, c.n/(SELECT count(*) FROM samples) AS sample_rate
        FROM (SELECT feature, event_month, count(*) AS n, sum(bad) AS b FROM cells GROUP BY 1, 2) c LEFT JOIN mks k USING (feature, event_month)""",
        ["ks", "auc", "bad_rate", "sample_rate"], ["bad_count"],
    ),
    "split_psi": check(_SPLIT_PSI, "SELECT * FROM split_psi", ["psi"]),
    "score_psi": check(score_psi_sql(QUANTILE_SCORE_EDGES, "0.5e0"), "SELECT * FROM score_psi", ["score_psi"]),
    "score_psi_interpolated": check(score_psi_sql(_LINEAR_SCORE_EDGES, "1e-6"), "SELECT * FROM score_psi", ["score_psi"]),
    "stability_summary": check(
        CELLS_SQL,
        """SELECT f.feature, coalesce(max(psi), 0) AS max_monthly_psi, coalesce(avg(CAST(psi > 0.1 AS DOUBLE)), 0) AS unstable_month_ratio, count(psi) AS eligible_month_count
        FROM (SELECT DISTINCT feature FROM mpsi) f LEFT JOIN (SELECT p.* FROM mpsi p JOIN months m USING (event_month) WHERE m.sample_count >= 100 AND p.event_month <> p.baseline_month) q USING (feature) GROUP BY 1""",
        ["max_monthly_psi", "unstable_month_ratio"],
    ),
    "pearson_pairs": check(PAIRS_SQL, "SELECT *, 'pearson' AS method FROM pearson", ["correlation", "abs_correlation"]),
    "spearman_pairs": check(SAMPLES_SQL, f"SELECT *, abs(correlation) AS abs_correlation, 'spearman' AS method FROM ({_SPEARMAN})", ["correlation", "abs_correlation"]),
    "spearman_pairs_of_all_columns": check(SAMPLES_SQL, f"SELECT *, abs(correlation) AS abs_correlation, 'spearman' AS method FROM ({_spearman(NUMERIC)})", ["correlation", "abs_correlation"]),
    "average_ranks_of_all_columns": check(CELLS_SQL, f"SELECT feature, num, cum_n - n + (n+1)/2e0 AS rank FROM ranked WHERE feature IN ({', '.join(repr(c) for c in NUMERIC)})", ["num", "rank"]),
    "average_ranks": check(CELLS_SQL, "SELECT feature, num, cum_n - n + (n+1)/2e0 AS rank FROM ranked WHERE feature IN ('c_nationkey', 'line_cnt', 'sum_qty')", ["num", "rank"]),
    "correlation_matrix": check(PAIRS_SQL, _MATRIX, NUMERIC),
    "filled_pairs": check(_FILLED_PAIRS, "SELECT *, abs(correlation) AS abs_correlation FROM fp", ["correlation", "abs_correlation"]),
    "max_correlation": check(
        _FILLED_PAIRS,
        "SELECT feature, coalesce(max(abs(correlation)) FILTER (abs(correlation) < 0.999999), 0) AS max_correlation FROM (SELECT feature_1 AS feature, correlation FROM fp UNION ALL SELECT feature_2, correlation FROM fp) GROUP BY 1",
        ["max_correlation"],
    ),
}
