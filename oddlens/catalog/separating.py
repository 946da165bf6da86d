"""Bins and single-feature discrimination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddlens.catalog.base import (
    CATEGORICAL,
    CELLS_SQL,
    FEATURES,
    IDS,
    NUMERIC,
    SAMPLES_SQL,
    bad,
    check,
    dated,
    lines,
    rounded,
    split_samples,
)
from oddlens.functions.columns import edge_bin, is_bad
from oddlens.operators import binning, discrimination
from oddlens.operators.binning import NumericBins


def _edge_rows(edges: DataFrame) -> DataFrame:
    return rounded(edges.select("feature", F.posexplode("edges").alias("position", "edge")))


def quantile_edges(spark: SparkSession, folder: str) -> DataFrame:
    return _edge_rows(binning.ranked_edges(binning.ranked_values(dated(spark, folder), NUMERIC, bad()), 10))


def distinct_edges(spark: SparkSession, folder: str) -> DataFrame:
    ranked = binning.ranked_values(dated(spark, folder), NUMERIC, bad())
    return _edge_rows(binning.ranked_edges(ranked, 10, weight="distinct"))


def interpolated_edges(spark: SparkSession, folder: str) -> DataFrame:
    ranked = binning.ranked_values(dated(spark, folder), NUMERIC, bad())
    found = binning.ranked_quantiles(ranked, [i / 10 for i in range(1, 10)])
    return rounded(found.select("feature", F.posexplode("quantiles").alias("position", "edge")))


def sketched_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Bin sizes under sketch edges; exact in rank to 1 in 10 000."""
    rows = dated(spark, folder)
    counts = binning.bin_counts(rows, binning.fit_bins(rows, NUMERIC, method="approx"), bad())
    return counts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def edge_sides(spark: SparkSession, folder: str) -> DataFrame:
    """The same edges with values on an edge going up or down."""
    edges = [5.0, 10.0, 20.0, 30.0, 45.0]
    quantity = F.col("l_quantity")
    return lines(spark, folder).groupBy(
        edge_bin(quantity, edges, "right").alias("right_bin"), edge_bin(quantity, edges, "left").alias("left_bin")
    ).agg(F.count("*").alias("n"))


def category_bins(spark: SparkSession, folder: str) -> DataFrame:
    """Four bins for five categories, so the rarest one lands in OTHER."""
    rows = dated(spark, folder)
    fitted = binning.fit_bins(rows, CATEGORICAL, max_categories=5)
    labels = binning.bin_labels(rows, fitted)
    return binning.bin_counts(rows, fitted, bad()).join(labels, ["feature", "bin"]).select("feature", "bin", "label", "n", "bad")


def bin_detail(spark: SparkSession, folder: str) -> DataFrame:
    rows = dated(spark, folder)
    fitted = binning.fit_bins(rows, FEATURES)
    return rounded(binning.bin_detail(binning.bin_counts(rows, fitted, bad())).drop("label"))


def bin_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Printed interval of each bin; the upper bound is written closed, although a
    value equal to it belongs to the next bin."""
    rows = dated(spark, folder)
    fitted = binning.fit_bins(rows, FEATURES)
    detail = binning.bin_detail(binning.bin_counts(rows, fitted, bad()), binning.bin_labels(rows, fitted))
    return detail.select("feature", "bin_order", "label", "sample_count")


def chi_bins(spark: SparkSession, folder: str) -> DataFrame:
    rows = dated(spark, folder)
    fitted = binning.fit_bins(rows, NUMERIC, bins=6, method="chi", bad=bad())
    return rounded(binning.bin_detail(binning.bin_counts(rows, fitted, bad())).select("feature", "bin_order", "sample_count", "bad_count", "iv_bin"))


def raw_rank_metrics(spark: SparkSession, folder: str) -> DataFrame:
    ranked = binning.ranked_values(dated(spark, folder), NUMERIC, bad())
    return rounded(discrimination.rank_metrics(ranked, ["feature"]))


def univariate_overview(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(discrimination.univariate_overview(dated(spark, folder), FEATURES, bad()).drop("variable_type"))


def bin_entropy(spark: SparkSession, folder: str) -> DataFrame:
    rows = dated(spark, folder)
    detail = binning.bin_detail(binning.bin_counts(rows, binning.fit_bins(rows, FEATURES), bad()))
    return rounded(binning.bin_summary(detail).select("feature", "entropy"))


def value_entropy(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(binning.value_entropy(dated(spark, folder), FEATURES))


def top_decile_lift(spark: SparkSession, folder: str) -> DataFrame:
    rows = dated(spark, folder)
    return rounded(discrimination.top_share_lift(rows, binning.fit_bins(rows, FEATURES), bad(), IDS))


def ks_buckets(spark: SparkSession, folder: str) -> DataFrame:
    rows = dated(spark, folder)
    return rounded(discrimination.ks_buckets(rows, binning.fit_bins(rows, FEATURES), bad(), IDS))


def ks_from_bins(spark: SparkSession, folder: str) -> DataFrame:
    rows = dated(spark, folder)
    detail = binning.bin_detail(binning.bin_counts(rows, binning.fit_bins(rows, FEATURES), bad()))
    return rounded(detail.select("feature", "bin_order", "sample_count", "bad_count", "bad_rate", "cumulative_ks"))


def target_mean_gini(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(discrimination.target_mean_gini(split_samples(spark, folder), FEATURES, bad(), ["dataset"]))


def variable_information(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(discrimination.variable_information(split_samples(spark, folder), FEATURES, bad()))


def line_tax_woe(spark: SparkSession, folder: str) -> DataFrame:
    """WOE of hand-set tax bands on the labelled line items."""
    rows = lines(spark, folder).where("label in (0, 1)")
    bands = {"l_tax": NumericBins((0.02, 0.04, 0.06)), "l_returnflag": binning.CategoryBins(("A", "N", "R"))}
    return rounded(
        binning.bin_detail(binning.bin_counts(rows, bands, is_bad("label"))).select("feature", "bin", "sample_count", "bad_count", "woe", "iv_bin", "ks")
    )


QUERIES = {
    f.__name__: f
    for f in (
        quantile_edges, distinct_edges, interpolated_edges, sketched_edges, edge_sides, category_bins, bin_detail, bin_labels,
        chi_bins, raw_rank_metrics, univariate_overview, bin_entropy, value_entropy, top_decile_lift, ks_buckets,
        ks_from_bins, target_mean_gini, variable_information, line_tax_woe,
    )
}

_MOMENTS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, " + (f"avg({c}) AS mean, stddev_samp({c}) AS std FROM samples" if c in NUMERIC else "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std")
    for c in FEATURES
)
# Score of every non-missing cell: the number, or the bin index of a category.
CELL_SCORES = """
cscore AS (
  SELECT c.event_month, c.feature, c.o_orderkey, c.bad, coalesce(c.num, CAST(v.bin AS DOUBLE)) AS score
  FROM cells c LEFT JOIN value_bin v ON c.feature = v.feature AND c.txt = v.txt AND v.num IS NULL
  WHERE c.num IS NOT NULL OR c.txt IS NOT NULL),
crank AS (
  SELECT *, row_number() OVER (PARTITION BY feature ORDER BY score DESC, o_orderkey) AS rn,
    count(*) OVER (PARTITION BY feature) AS tn, sum(bad) OVER (PARTITION BY feature) AS tb FROM cscore)
"""
_BUCKETS = """
kb AS (
  SELECT feature, CAST(floor((rn-1)/ceil(tn/10e0)) + 1 AS INTEGER) AS bucket, min(score) AS score_min, max(score) AS score_max,
    count(*) AS sample_count, sum(bad) AS bad_count, max(tn) AS tn, max(tb) AS tb FROM crank GROUP BY 1, 2),
kr AS (SELECT *, sum(sample_count) OVER w AS cn, sum(bad_count) OVER w AS cb FROM kb WINDOW w AS (PARTITION BY feature ORDER BY bucket))
"""

# Value counts per split, used for metrics measured inside each split.
SPLIT_CELLS = SAMPLES_SQL + ",\nscells AS (" + " UNION ALL ".join(
    f"SELECT dataset, o_orderkey, bad, '{c}' AS feature, {'CAST(' + c + ' AS DOUBLE)' if c in NUMERIC else 'CAST(NULL AS DOUBLE)'} AS num, {'CAST(NULL AS VARCHAR)' if c in NUMERIC else c} AS txt, {str(c in NUMERIC).lower()} AS is_num FROM scored"
    for c in FEATURES
) + """),
svc AS (SELECT dataset, feature, is_num, num, txt, count(*) AS n, sum(bad) AS bad FROM scells GROUP BY ALL),
sent AS (SELECT dataset, feature, -sum(n/t*log2(n/t)) AS entropy FROM (SELECT *, sum(n) OVER (PARTITION BY dataset, feature) AS t FROM svc) GROUP BY 1, 2),
sgs AS (SELECT dataset, feature, CASE WHEN is_num THEN coalesce(num, 0) ELSE bad/n END AS s, sum(n) AS n, sum(bad) AS b FROM svc GROUP BY 1, 2, 3),
sgr AS (SELECT *, sum(n) OVER w AS cn, sum(n) OVER p AS tn, sum(b) OVER p AS tb FROM sgs WINDOW w AS (PARTITION BY dataset, feature ORDER BY s), p AS (PARTITION BY dataset, feature)),
sgini AS (SELECT dataset, feature, 2*(sum(b*(cn-n+(n+1)/2e0)) - max(tb)*(max(tb)+1)/2e0)/(max(tb)*CAST(max(tn)-max(tb) AS DOUBLE)) - 1 AS gini FROM sgr GROUP BY 1, 2),
srk AS (SELECT dataset, feature, num, n, sum(n) OVER (PARTITION BY dataset, feature ORDER BY num) AS cn, sum(n) OVER (PARTITION BY dataset, feature) AS tn FROM svc WHERE num IS NOT NULL),
sedge AS (
  SELECT dataset, feature, list(DISTINCT num ORDER BY num) AS es FROM srk, generate_series(1, 9) AS g(i)
  WHERE round_even(CAST(i*(tn-1) AS DOUBLE)/10, 0) >= cn - n AND round_even(CAST(i*(tn-1) AS DOUBLE)/10, 0) < cn GROUP BY 1, 2),
scat AS (SELECT dataset, feature, txt, row_number() OVER (PARTITION BY dataset, feature ORDER BY sum(n) DESC, txt) AS p FROM svc WHERE txt IS NOT NULL GROUP BY 1, 2, 3),
sbin AS (
  SELECT v.dataset, v.feature, CASE WHEN v.num IS NOT NULL THEN len(list_filter(e.es, lambda x: x <= v.num)) WHEN v.txt IS NOT NULL THEN least(c.p - 1, 19) ELSE -1 END AS bin, sum(v.n) AS n, sum(v.bad) AS b
  FROM svc v LEFT JOIN sedge e ON v.dataset = e.dataset AND v.feature = e.feature LEFT JOIN scat c ON v.dataset = c.dataset AND v.feature = c.feature AND v.txt = c.txt GROUP BY 1, 2, 3),
siv0 AS (SELECT *, count(*) OVER p AS k, sum(n) OVER p AS tn, sum(b) OVER p AS tb FROM sbin WINDOW p AS (PARTITION BY dataset, feature)),
siv AS (
  SELECT dataset, feature, sum(((b+0.5e0)/(tb+0.5e0*k) - (n-b+0.5e0)/(tn-tb+0.5e0*k)) * ln(((b+0.5e0)/(tb+0.5e0*k)) / ((n-b+0.5e0)/(tn-tb+0.5e0*k)))) AS iv,
    coalesce(sum(n/tn) FILTER (bin < 0), 0) AS missing_rate FROM siv0 GROUP BY 1, 2)
"""
_INFO = [f"{d}_{m}" for d in ("train", "test", "oot", "validation") for m in ("iv", "missing_rate", "entropy", "gini")]
_INFO_SQL = "SELECT feature, " + ", ".join(
    f"max({m}) FILTER (dataset = '{'test' if d == 'validation' else d}') AS {d}_{m}"
    for d in ("train", "test", "oot", "validation")
    for m in ("iv", "missing_rate", "entropy", "gini")
) + " FROM siv JOIN sent USING (dataset, feature) JOIN sgini USING (dataset, feature) GROUP BY 1"
_DISTINCT = """
dist AS (
  SELECT feature, list(DISTINCT num ORDER BY num) AS es FROM ranked, generate_series(1, 9) AS g(i)
  WHERE tot_d > 1 AND round_even(CAST(i*(tot_d-1) AS DOUBLE)/10, 0) = d - 1 GROUP BY 1)
"""
_DETAIL_DOUBLES = ["sample_rate", "bad_rate", "bad_distribution", "good_distribution", "woe", "iv_bin", "cumulative_iv", "ks", "cumulative_ks"]
_CUMULATIVE = "sum(iv_bin) OVER (PARTITION BY feature ORDER BY bin_order) AS cumulative_iv, coalesce(max(ks) OVER (PARTITION BY feature ORDER BY bin_order), 0) AS cumulative_ks"

CHECKS = {
    "quantile_edges": check(CELLS_SQL, "SELECT feature, generate_subscripts(es, 1) - 1 AS position, unnest(es) AS edge FROM edges", ["edge"], ints=["position"]),
    "distinct_edges": check(CELLS_SQL + "," + _DISTINCT, "SELECT feature, generate_subscripts(es, 1) - 1 AS position, unnest(es) AS edge FROM dist", ["edge"], ints=["position"]),
    "interpolated_edges": check(
        CELLS_SQL + ", q AS (SELECT feature, quantile_cont(num, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS es FROM cells WHERE num IS NOT NULL GROUP BY 1)",
        "SELECT feature, generate_subscripts(es, 1) - 1 AS position, unnest(es) AS edge FROM q", ["edge"], ints=["position"],
    ),
    "sketched_edges": check(CELLS_SQL, "SELECT feature, count(*) AS n, sum(bad) AS bad FROM cells WHERE feature IN (" + ", ".join(f"'{c}'" for c in NUMERIC) + ") GROUP BY 1", longs=["bad"]),
    "edge_sides": check(
        "",
        "SELECT CAST(l_quantity >= 5 AS INTEGER) + CAST(l_quantity >= 10 AS INTEGER) + CAST(l_quantity >= 20 AS INTEGER) + CAST(l_quantity >= 30 AS INTEGER) + CAST(l_quantity >= 45 AS INTEGER) AS right_bin, "
        "CAST(l_quantity > 5 AS INTEGER) + CAST(l_quantity > 10 AS INTEGER) + CAST(l_quantity > 20 AS INTEGER) + CAST(l_quantity > 30 AS INTEGER) + CAST(l_quantity > 45 AS INTEGER) AS left_bin, count(*) AS n FROM lineitem GROUP BY 1, 2",
    ),
    "category_bins": check(
        CELLS_SQL,
        "SELECT v.feature, CAST(least(c.p - 1, 4) AS INTEGER) AS bin, CASE WHEN c.p <= 4 THEN v.txt ELSE 'OTHER' END AS label, sum(v.n) AS n, sum(v.bad) AS bad FROM vc v JOIN cats c ON v.feature = c.feature AND v.txt = c.txt GROUP BY 1, 2, 3",
        longs=["n", "bad"],
    ),
    "bin_detail": check(CELLS_SQL, f"SELECT *, {_CUMULATIVE} FROM detail", _DETAIL_DOUBLES, ["sample_count", "bad_count", "good_count"], ["bin_order"]),
    "bin_labels": check(
        CELLS_SQL,
        """SELECT d.feature, d.bin_order, CASE WHEN d.bin = -1 THEN 'MISSING' WHEN c.txt IS NOT NULL THEN c.txt
          ELSE '(' || CASE WHEN d.bin = 0 THEN '-inf' ELSE format('{:.6g}', es[d.bin]) END || ', ' || CASE WHEN d.bin = len(es) THEN 'inf)' ELSE format('{:.6g}', es[d.bin+1]) || ']' END END AS label, d.sample_count
        FROM detail d LEFT JOIN edges e USING (feature) LEFT JOIN cats c ON d.feature = c.feature AND d.bin = c.p - 1""",
        longs=["sample_count"], ints=["bin_order"],
    ),
    "raw_rank_metrics": check(CELLS_SQL, "SELECT feature, sample_count, bad_count, sample_count - bad_count AS good_count, ks, auc_raw, greatest(auc_raw, 1 - auc_raw) AS auc FROM raw_metrics", ["ks", "auc_raw", "auc"], ["sample_count", "bad_count", "good_count"]),
    "univariate_overview": check(CELLS_SQL, f"SELECT o.*, m.mean, m.std FROM overview o JOIN ({_MOMENTS}) m USING (feature)", ["iv", "ks", "ks_raw", "auc", "missing_rate", "mean", "std"]),
    "bin_entropy": check(CELLS_SQL, "SELECT feature, entropy FROM bin_sum", ["entropy"]),
    "value_entropy": check(CELLS_SQL, "SELECT feature, -sum(n/t*log2(n/t)) AS entropy FROM (SELECT *, sum(n) OVER (PARTITION BY feature) AS t FROM vc) GROUP BY 1", ["entropy"]),
    "top_decile_lift": check(
        CELLS_SQL + "," + CELL_SCORES,
        "SELECT feature, CAST(ceil(max(tn)*0.1e0) AS BIGINT) AS top_size, sum(bad) FILTER (rn <= ceil(tn*0.1e0)) AS top_bad, (sum(bad) FILTER (rn <= ceil(tn*0.1e0))/ceil(max(tn)*0.1e0))/(max(tb)/max(tn)) AS lift FROM crank GROUP BY 1",
        ["lift"], ["top_bad"],
    ),
    "ks_buckets": check(
        CELLS_SQL + "," + CELL_SCORES + "," + _BUCKETS,
        """SELECT feature, bucket, score_min, score_max, sample_count, bad_count, sample_count - bad_count AS good_count, bad_count/sample_count AS bad_rate,
          (sample_count-bad_count)/sample_count AS good_rate, bad_count/tb AS bad_distribution, (sample_count-bad_count)/(tn-tb) AS good_distribution,
          cb/tb AS cumulative_bad_capture, (cn-cb)/(tn-tb) AS cumulative_good_capture, cn/tn AS cumulative_sample_rate, abs(cb/tb - (cn-cb)/(tn-tb)) AS ks,
          (bad_count/sample_count)/(tb/tn) AS lift, (cb/tb)/(cn/tn) AS cumulative_lift FROM kr""",
        ["score_min", "score_max", "bad_rate", "good_rate", "bad_distribution", "good_distribution", "cumulative_bad_capture", "cumulative_good_capture", "cumulative_sample_rate", "ks", "lift", "cumulative_lift"],
        ["bad_count", "good_count"],
    ),
    "ks_from_bins": check(CELLS_SQL, f"SELECT feature, bin_order, sample_count, bad_count, bad_rate, cumulative_ks FROM (SELECT *, {_CUMULATIVE} FROM detail)", ["bad_rate", "cumulative_ks"], ["sample_count", "bad_count"], ["bin_order"]),
    "target_mean_gini": check(SPLIT_CELLS, "SELECT * FROM sgini", ["gini"]),
    "variable_information": check(SPLIT_CELLS, _INFO_SQL, _INFO),
    "line_tax_woe": check(
        SAMPLES_SQL + """,
        lb AS (
          SELECT 'l_tax' AS feature, CASE WHEN l_tax IS NULL THEN -1 ELSE CAST(l_tax >= 0.02 AS INTEGER) + CAST(l_tax >= 0.04 AS INTEGER) + CAST(l_tax >= 0.06 AS INTEGER) END AS bin, label FROM lines WHERE label IN (0, 1)
          UNION ALL SELECT 'l_returnflag', CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END, label FROM lines WHERE label IN (0, 1)),
        lc AS (SELECT feature, bin, count(*) AS n, sum(label) AS b FROM lb GROUP BY 1, 2),
        ld AS (SELECT *, count(*) OVER p AS k, sum(n) OVER p AS tn, sum(b) OVER p AS tb, sum(n) OVER r AS cn, sum(b) OVER r AS cb FROM lc
          WINDOW p AS (PARTITION BY feature), r AS (PARTITION BY feature ORDER BY bin < 0, bin))""",
        """SELECT feature, bin, n AS sample_count, b AS bad_count, ln(((b+0.5e0)/(tb+0.5e0*k)) / ((n-b+0.5e0)/(tn-tb+0.5e0*k))) AS woe,
          ((b+0.5e0)/(tb+0.5e0*k) - (n-b+0.5e0)/(tn-tb+0.5e0*k)) * ln(((b+0.5e0)/(tb+0.5e0*k)) / ((n-b+0.5e0)/(tn-tb+0.5e0*k))) AS iv_bin,
          CASE WHEN bin >= 0 THEN abs(cb/tb - (cn-cb)/(tn-tb)) END AS ks FROM ld""",
        ["woe", "iv_bin", "ks"], ["bad_count"], ["bin"],
    ),
}
