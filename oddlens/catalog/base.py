"""Sample tables built from the test tables, in Spark and as SQL text.

``samples`` is one row per order: ID, observation date, label, eight features. The
label and all derived numbers use integer arithmetic, so two engines agree exactly.
``lines`` is one row per line item with natural duplicate IDs, missing and invalid
labels, missing cells and one empty column. ``scored`` adds a score with ties and a
time split to ``samples``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oddlens.functions.columns import is_bad
from oddlens.operators import split
from oddlens.operators.contract import RiskContract
from oddlens.sources.stages import stage

NUMERIC = ["o_totalprice", "c_acctbal", "c_nationkey", "line_cnt", "sum_qty", "avg_disc"]
CATEGORICAL = ["o_orderpriority", "c_mktsegment"]
FEATURES = [*NUMERIC[:3], *CATEGORICAL, *NUMERIC[3:]]
IDS = ["o_orderkey"]
CONTRACT = RiskContract(("o_orderkey",), "obs_date", "bad")
LINE_IDS = ["l_orderkey", "l_linenumber"]
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "empty_col"]
LINE_ORDER = ["ship_date", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount"]
LINE_CONTRACT = RiskContract(
    ("l_orderkey", "l_linenumber"), "ship_date", "label", exclude_cols=("l_partkey", "l_suppkey")
)


def bad() -> Column:
    return is_bad("bad")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def samples(spark: SparkSession, folder: str) -> DataFrame:
    per_order = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.count("*").alias("line_cnt"),
            F.sum("l_quantity").alias("sum_qty"),
            F.expr("cast((sum(cast(round(l_discount*100) as bigint))*100) div count(*) as double)/10000").alias("avg_disc"),
        )
    )
    customer = table(spark, folder, "customer").withColumnRenamed("c_custkey", "o_custkey")
    limit = (
        F.lit(60)
        + F.lit(180) * F.coalesce((F.col("c_acctbal") < 2000).cast("int"), F.lit(0))
        + F.lit(120) * (F.col("o_orderpriority") == "1-URGENT").cast("int")
    )
    return (
        table(spark, folder, "orders")
        .join(customer, "o_custkey", "left")
        .join(per_order, "o_orderkey", "left")
        .select(
            "o_orderkey",
            F.date_format("o_orderdate", "yyyyMMdd").alias("obs_date"),
            ((F.col("o_orderkey") * 7919) % 1000 < limit).cast("int").alias("bad"),
            *FEATURES,
        )
    )


def dated(spark: SparkSession, folder: str) -> DataFrame:
    """``samples`` with its month, written once for the passes that follow."""
    rows = samples(spark, folder)
    return stage(rows.withColumn("event_month", F.substring("obs_date", 1, 6)))


SCORE = "greatest(0, least(1000, cast(round((9999-c_acctbal)*100) as bigint) div 1100)) / 1000.0D"


def scored(spark: SparkSession, folder: str) -> DataFrame:
    rows = dated(spark, folder).withColumn("score", F.expr(SCORE))
    return stage(split.time_split(rows, oot_months=6, test_months=6), partition_by=["dataset"])


def split_samples(spark: SparkSession, folder: str) -> DataFrame:
    return scored(spark, folder).drop("score")


def lines(spark: SparkSession, folder: str) -> DataFrame:
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    label = (
        F.when(part % 89 == 0, F.lit(None).cast("int"))
        .when(part % 97 == 0, 9)
        .otherwise(((part * 7919 + supp) % 1000 < 150).cast("int"))
    )
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"),
        label.alias("label"),
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        "l_returnflag",
        "l_linestatus",
        F.lit(None).cast("double").alias("empty_col"),
    )


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles so that summation order cannot show."""
    doubles = {f.name: F.round(f.name, digits) for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.withColumns(doubles) if doubles else df


# ---------------------------------------------------------------- SQL side

_NUM_CELLS = " UNION ALL ".join(
    f"SELECT o_orderkey, event_month, bad, '{c}' AS feature, CAST({c} AS DOUBLE) AS num, CAST(NULL AS VARCHAR) AS txt FROM samples"
    for c in NUMERIC
)
_TXT_CELLS = " UNION ALL ".join(
    f"SELECT o_orderkey, event_month, bad, '{c}' AS feature, CAST(NULL AS DOUBLE) AS num, {c} AS txt FROM samples"
    for c in CATEGORICAL
)

SAMPLES_SQL = """
li AS (
  SELECT l_orderkey, count(*) AS line_cnt, sum(l_quantity) AS sum_qty,
    CAST((sum(CAST(round(l_discount*100) AS BIGINT))*100) // count(*) AS DOUBLE)/10000 AS avg_disc
  FROM lineitem GROUP BY l_orderkey),
samples AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS obs_date,
    CAST((o_orderkey*7919) % 1000 < 60 + 180*CAST(coalesce(c_acctbal < 2000, false) AS INTEGER)
      + 120*CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS INTEGER) AS bad,
    o_totalprice, c_acctbal, c_nationkey, o_orderpriority, c_mktsegment, line_cnt, sum_qty, avg_disc,
    strftime(o_orderdate, '%Y%m') AS event_month
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN li ON o_orderkey = l_orderkey),
lines AS (
  SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS ship_date,
    CASE WHEN l_partkey % 89 = 0 THEN NULL WHEN l_partkey % 97 = 0 THEN 9
      ELSE CAST((l_partkey*7919 + l_suppkey) % 1000 < 150 AS INTEGER) END AS label,
    l_partkey, l_suppkey, l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount,
    nullif(l_tax, 0) AS l_tax, l_returnflag, l_linestatus, CAST(NULL AS DOUBLE) AS empty_col,
    strftime(l_shipdate, '%Y%m') AS event_month
  FROM lineitem),
months AS (
  SELECT event_month, count(*) AS sample_count, sum(bad) AS bad_count FROM samples GROUP BY 1),
time_manifest AS (
  SELECT event_month, CASE WHEN p <= 6 THEN 'oot' WHEN p <= 12 THEN 'test' ELSE 'train' END AS dataset
  FROM (SELECT event_month, row_number() OVER (ORDER BY event_month DESC) AS p FROM months)),
scored AS (
  SELECT s.*, CAST(greatest(0, least(1000, CAST(round((9999-c_acctbal)*100) AS BIGINT) // 1100)) AS DOUBLE)/1000 AS score,
    t.dataset
  FROM samples s JOIN time_manifest t USING (event_month))
"""

CELLS_SQL = SAMPLES_SQL + f""",
cells AS ({_NUM_CELLS} UNION ALL {_TXT_CELLS}),
vc AS (SELECT feature, num, txt, count(*) AS n, sum(bad) AS bad FROM cells GROUP BY 1, 2, 3),
ranked AS (
  SELECT feature, num, n, bad,
    sum(n) OVER w AS cum_n, sum(bad) OVER w AS cum_bad, row_number() OVER w AS d,
    sum(n) OVER (PARTITION BY feature) AS tot_n, sum(bad) OVER (PARTITION BY feature) AS tot_bad,
    count(*) OVER (PARTITION BY feature) AS tot_d
  FROM vc WHERE num IS NOT NULL WINDOW w AS (PARTITION BY feature ORDER BY num)),
edges AS (
  SELECT feature, list(DISTINCT num ORDER BY num) AS es
  FROM ranked, generate_series(1, 9) AS g(i)
  WHERE round_even(CAST(i*(tot_n-1) AS DOUBLE)/10, 0) >= cum_n - n AND round_even(CAST(i*(tot_n-1) AS DOUBLE)/10, 0) < cum_n
  GROUP BY feature),
cats AS (
  SELECT feature, txt, row_number() OVER (PARTITION BY feature ORDER BY sum(n) DESC, txt) AS p
  FROM vc WHERE txt IS NOT NULL GROUP BY feature, txt),
value_bin AS (
  SELECT v.feature, v.num, v.txt, v.n, v.bad,
    CAST(CASE WHEN v.num IS NOT NULL THEN len(list_filter(e.es, lambda x: x <= v.num))
      WHEN v.txt IS NOT NULL THEN least(c.p - 1, 19) ELSE -1 END AS INTEGER) AS bin
  FROM vc v LEFT JOIN edges e ON v.feature = e.feature LEFT JOIN cats c ON v.feature = c.feature AND v.txt = c.txt),
bc AS (SELECT feature, bin, sum(n) AS n, sum(bad) AS bad FROM value_bin GROUP BY 1, 2),
detail0 AS (
  SELECT *, n - bad AS good, row_number() OVER (PARTITION BY feature ORDER BY bin < 0, bin) AS bin_order,
    count(*) OVER f AS k, sum(n) OVER f AS tn, sum(bad) OVER f AS tb, sum(n - bad) OVER f AS tg,
    sum(bad) OVER r AS cb, sum(n - bad) OVER r AS cg
  FROM bc WINDOW f AS (PARTITION BY feature),
    r AS (PARTITION BY feature ORDER BY bin < 0, bin ROWS UNBOUNDED PRECEDING)),
detail AS (
  SELECT feature, bin_order, bin, n AS sample_count, n/tn AS sample_rate, bad AS bad_count, good AS good_count,
    bad/n AS bad_rate, bad/tb AS bad_distribution, good/tg AS good_distribution,
    ln(((bad+0.5e0)/(tb+0.5e0*k)) / ((good+0.5e0)/(tg+0.5e0*k))) AS woe,
    ((bad+0.5e0)/(tb+0.5e0*k) - (good+0.5e0)/(tg+0.5e0*k)) * ln(((bad+0.5e0)/(tb+0.5e0*k)) / ((good+0.5e0)/(tg+0.5e0*k))) AS iv_bin,
    CASE WHEN bin >= 0 THEN abs(cb/tb - cg/tg) END AS ks
  FROM detail0),
bin_sum AS (
  SELECT feature, sum(iv_bin) AS iv, max(coalesce(ks, 0)) AS ks, count(*) AS bin_count,
    coalesce(sum(sample_rate) FILTER (bin < 0), 0) AS missing_rate, -sum(sample_rate*log2(sample_rate)) AS entropy
  FROM detail GROUP BY 1),
raw_metrics AS (
  SELECT feature, max(tot_n) AS sample_count, max(tot_bad) AS bad_count,
    max(abs(cum_bad/tot_bad - (cum_n-cum_bad)/(tot_n-tot_bad))) AS ks,
    (sum(bad*(cum_n - n + (n+1)/2e0)) - max(tot_bad)*(max(tot_bad)+1)/2e0) / (max(tot_bad)*CAST(max(tot_n)-max(tot_bad) AS DOUBLE)) AS auc_raw
  FROM ranked GROUP BY 1),
overview AS (
  SELECT b.feature, b.iv, b.ks, r.ks AS ks_raw, greatest(r.auc_raw, 1-r.auc_raw) AS auc, b.bin_count, b.missing_rate
  FROM bin_sum b LEFT JOIN raw_metrics r USING (feature)),
mbin AS (
  SELECT c.event_month, c.feature, v.bin, count(*) AS n, sum(c.bad) AS bad
  FROM cells c JOIN value_bin v ON c.feature = v.feature AND c.num IS NOT DISTINCT FROM v.num AND c.txt IS NOT DISTINCT FROM v.txt
  GROUP BY 1, 2, 3),
mtot AS (SELECT feature, event_month, sum(n) AS total FROM mbin GROUP BY 1, 2),
mgrid AS (
  SELECT t.feature, t.event_month, b.bin, coalesce(m.n, 0) AS n, t.total, count(*) OVER (PARTITION BY t.feature, t.event_month) AS k
  FROM mtot t JOIN (SELECT DISTINCT feature, bin FROM mbin) b ON t.feature = b.feature
  LEFT JOIN mbin m ON m.feature = t.feature AND m.event_month = t.event_month AND m.bin = b.bin),
mpsi AS (
  SELECT g.feature, g.event_month, h.event_month AS baseline_month,
    sum(((g.n+0.5e0)/(g.total+0.5e0*g.k) - (h.n+0.5e0)/(h.total+0.5e0*h.k)) * ln(((g.n+0.5e0)/(g.total+0.5e0*g.k)) / ((h.n+0.5e0)/(h.total+0.5e0*h.k)))) AS psi,
    sum(((g.n+1e0)/(g.total+1e0*g.k) - (h.n+1e0)/(h.total+1e0*h.k)) * ln(((g.n+1e0)/(g.total+1e0*g.k)) / ((h.n+1e0)/(h.total+1e0*h.k)))) AS psi_one
  FROM mgrid g JOIN mgrid h ON g.feature = h.feature AND g.bin = h.bin AND h.event_month = (SELECT min(event_month) FROM months)
  GROUP BY 1, 2, 3),
psi_sum AS (SELECT feature, avg(psi) AS average_psi, max(psi) AS max_psi FROM mpsi GROUP BY 1)
"""

_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y FROM samples"
    for i, a in enumerate(NUMERIC)
    for b in NUMERIC[i + 1 :]
)
PAIRS_SQL = CELLS_SQL + f""",
xy AS (SELECT * FROM ({_PAIRS}) WHERE x IS NOT NULL AND y IS NOT NULL),
pearson AS (
  SELECT feature_1, feature_2, coalesce(corr(x, y), 0) AS correlation, abs(coalesce(corr(x, y), 0)) AS abs_correlation, count(*) AS pair_count
  FROM xy GROUP BY 1, 2)
"""

# Score metrics per data set, ordered by (score desc, ID asc).
METRICS_SQL = SAMPLES_SQL + """,
ordered AS (
  SELECT dataset, event_month, o_orderkey, score, bad, row_number() OVER w AS rn, sum(bad) OVER w AS cb,
    count(*) OVER (PARTITION BY dataset) AS tn, sum(bad) OVER (PARTITION BY dataset) AS tb
  FROM scored WINDOW w AS (PARTITION BY dataset ORDER BY score DESC, o_orderkey ROWS UNBOUNDED PRECEDING)),
ties AS (
  SELECT dataset, score, count(*) AS n, sum(bad) AS b, max(rn) AS rn, max(cb) AS cb, max(tn) AS tn, max(tb) AS tb
  FROM ordered GROUP BY 1, 2),
tie_metrics AS (
  SELECT dataset, max(abs(cb/tb - (rn-cb)/(tn-tb))) AS ks,
    (sum(b*(tn - rn + (n+1)/2e0)) - max(tb)*(max(tb)+1)/2e0) / (max(tb)*CAST(max(tn)-max(tb) AS DOUBLE)) AS auc
  FROM ties GROUP BY 1),
row_metrics AS (
  SELECT dataset, count(*) AS sample_count, sum(bad) AS bad_count, sum(bad*(cb/rn))/sum(bad) AS pr_auc,
    avg((score-bad)*(score-bad)) AS brier_score
  FROM ordered GROUP BY 1),
split_metrics AS (
  SELECT r.dataset, sample_count, bad_count, bad_count/sample_count AS bad_rate, auc, greatest(auc, 1-auc) AS auc_adjusted,
    2*auc-1 AS gini, ks, pr_auc, brier_score
  FROM row_metrics r JOIN tie_metrics USING (dataset))
"""


def check(prefix: str, body: str, doubles: Iterable[str] = (), longs: Iterable[str] = (), ints: Iterable[str] = (), digits: int = 6) -> str:
    """SQL text with the CTEs it needs, rounded doubles and plain integer types."""
    swaps = [f"round(CAST({c} AS DOUBLE), {digits}) AS {c}" for c in doubles]
    swaps += [f"CAST({c} AS BIGINT) AS {c}" for c in longs]
    swaps += [f"CAST({c} AS INTEGER) AS {c}" for c in ints]
    columns = f"* REPLACE ({', '.join(swaps)})" if swaps else "*"
    head = f"WITH {prefix.strip()}\n" if prefix else ""
    return f"{head}SELECT {columns} FROM ({body.strip()}) AS result"
