from oddlens.operators import diagnose
from oddlens.operators.contract import RiskContract
from oddlens.operators.diagnose import Treatment

CONTRACT = RiskContract(("id",), "date", "target")


def _table(spark):
    rows = [
        (1, "202501", 0, None, 1.0),
        (1, "202501", 0, None, 2.0),
        (2, "202503", 1, None, None),
        (3, "202503", None, None, None),
        (4, "202504", 0, None, 5.0),
        (5, "202504", 0, None, 6.0),
    ]
    return spark.createDataFrame(rows, "id long, date string, target int, all_null string, feature double")


def test_findings(spark):
    rows = {r.code: r for r in diagnose.sample_findings(_table(spark), CONTRACT).collect()}
    assert {"MISSING_TARGET", "DUPLICATE_ID", "ALL_NULL_FEATURES", "MISSING_MONTHS"} <= set(rows)
    assert rows["DUPLICATE_ID"].value == 1 and rows["MISSING_TARGET"].value == 1
    assert rows["MISSING_MONTHS"].subject == "202502" and rows["ALL_NULL_FEATURES"].subject == "all_null"


def test_treatment_order_and_counts(spark):
    done = diagnose.apply_treatment(_table(spark), CONTRACT, ["feature"])
    assert done.removed_missing_target == 1 and done.removed_duplicates == 1
    assert done.removed_features == ("all_null",)
    assert done.data.count() == 4 and "all_null" not in done.data.columns
    last = diagnose.apply_treatment(_table(spark), CONTRACT, ["feature"], Treatment(keep="last"))
    assert [r.feature for r in last.data.where("id = 1").collect()] == [2.0]


def test_clean_table_has_no_findings(spark):
    rows = [(i, f"2025{1 + i % 3:02d}", i % 2, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, date string, target int, feature double")
    assert diagnose.sample_findings(df, CONTRACT).count() == 0


def test_incomplete_latest_month_is_cut(spark):
    rows = [(i, f"2025{1 + i // 30:02d}", i % 2, float(i)) for i in range(95)]
    df = spark.createDataFrame(rows, "id long, date string, target int, feature double")
    done = diagnose.apply_treatment(df, CONTRACT, ["feature"])
    assert done.excluded_month == "202504" and done.removed_incomplete_month == 5 and done.data.count() == 90
    kept = diagnose.apply_treatment(df, CONTRACT, ["feature"], Treatment(incomplete_latest_month="keep"))
    assert kept.data.count() == 95


def test_evidence_status(spark):
    overview = spark.createDataFrame([("a", 0.01, 0.9), ("b", 0.6, 0.1)], "feature string, iv double, missing_rate double")
    monthly = spark.createDataFrame([("202501", 100, 5), ("202502", 10, 0)], "event_month string, sample_count long, bad_count long")
    psi = spark.createDataFrame([("a", 0.3)], "feature string, max_psi double")
    pairs = spark.createDataFrame([("a", "b", 0.9)], "feature_1 string, feature_2 string, abs_correlation double")
    ks = spark.createDataFrame([("a", 0.1), ("a", 0.5)], "feature string, ks double")
    rows = diagnose.evidence_findings(overview, monthly, psi, pairs, ks, duplicate_keys=2, missing_labels=1).collect()
    assert {r.status for r in rows} == {"blocker"}
    assert {r.code for r in rows} == {
        "MISSING_LABELS", "DUPLICATE_KEYS", "WEAK_FEATURES", "SUSPECTED_LEAKAGE", "HIGH_MISSING_FEATURES", "HIGH_PSI_FEATURES",
        "CORRELATED_PAIRS", "SMALL_MONTHS", "MONTHS_WITHOUT_BAD", "VOLATILE_MONTHLY_KS",
    }
