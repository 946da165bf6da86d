import pytest
from pyspark.sql import functions as F

from oddlens import ContractError, RiskContract
from oddlens.operators import prepare

FEATURES = ["amount", "channel", "near_id", "notes"]
SCHEMA = "id long, date int, target int, amount double, channel string, near_id string, notes string, event_month string"


def _row(i, amount, channel):
    return (i, 20250101, i % 2, amount, channel, f"code-{i}", "long text " * 10 + str(i), "202501")


def _train(spark):
    rows = [_row(i, float(i) if i < 59 else float("inf"), "app" if i < 30 else "branch") for i in range(60)]
    return spark.createDataFrame(rows, SCHEMA)


def test_types_codes_and_unseen_values(spark):
    train = _train(spark)
    test = spark.createDataFrame([_row(100, 1.0, "app"), _row(101, 2.0, "new-channel")], SCHEMA)
    plan = prepare.fit_preparation(train, FEATURES)
    assert plan.categorical == ("channel",) and set(plan.dropped) == {"near_id", "notes"}
    ready = prepare.transform_features(train, plan)
    assert ready.where("amount is null").count() == 1
    assert prepare.transform_features(test, plan).where("channel is null").count() == 1
    other = prepare.fit_preparation(train, FEATURES, prepare.PreparationRules(unknown="other"))
    assert prepare.transform_features(test, other).where(F.col("channel") == other.other_codes["channel"]).count() == 1


def test_categories_can_be_dropped(spark):
    plan = prepare.fit_preparation(_train(spark).limit(40), FEATURES, prepare.PreparationRules(categorical="drop"))
    actions = {r.feature: r.action for r in plan.decisions.collect()}
    assert actions["channel"] == "drop_categorical" and plan.retained == ("amount",)


def test_long_texts_are_counted_by_digest(spark):
    df = spark.createDataFrame([("x" * 40,), ("x" * 40,), ("x" * 39 + "y",), ("short",), ("",), (None,)], "t string")
    stats = prepare._value_stats(df, ["t"])
    row = stats.first()
    assert (row.row_count, row.value_count, row.unique_count, row.average_length) == (6, 5, 4, 25.0)
    assert "sha2(" in stats._jdf.queryExecution().optimizedPlan().toString()


def test_rare_categories_share_a_code(spark):
    rows = [(v,) for v, n in (("a", 30), ("b", 25), ("c", 3), ("d", 2)) for _ in range(n)]
    df = spark.createDataFrame(rows, "x string")
    codes = {r.value: (r.code, r.is_other) for r in prepare.category_codes(df, ["x"]).collect()}
    assert codes == {"a": (0, False), "b": (1, False), "c": (2, True), "d": (2, True)}
    few = {r.value: r.code for r in prepare.category_codes(df.where("x in ('c', 'd')"), ["x"]).collect()}
    assert few == {"c": 0, "d": 1}
    assert prepare.rare_floor(60) == 20 and prepare.rare_floor(100_000) == 100


def test_dates_and_duplicates(spark):
    contract = RiskContract(("id",), "date", "target")
    df = spark.createDataFrame([(1, "2025/01/03", 0, 1.0), (1, "202502", 0, 2.0), (2, None, 1, 3.0)], "id long, date string, target int, v double")
    dated = prepare.add_event_dates(df, contract)
    assert [r.event_month for r in dated.orderBy("v").collect()] == ["202501", "202502", None]
    assert [r.v for r in prepare.deduplicate(dated, ["id"], ["v"], "keep_last").orderBy("id").collect()] == [2.0, 3.0]
    with pytest.raises(ContractError):
        prepare.deduplicate(dated, ["id"], ["v"], "error")
    with pytest.raises(ContractError):
        prepare.add_event_dates(spark.createDataFrame([(1, "03.01.2025", 0, 1.0)], df.schema), contract)
    with pytest.raises(ContractError):
        prepare.add_event_dates(dated, contract)


def test_quality_filter(spark):
    contract = RiskContract(("id",), "date", "target", exclude_cols=("junk",))
    rows = [(i, "202501", i % 2, None if i < 9 else 1.0, 5.0 if i < 9 else 1.0, float(i), "x") for i in range(10)]
    df = spark.createDataFrame(rows, "id long, date string, target int, sparse double, flat double, good double, junk string")
    decisions = {r.column_name: r.decision for r in prepare.quality_decisions(df, contract).collect()}
    assert decisions == {"junk": "excluded_manual", "sparse": "excluded_missing", "flat": "excluded_constant", "good": "retained"}
    clean, _ = prepare.clean_samples(df, contract, ["good"])
    assert set(clean.columns) == {"id", "date", "target", "good", "event_date", "event_month"}
