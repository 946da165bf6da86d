import pytest

from oddlens import ContractError, RiskContract, validate_contract
from oddlens.operators.contract import contract_summary, fill_roles_from_profile, infer_roles, override_roles
from oddlens.operators.profile import profile_columns


@pytest.fixture()
def table(spark):
    rows = [(i, f"2025{1 + i % 10:02d}", i % 2, float(i)) for i in range(1, 41)]
    return spark.createDataFrame(rows, "map_key long, clean_date string, y_flag int, flag_1 double")


CONTRACT = RiskContract(("map_key",), "clean_date", "y_flag")


def test_valid_contract(table):
    valid = validate_contract(table, CONTRACT)
    assert valid.feature_cols == ("flag_1",)
    assert valid.id_unique_rate == 1.0 and valid.date_parse_rate == 1.0


@pytest.mark.parametrize(
    "contract",
    [
        RiskContract(("nope",), "clean_date", "y_flag"),
        RiskContract(("map_key",), "map_key", "y_flag"),
        RiskContract(("map_key",), "clean_date", "y_flag", exclude_cols=("y_flag",)),
        RiskContract(("map_key",), "clean_date", "y_flag", exclude_cols=("flag_1",)),
        RiskContract(("map_key",), "clean_date", "y_flag", bad_label=7),
        RiskContract(("map_key",), "flag_1", "y_flag"),
    ],
)
def test_broken_contracts(table, contract):
    with pytest.raises(ContractError):
        validate_contract(table, contract)


def test_duplicates_and_label_issues_can_be_allowed(table, spark):
    doubled = table.unionByName(table)
    with pytest.raises(ContractError):
        validate_contract(doubled, CONTRACT)
    assert validate_contract(doubled, CONTRACT, allow_id_duplicates=True).id_unique_rate == 0.5
    odd = table.unionByName(spark.createDataFrame([(99, "202501", None, 1.0)], table.schema))
    with pytest.raises(ContractError):
        validate_contract(odd, CONTRACT)
    validate_contract(odd, CONTRACT, allow_target_issues=True)


def test_summary_of_empty_table(table):
    row = contract_summary(table.limit(0), CONTRACT).first()
    assert row.row_count == 0 and row.id_unique_rate == 0.0 and row.date_parse_rate is None


def test_role_overrides_and_inference(table):
    changed = override_roles(CONTRACT, id_cols=[" a ", "b"], date_col="d")
    assert changed.id_cols == ("a", "b") and changed.date_col == "d" and changed.target_col == "y_flag"
    with pytest.raises(ContractError):
        override_roles(CONTRACT, id_cols="  ")
    found = infer_roles(table.withColumnRenamed("map_key", "MAP_KEY"))
    assert (found.id_cols, found.date_col, found.target_col) == (("MAP_KEY",), "clean_date", "y_flag")
    assert infer_roles(table, parameters={"target": "flag_1"}).target_col == "flag_1"


def test_roles_filled_from_profile(table):
    found = fill_roles_from_profile(profile_columns(table), RiskContract((), None, None), table.columns)
    assert (found.id_cols, found.date_col, found.target_col) == (("map_key",), "clean_date", "y_flag")


def test_profile_of_empty_and_null_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, float("nan"))], "a string, b double")
    rows = {r.column_name: r for r in profile_columns(df).collect()}
    assert rows["a"].missing_rate == 1.0 and rows["a"].unique_count == 0 and rows["a"].top_value is None
    assert rows["b"].non_null_count == 1
