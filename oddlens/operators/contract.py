"""Field roles: declare, override, infer and validate them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddlens.functions.columns import parse_date, ratio

# Limits and role names recognised by convention.
MIN_ID_UNIQUE_RATE = 0.95
MIN_DATE_PARSE_RATE = 0.80
ID_NAMES = ("id", "map_key", "user_id", "customer_id", "uid")
DATE_NAMES = ("date", "clean_date", "dt", "event_date", "apply_date")
TARGET_NAMES = ("y", "label", "target", "y_flag", "bad_flag")


class ContractError(ValueError):
    """The declared roles and the table do not fit together."""


@dataclass(frozen=True)
class RiskContract:
    id_cols: tuple[str, ...]
    date_col: str | None
    target_col: str | None
    good_label: object = 0
    bad_label: object = 1
    exclude_cols: tuple[str, ...] = ()

    @property
    def role_cols(self) -> list[str]:
        return [*self.id_cols, *[c for c in (self.date_col, self.target_col) if c]]

    def feature_cols(self, df: DataFrame) -> list[str]:
        taken = {*self.role_cols, *self.exclude_cols}
        return [c for c in df.columns if c not in taken]


@dataclass(frozen=True)
class ValidatedContract:
    contract: RiskContract
    feature_cols: tuple[str, ...]
    id_unique_rate: float
    date_parse_rate: float


def override_roles(
    contract: RiskContract,
    id_cols: str | list[str] | tuple[str, ...] | None = None,
    date_col: str | None = None,
    target_col: str | None = None,
) -> RiskContract:
    """Replace roles that are given; ``None`` keeps the declared one."""
    changes: dict[str, object] = {}
    if id_cols is not None:
        names = (id_cols,) if isinstance(id_cols, str) else tuple(id_cols)
        if not names or not all(isinstance(n, str) and n.strip() for n in names):
            raise ContractError("id_cols must be a non-empty name or a list of such names")
        changes["id_cols"] = tuple(n.strip() for n in names)
    for role, name in (("date_col", date_col), ("target_col", target_col)):
        if name is None:
            continue
        if not isinstance(name, str) or not name.strip():
            raise ContractError(f"{role} must be a non-empty name")
        changes[role] = name.strip()
    return replace(contract, **changes)


def infer_roles(
    df: DataFrame,
    contract: RiskContract | None = None,
    parameters: Mapping[str, str] | None = None,
) -> RiskContract:
    """Fill roles from parameters, then the contract, then well-known names.

    Parameters naming an absent column are ignored. Names match in any case.
    """
    base = contract or RiskContract((), None, None)
    asked = parameters or {}
    actual = {c.lower(): c for c in df.columns}

    def pick(key: str, declared: str | None, known: tuple[str, ...]) -> str | None:
        if asked.get(key) in df.columns:
            return asked[key]
        if declared:
            return declared if declared in df.columns else None
        return next((actual[n] for n in known if n in actual), None)

    if len(base.id_cols) > 1 and asked.get("id") not in df.columns:
        ids = tuple(c for c in base.id_cols if c in df.columns)
    else:
        one = pick("id", base.id_cols[0] if base.id_cols else None, ID_NAMES)
        ids = (one,) if one else ()
    return replace(
        base,
        id_cols=ids,
        date_col=pick("date", base.date_col, DATE_NAMES),
        target_col=pick("target", base.target_col, TARGET_NAMES),
        exclude_cols=tuple(c for c in base.exclude_cols if c in df.columns),
    )


def roles_frame(df: DataFrame, contract: RiskContract) -> DataFrame:
    """One row per role column, for review next to the profile."""
    roles = [("id", c) for c in contract.id_cols]
    roles += [("date", contract.date_col), ("target", contract.target_col)]
    cells = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(c).alias("column_name")) for r, c in roles if c])
    return df.limit(1).select(F.inline(cells))


def fill_roles_from_profile(profile: DataFrame, contract: RiskContract, columns: list[str]) -> RiskContract:
    """Fill roles whose columns are absent with the first profile candidate.

    ``profile`` has one row per column, so reading its candidates is small.
    """
    position = {c: i for i, c in enumerate(columns)}
    found: dict[str, str] = {}
    rows = profile.where("candidate_role <> 'candidate_feature'").select("column_name", "candidate_role")
    for row in sorted(rows.collect(), key=lambda r: position[r.column_name]):
        found.setdefault(row.candidate_role, row.column_name)
    ids = contract.id_cols
    if not ids or not set(ids) <= set(columns):
        ids = (found["candidate_id"],) if "candidate_id" in found else ()
    date = contract.date_col if contract.date_col in columns else found.get("candidate_date")
    target = contract.target_col if contract.target_col in columns else found.get("candidate_target")
    return replace(contract, id_cols=ids, date_col=date, target_col=target)


def contract_summary(df: DataFrame, contract: RiskContract) -> DataFrame:
    """One row of the facts that validation needs.

    Each column is null where its role is missing. The distinct count of the ID
    tuple is computed from per-ID groups, in the same pass as the other counts.
    """
    target, date = contract.target_col, contract.date_col
    parsed = parse_date(date, df.schema[date].dataType)
    label = F.col(target)
    known = label.isin(contract.good_label, contract.bad_label)
    per_id = df.groupBy(*contract.id_cols).agg(
        F.count("*").alias("rows"),
        F.count(date).alias("dated"),
        F.count(parsed).alias("parsed"),
        F.count_if(label.isNull()).alias("label_null"),
        F.count_if(label.isNotNull() & ~known).alias("label_invalid"),
        F.count_if(label == F.lit(contract.good_label)).alias("good"),
        F.count_if(label == F.lit(contract.bad_label)).alias("bad"),
    )
    total = {c: F.coalesce(F.sum(c), F.lit(0)) for c in ("rows", "dated", "parsed", "label_null", "label_invalid", "good", "bad")}
    return per_id.agg(
        total["rows"].alias("row_count"),
        F.count("*").alias("id_count"),
        total["dated"].alias("date_count"),
        total["parsed"].alias("date_parsed_count"),
        total["label_null"].alias("missing_target_count"),
        total["label_invalid"].alias("invalid_target_count"),
        total["good"].alias("good_count"),
        total["bad"].alias("bad_count"),
    ).withColumns(
        {
            "id_unique_rate": F.coalesce(ratio(F.col("id_count"), F.col("row_count")), F.lit(0.0)),
            "date_parse_rate": ratio(F.col("date_parsed_count"), F.col("date_count")),
        }
    )


def validate_contract(
    df: DataFrame,
    contract: RiskContract,
    allow_id_duplicates: bool = False,
    allow_target_issues: bool = False,
) -> ValidatedContract:
    """Check roles against the table and derive the features in column order."""
    roles = contract.role_cols
    absent = sorted({*roles, *contract.exclude_cols} - set(df.columns))
    if absent:
        raise ContractError(f"columns are absent from the table: {absent}")
    if len(set(roles)) != len(contract.id_cols) + 2:
        raise ContractError("id, date and target columns must be given and must not overlap")
    if set(contract.exclude_cols) & set(roles):
        raise ContractError("exclude_cols must not hold id, date or target columns")

    facts = contract_summary(df, contract).first()
    if facts.id_unique_rate < MIN_ID_UNIQUE_RATE and not allow_id_duplicates:
        raise ContractError(f"id unique rate {facts.id_unique_rate:.2%} is below {MIN_ID_UNIQUE_RATE:.0%}")
    if not facts.date_count:
        raise ContractError(f"date column '{contract.date_col}' has no values")
    if facts.date_parse_rate < MIN_DATE_PARSE_RATE:
        raise ContractError(f"date parse rate {facts.date_parse_rate:.2%} is below {MIN_DATE_PARSE_RATE:.0%}")
    if not allow_target_issues:
        if facts.invalid_target_count or not facts.good_count or not facts.bad_count:
            raise ContractError(
                f"target '{contract.target_col}' must hold exactly the labels "
                f"{contract.good_label!r} and {contract.bad_label!r}"
            )
        if facts.missing_target_count:
            raise ContractError(f"target '{contract.target_col}' has null labels")
    features = contract.feature_cols(df)
    if not features:
        raise ContractError("no feature column is left")
    return ValidatedContract(contract, tuple(features), facts.id_unique_rate, facts.date_parse_rate)
