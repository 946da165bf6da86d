"""One modelling run: split by time, fit on train, score and evaluate every split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from oddlens.functions.columns import is_bad
from oddlens.operators import boost, evaluate, prepare, review, select, split
from oddlens.operators.contract import RiskContract
from oddlens.sources.stages import stage


@dataclass(frozen=True)
class ModelRun:
    model: boost.BoostedModel
    scored: DataFrame
    split_summary: DataFrame
    preparation: DataFrame
    selection: DataFrame
    importance: DataFrame
    metrics: DataFrame
    lift: DataFrame
    calibration: DataFrame
    monthly: DataFrame
    groups: DataFrame
    findings: DataFrame


def run_model(
    df: DataFrame,
    contract: RiskContract,
    order_by: Sequence[str],
    params: boost.BoosterParams | None = None,
    rules: select.SelectionRules | None = None,
    preparation: prepare.PreparationRules | None = None,
    oot_months: int = 2,
    test_months: int = 2,
    seed: int = 42,
    balance: bool = False,
) -> ModelRun:
    """Everything learned comes from train; test picks the iteration; OOT only scores.

    The cleaned, split table is written once before the passes that reuse it.
    """
    bad = is_bad(contract.target_col, contract.bad_label)
    clean, _ = prepare.clean_samples(df, contract, order_by, filter_features=False)
    rows = stage(split.time_split(clean, oot_months, test_months), partition_by=["dataset"])
    features = [c for c in contract.feature_cols(df) if c in rows.columns]
    train = rows.where("dataset = 'train'")
    plan = prepare.fit_preparation(train, features, preparation)
    # Selection sees raw train columns, so the IV of a category uses its own values.
    selection = stage(select.select_features(train, list(plan.retained), bad, rules))
    kept = select.retained_features(selection)
    matrix = stage(prepare.transform_features(rows, plan), partition_by=["dataset"])
    model = boost.fit_booster(matrix, kept, bad, params, seed, balance)
    ids = list(contract.id_cols)
    scored = stage(boost.score_rows(matrix, model), partition_by=["dataset"])
    ranked = stage(evaluate.rank_scores(scored, "bad_probability", bad, ids, ["dataset"]))
    importance = stage(review.gain_shares(boost.feature_importance(model, matrix)))
    metrics = stage(evaluate.metrics_by_split(scored, "bad_probability", bad, ids, ranked=ranked))
    lift = stage(evaluate.lift_table(ranked, ["dataset"]))
    monthly = stage(evaluate.monthly_performance(scored, "bad_probability", bad, ids))
    dimensions = ["event_month", *evaluate.detect_group_columns(scored.where("dataset = 'train'"), contract, kept)]
    return ModelRun(
        model=model,
        scored=scored,
        split_summary=split.split_summary(rows, bad),
        preparation=plan.decisions,
        selection=selection,
        importance=importance,
        metrics=metrics,
        lift=lift,
        calibration=evaluate.calibration_table(ranked, ["dataset"]),
        monthly=monthly,
        groups=evaluate.group_performance(scored, "bad_probability", bad, ids, dimensions),
        findings=review.model_review(metrics, model.best_iteration, importance, model.history, lift, monthly),
    )
