import pytest

from oddlens.operators import review


def _metrics(spark, auc, ks, psi=(0.0, 0.3, 0.12)):
    rows = [(d, n, b, a, k, p) for d, n, b, a, k, p in zip(("train", "test", "oot"), (1000, 300, 300), (100, 30, 30), auc, ks, psi)]
    return spark.createDataFrame(rows, "dataset string, sample_count long, bad_count long, auc double, ks double, score_psi_vs_train double")


def test_findings_of_an_overfit_model(spark):
    history = spark.createDataFrame([(0.65, 0.64), (0.90, 0.70)], "train_auc double, test_auc double")
    lift = spark.createDataFrame(
        [("test", i + 1, r, x) for i, (r, x) in enumerate(zip((0.30, 0.20, 0.25, 0.10, 0.15), (1.5, 1.0, 1.2, 0.5, 0.4)))],
        "dataset string, bucket int, bad_rate double, lift double",
    )
    monthly = spark.createDataFrame(
        [("oot", 50, 10, a, k, b) for a, k, b in ((0.80, 0.50, 0.10), (0.60, 0.20, 0.20), (0.75, 0.45, 0.12))],
        "dataset string, sample_count long, bad_count long, auc double, ks double, bad_rate double",
    )
    gains = spark.createDataFrame([("a", 80.0), ("b", 20.0)], "feature string, gain_importance double")
    found = review.model_review(_metrics(spark, (0.90, 0.70, 0.58), (0.70, 0.50, 0.35)), 8, gains, history, lift, monthly)
    rows = found.collect()
    assert {
        "TRAIN_TEST_AUC_GAP_CRITICAL", "TRAIN_TEST_KS_GAP_CRITICAL", "OOT_AUC_DROP", "TEST_SCORE_PSI_HIGH", "LIFT_ORDERING_WEAK",
        "MONTHLY_PERFORMANCE_UNSTABLE", "FEATURE_IMPORTANCE_CONCENTRATED", "TRAINING_GAP_WIDENS", "EARLY_STOP_TOO_EARLY",
    } <= {r.code for r in rows}
    assert {r.status for r in rows} == {"blocked"}
    advice = {r.category: r.source_codes for r in review.recommendations(found).collect()}
    assert "TRAIN_TEST_AUC_GAP_CRITICAL" in advice["overfit"] and "drift" in advice


def test_underfit(spark):
    found = review.model_review(_metrics(spark, (0.54, 0.53, 0.52), (0.08, 0.07, 0.06), (0.0, 0.0, 0.0)), 50)
    assert [r.code for r in found.collect()] == ["MODEL_UNDERFIT_CRITICAL"]


def test_small_oot_is_unsupported(spark):
    metrics = _metrics(spark, (0.8, 0.79, 0.78), (0.5, 0.49, 0.48), (0.0, 0.0, 0.0)).replace({30: 5}, subset=["bad_count"])
    assert {r.code for r in review.model_review(metrics, 50).collect()} == {"OOT_EVALUATION_UNSUPPORTED"}


def test_bounds(spark):
    rows = [("wide", "num_leaves", 100.0), ("deep", "max_depth", 3.0), ("deep", "num_leaves", 16.0), ("fine", "max_depth", 5.0), ("fine", "num_leaves", 31.0), ("half", "max_depth", 4.5), ("odd", "colour", 1.0)]
    got = {r.proposal: (r.accepted, r.reasons) for r in review.bounds_check(spark.createDataFrame(rows, "proposal string, name string, value double")).collect()}
    assert got["wide"] == (False, "num_leaves:out_of_bounds") and got["deep"] == (False, "num_leaves:above_depth")
    assert got["fine"][0] and got["half"][1] == "max_depth:not_integer" and got["odd"][1] == "colour:unknown"


def _candidates(spark):
    rows = [("baseline", 0.60, 0.40, 0.38, 0.80, 0.75, 0.74, 50), ("closer", 0.47, 0.398, 0.38, 0.78, 0.75, 0.74, 50), ("worse", 0.70, 0.45, 0.20, 0.85, 0.76, 0.65, 50)]
    return spark.createDataFrame(
        rows, "candidate string, train_ks double, test_ks double, oot_ks double, train_auc double, test_auc double, oot_auc double, oot_bad_count long"
    )


def test_guardrails_and_targets(spark):
    got = {r.candidate: r for r in review.guardrail_checks(_candidates(spark)).collect()}
    assert got["baseline"].reasons == "train_validate_gap" and got["closer"].passed and got["closer"].gap_forgiven is True
    assert got["worse"].reasons == "train_validate_gap,validate_oot_drop,oot_degradation"
    targets = {r.candidate: r for r in review.target_check(_candidates(spark)).collect()}
    assert targets["baseline"].target_met and targets["worse"].missed == "oot_ks,oot_auc" and not targets["worse"].target_close


def test_candidate_choice(spark):
    rows = {r.candidate: r for r in review.candidate_comparison(_candidates(spark), "ks", 0.01).collect()}
    assert rows["worse"].selected_candidate and rows["worse"].improvement_vs_baseline == pytest.approx(0.05)
    rows = {r.candidate: r for r in review.candidate_comparison(_candidates(spark), "ks", 0.2).collect()}
    assert rows["baseline"].selected_candidate and not rows["worse"].accepted


def test_best_trial_skips_rejected_and_degenerate(spark):
    rows = [("a", "complete", 0.4, 0.35, 0.34, None, 0.7, 50), ("b", "pruned", 0.9, 0.9, 0.9, None, 0.9, 50), ("c", "complete", 1.0, 1.0, 1.0, None, 0.5, 1)]
    trials = spark.createDataFrame(
        rows, "trial string, status string, train_ks double, validate_ks double, oot_ks double, oot_psi double, validate_auc double, score_unique_count long"
    )
    assert review.best_trial(trials).first().trial == "a"
