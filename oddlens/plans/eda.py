"""The full set of exploratory tables of one sample table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddlens.functions.columns import is_bad, numeric_columns
from oddlens.operators import binning, correlation, discrimination, stability
from oddlens.operators.contract import ValidatedContract
from oddlens.sources.stages import stage


@dataclass(frozen=True)
class EdaBundle:
    univariate_overview: DataFrame
    binning_detail: DataFrame
    monthly_sample: DataFrame
    monthly_psi: DataFrame
    psi_summary: DataFrame
    monthly_discrimination: DataFrame
    ks_bucket: DataFrame
    correlation_pairs: DataFrame
    correlation_matrix: DataFrame


def eda_bundle(
    df: DataFrame,
    validated: ValidatedContract,
    month: str = "event_month",
    bins: int = 10,
    buckets: int | None = None,
    max_categories: int = 20,
    baseline: str | None = None,
    method: str = "quantile",
    correlation_method: str = "pearson",
) -> EdaBundle:
    """Fit bins once and derive all nine tables from them.

    ``df`` must carry the month column (see ``add_event_dates``) and valid labels.
    ``buckets`` defaults to the number of bins.
    """
    contract, features = validated.contract, list(validated.feature_cols)
    bad = is_bad(contract.target_col, contract.bad_label)
    fitted = binning.fit_bins(df, features, bins, max_categories, method, bad)
    counts = stage(binning.bin_counts(df, fitted, bad))
    psi = stage(stability.monthly_psi(df, fitted, month, baseline))
    numeric = numeric_columns(df, features)
    pairs = stage(correlation.correlation_pairs(df, numeric, correlation_method))
    return EdaBundle(
        univariate_overview=discrimination.univariate_overview(df, features, bad, fitted=fitted),
        binning_detail=binning.bin_detail(counts, binning.bin_labels(df, fitted)),
        monthly_sample=stability.monthly_sample(df, bad, month, baseline),
        monthly_psi=psi,
        psi_summary=stability.psi_summary(psi),
        monthly_discrimination=discrimination.monthly_discrimination(
            df, fitted, bad, contract.id_cols, month, psi
        ),
        ks_bucket=discrimination.ks_buckets(df, fitted, bad, contract.id_cols, buckets or bins),
        correlation_pairs=pairs.orderBy(F.desc("abs_correlation"), "feature_1", "feature_2"),
        correlation_matrix=correlation.correlation_matrix(pairs, numeric),
    )
