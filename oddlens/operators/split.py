"""Time splits, stratified splits, folds and their summaries.

Months are few, so split rules work on the month table; rows only receive a literal
or joined label. Stratified splits cut each class by a hash of the IDs: a histogram of
hashes shows where a cut lies, only the IDs around it are ranked, and rows are compared
with the cut. Wide rows are never sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddlens.functions.columns import ratio
from oddlens.functions.ranking import prefix_sums
from oddlens.operators.contract import ContractError
from oddlens.sources.stages import stage


def month_counts(df: DataFrame, month: str = "event_month", bad: Column | None = None) -> DataFrame:
    aggs = [F.count("*").alias("sample_count")]
    if bad is not None:
        aggs.append(F.coalesce(F.sum(bad.cast("long")), F.lit(0)).alias("bad_count"))
    return df.where(F.col(month).isNotNull()).groupBy(F.col(month).alias("event_month")).agg(*aggs)


def time_split_months(months: DataFrame, oot_months: int = 2, test_months: int = 2) -> DataFrame:
    """``(event_month, dataset)``: newest months OOT, the ones before test, rest train."""
    place = F.row_number().over(Window.orderBy(F.desc("event_month")))  # months-sized
    label = (
        F.when(F.col("place") <= oot_months, "oot")
        .when(F.col("place") <= oot_months + test_months, "test")
        .otherwise("train")
    )
    return months.select("event_month", place.alias("place")).select("event_month", label.alias("dataset"))


def ratio_split_months(
    months: DataFrame,
    oot_months: int = 2,
    validate_ratio: float = 0.20,
    exclude_incomplete: bool = True,
    incomplete_ratio: float = 0.30,
) -> DataFrame:
    """``(event_month, dataset)`` with datasets train, validate, oot and excluded.

    The newest month is excluded when far below the median month. Validation takes
    the newest remaining months until it holds the asked share of their rows.
    """
    newest = Window.orderBy(F.desc("event_month"))  # all windows here are months-sized
    every = Window.partitionBy()
    ranked = months.select(
        "event_month",
        "sample_count",
        F.row_number().over(newest).alias("place"),
        F.percentile("sample_count", 0.5).over(every).alias("typical"),
        F.count("*").over(every).alias("months"),
    )
    is_cut = (
        F.lit(exclude_incomplete)
        & (F.col("place") == 1)
        & (F.col("months") >= 2)
        & (F.col("sample_count") < F.col("typical") * incomplete_ratio)
    )
    ranked = ranked.withColumn("cut", is_cut.cast("int"))
    ranked = ranked.withColumn("place", F.col("place") - F.max("cut").over(every))
    in_history = (F.col("cut") == 0) & (F.col("place") > oot_months)
    history = F.when(in_history, F.col("sample_count")).otherwise(0)
    ranked = ranked.withColumns(
        {
            "target": F.greatest(F.lit(1), F.floor(F.sum(history).over(every) * F.lit(validate_ratio))),
            "newer": F.sum(history).over(newest.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - history,
        }
    )
    label = (
        F.when(F.col("cut") == 1, "excluded")
        .when(F.col("place") <= oot_months, "oot")
        .when(F.col("newer") < F.col("target"), "validate")
        .otherwise("train")
    )
    return ranked.select("event_month", label.alias("dataset"))


def label_rows(df: DataFrame, manifest: DataFrame, month: str = "event_month") -> DataFrame:
    """Add ``dataset`` to every row with a listed month; other rows drop out.

    The manifest (one row per month) is read once and becomes a literal map, so the
    rows are labelled inside the scan without a join.
    """
    pairs = manifest.select("event_month", "dataset").collect()
    if not pairs:
        raise ContractError("no month to split on")
    lookup = F.create_map(*[F.lit(x) for p in sorted(pairs) for x in (p.event_month, p.dataset)])
    return df.withColumn("dataset", lookup[F.col(month)]).where("dataset is not null")


def time_split(
    df: DataFrame, oot_months: int = 2, test_months: int = 2, month: str = "event_month"
) -> DataFrame:
    """Label rows train / test / oot by month; rows without a month drop out."""
    manifest = time_split_months(month_counts(df, month), oot_months, test_months)
    found = manifest.count()
    if found <= oot_months + test_months:
        raise ContractError(f"{found} months are too few for {test_months} test and {oot_months} oot months")
    return label_rows(df, manifest, month)


# Leading bits of the hash that the histogram of a cut counts by.
_CUT_BITS = 12


def _cut_key(id_cols: Sequence[str], seed: int) -> Column:
    """What rows are cut by: the hash of the IDs, then the IDs."""
    parts = [F.col(c).alias(f"id{k}") for k, c in enumerate(id_cols)]
    return F.struct(F.xxhash64(F.lit(seed), *id_cols).alias("h"), *parts)


def _class_cuts(df: DataFrame, target: str, id_cols: Sequence[str], seed: int, ranks: Column) -> DataFrame:
    """``(__class, cuts)``: per class, the cut keys at the asked ranks.

    ``ranks`` is an array of ranks, an expression of the class size ``total``. Each cut has
    its ``place`` in that array, its key ``at`` and the number ``upto`` of rows up to it.
    Two scans of target and IDs: a histogram of the leading bits of the hash (combined
    map-side), then the rows in the slots that hold a cut, 1 in 4,096 of a class each. Rows
    with equal IDs lie on one side of a cut. A null label is a class like any other.
    """
    keyed = df.select(F.col(target).alias("__class"), _cut_key(id_cols, seed).alias("__key"))
    keyed = keyed.withColumn("__slot", F.shiftright(F.col("__key.h"), 64 - _CUT_BITS))
    counts = stage(keyed.groupBy("__class", "__slot").agg(F.count("*").alias("n")))
    whole = Window.partitionBy("__class")  # at most 4,096 rows
    placed = counts.select(
        "__class", "__slot", "n", F.sum("n").over(whole.orderBy("__slot")).alias("upto"), F.sum("n").over(whole).alias("total")
    )
    asked = placed.select("*", F.posexplode(ranks).alias("place", "rank"))
    wanted = asked.where((F.col("rank") > F.col("upto") - F.col("n")) & (F.col("rank") <= F.col("upto")))
    edges = stage(
        wanted.select(
            F.col("__class").alias("__of"), F.col("__slot").alias("__in"), "place", "rank", (F.col("upto") - F.col("n")).alias("before")
        )
    )
    near = F.col("__class").eqNullSafe(F.col("__of")) & (F.col("__slot") == F.col("__in"))
    inside = keyed.join(edges, near, "left_semi").groupBy("__class", "__slot", "__key").agg(F.count("*").alias("n"))
    upto = F.col("before") + F.col("cum_n")
    hits = (
        prefix_sums(inside, ["__class", "__slot"], ["__key"], ["n"])
        .join(edges, near)
        .where((F.col("rank") <= upto) & (F.col("rank") > upto - F.col("n")))
    )
    cut = F.struct("place", F.col("__key").alias("at"), upto.alias("upto"))
    return stage(hits.groupBy("__class").agg(F.sort_array(F.collect_list(cut)).alias("cuts")))  # few cuts a class


def _with_cuts(df: DataFrame, target: str, cuts: DataFrame) -> DataFrame:
    """Rows with the cuts of their class; the written size of ``cuts`` lets Spark broadcast it."""
    return df.join(cuts, F.col(target).eqNullSafe(F.col("__class")), "left")


def stratified_test(
    df: DataFrame,
    target: str,
    id_cols: Sequence[str],
    test_ratio: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Label rows train / test with the same share per class (seeded, repeatable).

    Each class gives round(n·ratio) rows, at least one and never all of them. Rows
    without a label stay in train. Rows with equal IDs stay together, so repeated IDs
    at the cut can make the test set larger; where they would take all, they stay out.
    """
    total = F.col("total")
    asked = F.bround(total * F.lit(test_ratio)).cast("long")
    size = F.when(total >= 2, F.greatest(F.lit(1), F.least(asked, total - 1))).otherwise(0)
    sizes = F.array(size.cast("long"), total)  # the last one's count is that of the class
    cut, last = F.col("cuts")[0], F.element_at("cuts", -1)
    key = _cut_key(id_cols, seed)
    is_test = (key < cut["at"]) | ((key == cut["at"]) & (cut["upto"] < last["upto"]))
    chosen = F.col(target).isNotNull() & (F.size("cuts") == 2) & is_test
    label = F.when(chosen, "test").otherwise("train")
    cuts = _class_cuts(df, target, id_cols, seed, sizes)
    return _with_cuts(df, target, cuts).select(*[F.col(f"`{c}`") for c in df.columns], label.alias("dataset"))


def stratified_folds(
    df: DataFrame, target: str, id_cols: Sequence[str], folds: int = 3, seed: int = 42
) -> DataFrame:
    """Add ``fold`` 1..k: parts of each class in hash order whose sizes differ by one row at most.

    Rows without a label are a class of their own; rows with equal IDs stay together.
    """
    total = F.col("total")
    share, rest = F.floor(total / F.lit(folds)), total % folds
    ranks = F.array(*[(share * k + F.least(rest, F.lit(k))).cast("long") for k in range(1, folds)])
    key = _cut_key(id_cols, seed)
    passed = F.size(F.filter("cuts", lambda cut: cut["at"] < key))
    fold = F.greatest(F.lit(0), F.coalesce(passed, F.lit(0))) + 1
    cuts = _class_cuts(df, target, id_cols, seed, ranks)
    return _with_cuts(df, target, cuts).select(*[F.col(f"`{c}`") for c in df.columns], fold.cast("int").alias("fold"))


def rolling_folds(
    months: DataFrame,
    folds: int = 3,
    validation_months: int = 1,
    gap_months: int = 0,
    min_train_months: int = 3,
) -> DataFrame:
    """``(fold, event_month, role)``: expanding train windows, newest ``folds`` kept."""
    if folds < 1 or validation_months < 1 or gap_months < 0 or min_train_months < 1:
        raise ValueError("fold settings are out of range")
    place = F.row_number().over(Window.orderBy("event_month"))  # months-sized
    total = F.count("*").over(Window.partitionBy())
    ranked = months.select("event_month", (place - 1).alias("place"), total.alias("total"))
    # starts of validation windows that fit, as one small array per month row
    first = F.lit(min_train_months + gap_months)
    last = F.col("total") - validation_months
    kept = F.greatest(first.cast("long"), last - folds + 1)
    starts = F.when(last >= first, F.sequence(kept, last))
    role = F.when(F.col("place") < F.col("start") - gap_months, "train").when(
        F.col("place").between(F.col("start"), F.col("start") + validation_months - 1), "validation"
    )
    return (
        ranked.select("event_month", "place", kept.alias("kept"), F.explode(starts).alias("start"))
        .withColumn("role", role)
        .where("role is not null")
        .select((F.col("start") - F.col("kept") + 1).cast("int").alias("fold"), "event_month", "role")
    )


def fold_rows(df: DataFrame, plan: DataFrame, month: str = "event_month") -> DataFrame:
    """Rows repeated for each fold they belong to (``fold``, ``role`` added)."""
    return df.join(plan.withColumnRenamed("event_month", month), month)


def fold_guard(df: DataFrame, plan: DataFrame, bad: Column, minimum: int = 20, month: str = "event_month") -> DataFrame:
    """Bad samples per validation fold and whether they suffice.

    Rows are counted per month first; folds only add up months.
    """
    months = month_counts(df, month, bad)
    return (
        plan.where("role = 'validation'")
        .join(months, "event_month", "left")
        .groupBy("fold")
        .agg(F.coalesce(F.sum("bad_count"), F.lit(0)).alias("bad_count"))
        .withColumn("enough", F.col("bad_count") >= minimum)
    )


def split_summary(df: DataFrame, bad: Column, month: str = "event_month") -> DataFrame:
    """Counts, bad rate and month range per split."""
    return (
        df.groupBy("dataset")
        .agg(
            F.count("*").alias("sample_count"),
            F.coalesce(F.sum(bad.cast("long")), F.lit(0)).alias("bad_count"),
            F.min(month).alias("month_start"),
            F.max(month).alias("month_end"),
            F.array_join(F.sort_array(F.collect_set(month)), ",").alias("months"),
        )
        .withColumns(
            {
                "good_count": F.col("sample_count") - F.col("bad_count"),
                "bad_rate": ratio(F.col("bad_count"), F.col("sample_count")),
            }
        )
    )
