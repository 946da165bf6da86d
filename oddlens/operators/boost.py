"""Boosted trees with Spark ML: train, score, history, importance, tuning.

Spark's own distributed trees do the training. Trees are grown on the train split
only; the test split stops them: rounds are grown until ``early_stopping_rounds`` have
passed since the best staged KS or AUC, and the best one is used. A fit of more rounds
begins with the trees of a fit of fewer, so growing goes on by doubling and costs at most
twice the rounds of the last fit. Out-of-time rows are never passed to training.

Scores of a whole model come from Spark; outputs of single trees, which the history and
permutation importance need, from ``trees``. Categorical features carry nominal
metadata, so Spark splits on sets of categories.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddlens.functions.columns import clean_number
from oddlens.functions.ranking import prefix_sums
from oddlens.operators.binning import local_frame
from oddlens.operators.discrimination import rank_metrics
from oddlens.operators.evaluate import evaluate_scores
from oddlens.operators.review import BOUNDS, trial_table
from oddlens.operators.trees import ROWS, first_trees, node_table, tree_arrays
from oddlens.sources.stages import stage

# Missing numbers get a value below any real one, so a single split isolates them.
MISSING_VALUE = -1.0e12
# Steps of the scores that the history counts, and scores that a task holds before it counts them.
HISTORY_GRID, HELD = 1 << 14, 1 << 19


@dataclass(frozen=True)
class BoosterParams:
    learning_rate: float = 0.1
    max_depth: int = 4
    min_data_in_leaf: int = 20
    feature_fraction: float = 1.0
    bagging_fraction: float = 1.0
    min_gain_to_split: float = 0.0
    num_boost_round: int = 20
    early_stopping_rounds: int = 10
    early_stopping_metric: str = "ks"
    max_bins: int = 64


@dataclass(frozen=True)
class BoostedModel:
    model: GBTClassificationModel
    features: tuple[str, ...]
    best_iteration: int
    history: DataFrame
    params: BoosterParams
    seed: int
    categorical: Mapping[str, int] = field(default_factory=dict)


def assemble(df: DataFrame, features: Sequence[str], categorical: Mapping[str, int] | None = None) -> DataFrame:
    """Add the ``features`` vector; missing values become ``MISSING_VALUE``.

    ``categorical`` names the features whose values are codes below the given number; they
    become nominal, and missing or other values a category of their own.
    """
    codes = categorical or {}
    filled = {}
    for i, f in enumerate(features):
        value = clean_number(F.col(f))
        if f in codes:
            known = value.between(0, codes[f] - 1) & (value == F.floor(value))
            attribute = {"ml_attr": {"type": "nominal", "name": f"__f{i}", "num_vals": codes[f] + 1}}
            filled[f"__f{i}"] = F.when(known, value).otherwise(F.lit(float(codes[f]))).alias(f"__f{i}", metadata=attribute)
        else:
            filled[f"__f{i}"] = F.coalesce(value, F.lit(MISSING_VALUE)).alias(f"__f{i}")
    ready = df.select("*", *filled.values())
    return VectorAssembler(inputCols=list(filled), outputCol="features").transform(ready).drop(*filled)


def class_weights(train: DataFrame, bad: Column) -> DataFrame:
    """One row: good and bad counts of the train split and the weight of a bad row."""
    return train.agg(
        F.count_if(bad == 0).alias("good_count"), F.count_if(bad == 1).alias("bad_count")
    ).withColumn("bad_weight", F.when(F.col("bad_count") > 0, F.col("good_count") / F.col("bad_count")))


def _probability(margins: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-2 * margins))


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    """The last column, an array of doubles of one length, as a matrix."""
    return batch.column(batch.num_columns - 1).flatten().to_numpy().reshape(batch.num_rows, -1)


def staged_scores(df: DataFrame, model: GBTClassificationModel, keep: Sequence[str]) -> DataFrame:
    """``(*keep, iteration, score)`` for every number of trees (needs ``features``)."""
    shared = df.sparkSession.sparkContext.broadcast(tree_arrays(model, df.sparkSession))

    @F.pandas_udf("array<double>")
    def scores(vectors: pd.Series) -> pd.Series:
        found = [_probability(np.cumsum(shared.value.margins(np.stack(vectors.iloc[a : a + ROWS])), axis=1)) for a in range(0, len(vectors), ROWS)]
        return pd.Series([row for part in found for row in part], dtype=object)

    each = df.select(*keep, F.posexplode(scores(vector_to_array("features"))).alias("iteration", "score"))
    return each.withColumn("iteration", F.col("iteration") + 1)


def counted_slices(parts: Iterable[np.ndarray], held: int = HELD) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct keys and their counts, of slices that end once they have more than ``held`` keys."""
    slice_, size = [], 0
    for part in parts:
        slice_.append(part)
        size += len(part)
        if size > held:
            yield np.unique(np.concatenate(slice_), return_counts=True)
            slice_, size = [], 0
    if size:
        yield np.unique(np.concatenate(slice_), return_counts=True)


def staged_counts(df: DataFrame, model: GBTClassificationModel, grid: int = HISTORY_GRID) -> DataFrame:
    """``(dataset, iteration, score, n, bad)`` for every number of trees, of scores on a grid.

    Scores are counted inside the tasks, so no table of rows times trees is made: a task
    holds one whole number per row and tree, at most ``HELD`` and those of ``ROWS`` rows,
    and returns the counts of each such slice; Spark adds them before its shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(tree_arrays(model, df.sparkSession))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value

        def keys() -> Iterator[np.ndarray]:
            for batch in batches:
                for a in range(0, batch.num_rows, ROWS):
                    part = batch.slice(a, ROWS)
                    test = part.column(0).to_numpy(zero_copy_only=False) == "test"
                    bad = part.column(1).to_numpy().astype(np.int64)
                    cells = np.rint(_probability(np.cumsum(trees.margins(_vectors(part)), axis=1)) * grid).astype(np.int64)
                    iteration = np.arange(1, cells.shape[1] + 1)
                    yield (((iteration * 2 + test[:, None]) * (grid + 1) + cells) * 2 + bad[:, None]).ravel()

        for key, n in counted_slices(keys()):
            key, bad = np.divmod(key, 2)
            key, cell = np.divmod(key, grid + 1)
            key, test = np.divmod(key, 2)
            columns = [pa.array(np.where(test == 1, "test", "train")), pa.array(key.astype(np.int32)), pa.array(cell / grid), pa.array(n), pa.array(n * bad)]
            yield pa.RecordBatch.from_arrays(columns, names=["dataset", "iteration", "score", "n", "bad"])

    rows = df.select("dataset", F.col("label").cast("long"), vector_to_array("features").alias("x"))
    counted = rows.mapInArrow(count, "dataset string, iteration int, score double, n long, bad long")
    return counted.groupBy("dataset", "iteration", "score").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def training_history(df: DataFrame, model: GBTClassificationModel) -> DataFrame:
    """Train and test AUC / KS per iteration, of scores on a grid of ``HISTORY_GRID`` steps."""
    cells = stage(staged_counts(df, model))
    metrics = rank_metrics(prefix_sums(cells, ["iteration", "dataset"], ["score"], ["n", "bad"]), ["iteration", "dataset"])
    wide = metrics.groupBy("iteration").pivot("dataset", ["train", "test"]).agg(
        F.max("auc_raw").alias("auc"), F.max("ks").alias("ks")
    )
    return wide.withColumns({f"{m}_gap": F.col(f"train_{m}") - F.col(f"test_{m}") for m in ("auc", "ks")})


def _best_iteration(history: DataFrame, params: BoosterParams) -> tuple[int, bool]:
    """The best iteration, and whether the rounds after it suffice to stop there."""
    best, best_value = 1, -1.0
    rows = history.select("iteration", F.col(f"test_{params.early_stopping_metric}").alias("v")).orderBy("iteration")
    for row in rows.collect():
        if row.v is not None and row.v > best_value:
            best, best_value = row.iteration, row.v
        elif row.iteration - best >= params.early_stopping_rounds:
            return best, True
    return best, False


def fit_booster(
    df: DataFrame,
    features: Sequence[str],
    bad: Column,
    params: BoosterParams | None = None,
    seed: int = 42,
    balance: bool = False,
    train: str = "train",
    test: str = "test",
    categorical: Mapping[str, int] | None = None,
) -> BoostedModel:
    """Train on ``dataset = train`` and stop by the staged metric on ``test``.

    ``categorical``: number of codes of the features whose codes have no order. The history
    ends with the round that stopped the fit: at most ``early_stopping_rounds`` after the best.
    """
    params = params or BoosterParams()
    codes = {f: n for f, n in (categorical or {}).items() if f in features}
    return _fit(training_rows(df, features, bad, train, test, codes), features, params, seed, balance, codes)


def training_rows(
    df: DataFrame, features: Sequence[str], bad: Column, train: str = "train", test: str = "test", codes: Mapping[str, int] | None = None
) -> DataFrame:
    """``(features, dataset, label)`` of the labelled train and test rows, written once for all fits on them."""
    used = df.where(F.col("dataset").isin(train, test)).select(
        *features,
        F.when(F.col("dataset") == train, "train").otherwise("test").alias("dataset"),
        bad.cast("double").alias("label"),
    )
    return stage(assemble(used.where("label is not null"), features, codes).select("features", "dataset", "label"))


def _fit(
    used: DataFrame, features: Sequence[str], params: BoosterParams, seed: int, balance: bool, codes: Mapping[str, int]
) -> BoostedModel:
    rows = used.where("dataset = 'train'")
    booster = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        stepSize=params.learning_rate,
        maxDepth=params.max_depth,
        minInstancesPerNode=params.min_data_in_leaf,
        subsamplingRate=params.bagging_fraction,
        featureSubsetStrategy=str(params.feature_fraction) if params.feature_fraction < 1.0 else "all",
        minInfoGain=params.min_gain_to_split,
        maxBins=max([params.max_bins, *(n + 1 for n in codes.values())]),
        seed=seed,
    )
    if balance:
        weight = class_weights(rows, F.col("label")).first().bad_weight
        if not weight:
            raise ValueError("class weights need both classes in train")
        rows = rows.withColumn("weight", F.when(F.col("label") == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))
        booster = booster.setWeightCol("weight")
    # The first fit is long enough to stop at an early best; each next one doubles it.
    grown = min(params.num_boost_round, max(16, params.early_stopping_rounds + params.early_stopping_rounds // 4))
    while True:
        model = booster.setMaxIter(grown).fit(rows)
        history = stage(training_history(used, model))
        best, done = _best_iteration(history, params)
        if done or grown >= params.num_boost_round:
            break
        grown = min(params.num_boost_round, 2 * grown)
    shown = history.where(F.col("iteration") <= best + params.early_stopping_rounds)
    marked = shown.withColumn("is_best_iteration", F.col("iteration") == best)
    return BoostedModel(model, tuple(features), best, marked, params, seed, codes)


def score_rows(df: DataFrame, trained: BoostedModel, name: str = "bad_probability") -> DataFrame:
    """Add the probability of bad at the best iteration; one narrow pass, however many trees."""
    ready = assemble(df, trained.features, trained.categorical)
    scored = first_trees(trained.model, trained.best_iteration).transform(ready)
    return scored.select(*df.columns, F.get(vector_to_array("probability"), F.lit(1)).alias(name))


def feature_importance(trained: BoostedModel, df: DataFrame) -> DataFrame:
    """Gain and split count per feature over the trees in use, largest gain first.

    Read from the node table that Spark writes when the model is saved.
    """
    splits = (
        node_table(trained.model, df.sparkSession)
        .where((F.col("treeID") < trained.best_iteration) & (F.col("leftChild") >= 0))
        .groupBy(F.col("split.featureIndex").alias("position"))
        .agg(F.sum(F.col("gain") * F.col("rawCount")).alias("gain_importance"), F.count("*").alias("split_importance"))
    )
    names = local_frame(df, pd.DataFrame(list(enumerate(trained.features)), columns=["position", "feature"]))
    return (
        names.join(splits, "position", "left")
        .fillna(0, ["gain_importance", "split_importance"])
        .select("feature", "gain_importance", "split_importance")
        .orderBy(F.desc("gain_importance"), "feature")
    )


def shifted_rows(
    df: DataFrame, trained: BoostedModel, bad: Column, id_cols: Sequence[str], seed: int, dataset: str
) -> DataFrame:
    """``(dataset, __bad, __other, __x)``: features of a row and of the next one in hash order.

    One shuffle: the next row is found inside each slice of the order, and the first row of
    the following slice (one per slice) completes the last one.
    """
    order = ["__h", *[f"__id{i}" for i in range(len(id_cols))]]
    named = {f"__id{i}": F.col(c) for i, c in enumerate(id_cols)}
    base = df.where(F.col(dataset).isNotNull()).withColumns(named | {"__bad": bad.cast("long"), "__h": F.xxhash64(F.lit(seed), *id_cols)})
    ready = assemble(base, trained.features, trained.categorical).select(dataset, *order, "__bad", vector_to_array("features").alias("__x"))
    sliced = ready.repartitionByRange(dataset, *order).withColumn("__slice", F.spark_partition_id())
    inside = Window.partitionBy(dataset, "__slice").orderBy(*order)
    rows = stage(sliced.select(
        dataset, "__slice", "__bad", "__x", F.lead("__x").over(inside).alias("__other"), (F.row_number().over(inside) == 1).alias("__head"),
    ))
    heads = rows.where("__head").select(dataset, "__slice", F.col("__x").alias("__first"))
    ring = Window.partitionBy(dataset).orderBy("__slice")
    following = F.coalesce(F.lead("__first").over(ring), F.first("__first").over(ring))
    heads = stage(heads.select(dataset, "__slice", following.alias("__following")))
    joined = rows.join(heads, [dataset, "__slice"])
    return joined.select(dataset, "__bad", F.coalesce("__other", "__following").alias("__other"), "__x")


def permuted_counts(pairs: DataFrame, trained: BoostedModel, dataset: str) -> DataFrame:
    """``(dataset, feature, num, n, bad)``: counted scores of the pairs, of each batch; '' means intact."""
    spark = pairs.sparkSession
    shared = spark.sparkContext.broadcast((tree_arrays(trained.model, spark, trained.best_iteration), list(trained.features)))

    def rescored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, names = shared.value
        users = [trees.users(k) for k in range(len(names))]
        labels = pa.array(["", *names])
        for batch in batches:
            found = []
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                x = _vectors(part)
                other = part.column(2).flatten().to_numpy().reshape(x.shape)
                each = trees.margins(x)
                whole = each.sum(axis=1)
                scores = [whole]
                for k, used in enumerate(users):
                    mixed = x.copy()
                    mixed[:, k] = other[:, k]
                    scores.append(whole - each[:, used].sum(axis=1) + trees.margins(mixed, used).sum(axis=1) if len(used) else whole)
                found.append(np.column_stack(scores))
            if not found:
                continue
            split = batch.column(0).dictionary_encode()
            score, place = np.unique(_probability(np.concatenate(found)).round(12).ravel(), return_inverse=True)
            row, feature = np.divmod(np.arange(len(place)), len(labels))
            key = (place * len(labels) + feature) * len(split.dictionary) + split.indices.to_numpy()[row]
            key, place = np.unique(key, return_inverse=True)
            bad = np.bincount(place, weights=batch.column(1).fill_null(0).to_numpy()[row]).astype(np.int64)
            key, which = np.divmod(key, len(split.dictionary))
            key, feature = np.divmod(key, len(labels))
            columns = [split.dictionary.take(pa.array(which)), labels.take(pa.array(feature)), pa.array(score[key]), pa.array(np.bincount(place)), pa.array(bad)]
            yield pa.RecordBatch.from_arrays(columns, names=[dataset, "feature", "num", "n", "bad"])

    rows = pairs.withColumn(dataset, F.col(dataset).cast("string"))
    return rows.mapInArrow(rescored, f"`{dataset}` string, feature string, num double, n long, bad long")


def permutation_importance(
    df: DataFrame,
    trained: BoostedModel,
    bad: Column,
    id_cols: Sequence[str],
    seed: int = 42,
    dataset: str = "dataset",
) -> DataFrame:
    """AUC loss per split and feature when a column is shuffled inside its split.

    Rows are put in hash order and each row takes the values of the next one (the last
    those of the first), which is a random permutation without fixed points. The margins
    of all trees are computed once; for a feature only the trees that split on it are
    walked again. Tasks return counts of scores, not scores.
    """
    cells = permuted_counts(shifted_rows(df, trained, bad, id_cols, seed, dataset), trained, dataset)
    keys = [dataset, "feature"]
    counts = cells.groupBy(*keys, "num").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    auc = stage(rank_metrics(prefix_sums(counts, keys, ["num"], ["n", "bad"]), keys))
    intact = auc.where("feature = ''").select(dataset, F.col("auc_raw").alias("intact_auc"))
    return (
        auc.where("feature <> ''")
        .join(intact, dataset)
        .select(
            "feature",
            dataset,
            "intact_auc",
            F.col("auc_raw").alias("shuffled_auc"),
            F.greatest(F.lit(0.0), F.col("intact_auc") - F.col("auc_raw")).alias("permutation_importance"),
        )
    )


def seed_stability(
    df: DataFrame,
    features: Sequence[str],
    bad: Column,
    id_cols: Sequence[str],
    params: BoosterParams | None = None,
    seed: int = 42,
    seeds: int = 3,
    balance: bool = False,
) -> DataFrame:
    """Retrain with seeds ``seed + 1009·i`` and measure every split.

    The training rows are written once for all seeds, and the narrow scored rows once per
    seed, so that ranking them does not score them again.
    """
    parts = []
    used = training_rows(df, features, bad)
    narrow = ["dataset", *[c for c in id_cols if c != "dataset"]]
    for i in range(seeds):
        trained = _fit(used, features, params or BoosterParams(), seed + 1009 * i, balance, {})
        scored = score_rows(df.withColumn("__bad", bad), trained)
        scored = stage(scored.select(*narrow, "__bad", "bad_probability"))
        metrics = evaluate_scores(scored, "bad_probability", F.col("__bad"), id_cols, ["dataset"])
        parts.append(
            metrics.select(
                F.lit(trained.seed).alias("seed"),
                "dataset",
                F.lit(trained.best_iteration).alias("best_iteration"),
                "auc",
                "ks",
                "pr_auc",
                "brier_score",
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def sample_parameters(base: BoosterParams, trials: int, seed: int = 42) -> list[BoosterParams]:
    """Seeded random draws inside the search bounds (logarithmic where scales differ)."""
    draw = random.Random(seed)

    def log_uniform(low: float, high: float) -> float:
        return math.exp(draw.uniform(math.log(low), math.log(high)))

    drawn = []
    for _ in range(trials):
        drawn.append(
            replace(
                base,
                learning_rate=log_uniform(*BOUNDS["learning_rate"]),
                max_depth=draw.randint(*BOUNDS["max_depth"]),
                min_data_in_leaf=round(log_uniform(*BOUNDS["min_data_in_leaf"])),
                feature_fraction=draw.uniform(*BOUNDS["feature_fraction"]),
                bagging_fraction=draw.uniform(*BOUNDS["bagging_fraction"]),
                min_gain_to_split=0.0,
            )
        )
    return drawn


def tune_booster(
    df: DataFrame,
    features: Sequence[str],
    bad: Column,
    fold_plan: DataFrame,
    base: BoosterParams | None = None,
    trials: int = 5,
    seed: int = 42,
    month: str = "event_month",
    metric: str = "ks",
) -> tuple[DataFrame, DataFrame, BoosterParams]:
    """Random search over month folds; returns fold rows, trial table, best params.

    Each fit is one distributed Spark ML job. Only metric rows (trials × folds) are
    gathered.
    """
    plan: dict[int, dict[str, str]] = {}
    for row in fold_plan.collect():  # months × folds
        plan.setdefault(row.fold, {})[row.event_month] = "train" if row.role == "train" else "test"
    narrow = stage(df.select(*features, F.col(month), bad.cast("int").alias("__bad")))
    options = sample_parameters(base or BoosterParams(), trials, seed)
    rows = []
    for trial, params in enumerate(options):
        for fold, months in sorted(plan.items()):
            lookup = F.create_map(*[F.lit(x) for pair in sorted(months.items()) for x in pair])
            part = narrow.withColumn("dataset", lookup[F.col(month)]).where("dataset is not null")
            trained = fit_booster(part, features, F.col("__bad"), params, seed + trial * 100 + fold)
            best = trained.history.where("is_best_iteration").first()
            rows.append(
                {
                    "trial": trial,
                    "fold": fold,
                    "best_iteration": trained.best_iteration,
                    "train_auc": best.train_auc,
                    "train_ks": best.train_ks,
                    "validation_auc": best.test_auc,
                    "validation_ks": best.test_ks,
                    **{f"p_{k}": v for k, v in asdict(params).items() if not isinstance(v, str)},
                }
            )
    folds = local_frame(df, pd.DataFrame(rows))
    table = trial_table(folds, metric)
    winner = table.orderBy(F.desc("score"), "trial").first().trial
    return folds, table, options[winner]
