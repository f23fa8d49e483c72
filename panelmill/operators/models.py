"""Candidate classifiers on ``pyspark.ml``: preparation, class weights, fits, comparison."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.operators.ensembles import prefix_model, prefix_scores
from panelmill.operators.metrics import confusion_of_cells, ranking_of_cells, stored_cells, threshold_metrics
from panelmill.operators.perceptron import fit_perceptron
from panelmill.operators.profile import quantiles
from panelmill.operators.scoring import PROBABILITY, with_probability
from panelmill.operators.treefits import fit_ensembles, fit_trees
from panelmill.schema import FEATURES, TARGET
from panelmill.session import enable_checkpoints, scratch_path
from panelmill.sources.tables import staged

WEIGHT = "class_weight"
SEED = 42
#: Training rows of a task, at least, where a table has more than one.
TASK_ROWS = 15_000


def medians(df: DataFrame, features: Sequence[str] = FEATURES) -> dict[str, float]:
    """Exact (lower) median of each feature; 0 where it has no value at all."""
    found = {r["column_name"]: r["value"] for r in quantiles(df, features, (0.5,)).collect()}  # a row per feature
    return {f: found.get(f, 0.0) for f in features}


def preparation(fill: Mapping[str, float]) -> list:
    """Given values for missing ones, ordered vector, zero mean and unit deviation."""
    filled = [f"{f}__filled" for f in fill]
    values = ", ".join(f"coalesce(nanvl(double(`{f}`), null), {float(v)!r}D) as `{f}__filled`" for f, v in fill.items())
    return [
        SQLTransformer(statement=f"select *, {values} from __THIS__"),
        VectorAssembler(inputCols=filled, outputCol="assembled"),
        StandardScaler(inputCol="assembled", outputCol="features", withMean=True, withStd=True),
    ]


def class_weights(df: DataFrame, scheme: str = "balanced", target: str = TARGET) -> DataFrame:
    """One row: weight of either class and the total weight.

    ``balanced``: rows / (2 * rows of the class). ``retained``: the negative class
    weighs positives / negatives. ``scaled``: the positive class weighs
    negatives / positives.
    """
    counts = df.agg(
        F.count_if(F.col(target) == 1).alias("_p"), F.count_if(F.col(target) == 0).alias("_n")
    )
    p, n, one = F.col("_p").cast("double"), F.col("_n").cast("double"), F.lit(1.0)
    negative, positive = {
        "balanced": ((p + n) / (2 * F.nullif(n, F.lit(0.0))), (p + n) / (2 * F.nullif(p, F.lit(0.0)))),
        "retained": (p / F.nullif(n, F.lit(0.0)), one),
        "scaled": (one, n / F.nullif(p, F.lit(0.0))),
    }[scheme]
    negative, positive = F.coalesce(negative, one), F.coalesce(positive, one)
    return counts.select(
        negative.alias("negative_weight"),
        positive.alias("positive_weight"),
        (negative * n + positive * p).alias("total_weight"),
    )


def weighted(df: DataFrame, scheme: str = "balanced", target: str = TARGET) -> DataFrame:
    """Rows with the weight of their class; the weights are one aggregate row."""
    weights = class_weights(df, scheme, target)
    weight = F.when(F.col(target) == 1, F.col("positive_weight")).otherwise(F.col("negative_weight"))
    return (
        df.crossJoin(F.broadcast(weights))
        .withColumn(WEIGHT, weight)
        .drop("negative_weight", "positive_weight", "total_weight")
    )


def logistic(total_weight: float, max_iter: int = 2000, c: float = 1.0) -> LogisticRegression:
    """L2 penalty of strength 1/C on the summed loss, as a share of the total weight."""
    return LogisticRegression(
        labelCol=TARGET,
        weightCol=WEIGHT,
        maxIter=max_iter,
        regParam=1.0 / (c * total_weight),
        elasticNetParam=0.0,
        standardization=False,
    )


def forest(trees: int = 300, depth: int = 8, min_leaf: int = 20) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=TARGET,
        weightCol=WEIGHT,
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        featureSubsetStrategy="sqrt",
        seed=SEED,
    )


def boosting(
    trees: int = 300, depth: int = 3, rate: float = 0.03, subsample: float = 0.8, columns: float = 0.8, min_leaf: int = 5
) -> GBTClassifier:
    """Columns are drawn per node, the closest this library has to a draw per tree."""
    return GBTClassifier(
        labelCol=TARGET,
        weightCol=WEIGHT,
        maxIter=trees,
        maxDepth=depth,
        stepSize=rate,
        subsamplingRate=subsample,
        featureSubsetStrategy=str(columns),
        minInstancesPerNode=min_leaf,
        checkpointInterval=10,
        seed=SEED,
    )


def perceptron(n_features: int = len(FEATURES), max_iter: int = 150) -> MultilayerPerceptronClassifier:
    """Two hidden layers, 64 and 32; sigmoid units and L-BFGS, without early stopping."""
    return MultilayerPerceptronClassifier(
        labelCol=TARGET, layers=[n_features, 64, 32, 2], maxIter=max_iter, blockSize=512, seed=SEED
    )


def prepared(train: DataFrame, features: Sequence[str] = FEATURES) -> tuple[PipelineModel, DataFrame]:
    """Preparation fitted once on the training rows, and those rows as stored vectors.

    All candidates share both. Iterative fits submit hundreds of jobs, so they start
    from a table instead of the lineage of the panel, and from as few partitions as its size asks for:
    on a small table the cost of a job is that of its tasks' start.
    """
    fitted = Pipeline(stages=preparation(medians(train, features))).fit(train)
    vectors = staged(fitted.transform(train).select("features", TARGET), "training-vectors")
    parts = -(-vectors.count() // TASK_ROWS)
    return fitted, vectors if parts >= vectors.rdd.getNumPartitions() else vectors.coalesce(max(1, parts))


def _without_summary(model: Model, spark: SparkSession) -> Model:
    """The model as saved. The training summary holds a session and the training
    frame, and would be shipped, or fail to be, with every scoring task."""
    if not getattr(model, "hasSummary", False):
        return model
    path = scratch_path(spark, "model")
    model.write().save(path)
    return type(model).load(path)


def fit(
    train: DataFrame,
    estimator: Estimator,
    features: Sequence[str] = FEATURES,
    scheme: str | None = "balanced",
    shared: tuple[PipelineModel, DataFrame] | None = None,
) -> PipelineModel:
    """Fit one classifier on class-weighted rows behind the preparation."""
    enable_checkpoints(train.sparkSession)
    preparation_model, vectors = shared or prepared(train, features)
    if isinstance(estimator, (GBTClassifier, RandomForestClassifier)):
        weights = class_weights(vectors, scheme).first() if scheme else (1.0, 1.0)  # one aggregate row
        return PipelineModel(stages=[*preparation_model.stages, fit_trees(vectors, estimator, (weights[0], weights[1]))])
    if isinstance(estimator, MultilayerPerceptronClassifier) and estimator.getSolver() == "l-bfgs":  # it takes no weights
        return PipelineModel(stages=[*preparation_model.stages, _without_summary(fit_perceptron(vectors, estimator), train.sparkSession)])
    rows = weighted(vectors, scheme) if scheme else vectors
    model = _without_summary(estimator.fit(rows), train.sparkSession)
    return PipelineModel(stages=[*preparation_model.stages, model])


def fit_side_by_side(
    train: DataFrame, estimators: Sequence[GBTClassifier], scheme: str | None, shared: tuple[PipelineModel, DataFrame]
) -> list[PipelineModel]:
    """Fit boosted classifiers on the same rows: their trees grow in the same jobs."""
    enable_checkpoints(train.sparkSession)
    preparation_model, vectors = shared
    weights = class_weights(vectors, scheme).first() if scheme else (1.0, 1.0)  # one aggregate row
    models = fit_ensembles(vectors, [(e, (weights[0], weights[1])) for e in estimators])
    return [PipelineModel(stages=[*preparation_model.stages, m]) for m in models]


def candidates(
    train: DataFrame, features: Sequence[str] = FEATURES, sizes: Mapping[str, int] | None = None, parallelism: int = 4
) -> dict[str, PipelineModel]:
    """The five candidate models, two of them boosted; their fits are submitted side by side.

    ``sizes`` overrides iterations: ``logistic``, ``forest``, ``boosting``, ``perceptron``.
    """
    size = {"logistic": 2000, "forest": 300, "boosting": 300, "perceptron": 150, **(sizes or {})}
    shared = prepared(train, features)
    # one aggregate row
    total = class_weights(shared[1], "balanced").first()["total_weight"]
    estimators: dict[str, tuple[Estimator, str | None]] = {
        "logistic_regression": (logistic(total, size["logistic"]), "balanced"),
        "random_forest": (forest(size["forest"]), "balanced"),
        "neural_network": (perceptron(len(features), size["perceptron"]), None),
    }
    boosted = {
        "gradient_boosting": boosting(size["boosting"]),
        "deep_boosting": boosting(size["boosting"], depth=5, min_leaf=30),
    }
    with ThreadPoolExecutor(parallelism) as pool:
        together = pool.submit(fit_side_by_side, train, list(boosted.values()), "retained", shared)
        fitted = dict(zip(estimators, pool.map(lambda e: fit(train, e[0], features, e[1], shared), estimators.values()), strict=True))
        fitted |= dict(zip(boosted, together.result(), strict=True))
    order = ("logistic_regression", "random_forest", "gradient_boosting", "deep_boosting", "neural_network")
    return {name: fitted[name] for name in order}


def evaluate(
    model: PipelineModel, rows: DataFrame, name: str, part: str, threshold: float = 0.5
) -> DataFrame:
    """One row of ranking and threshold metrics of a model on one part of the data."""
    return evaluate_cells(stored_cells(with_probability(rows, model), TARGET, PROBABILITY), name, part, threshold)


def evaluate_cells(cells: DataFrame, name: str, part: str, threshold: float = 0.5) -> DataFrame:
    """The same from the stored cells of rows that are scored already."""
    ranking = ranking_of_cells(cells)
    decided = threshold_metrics(confusion_of_cells(cells, threshold))
    return (
        ranking.crossJoin(decided)  # one row each
        .select(
            F.lit(name).alias("model"),
            F.lit(part).alias("split"),
            F.lit(threshold).alias("threshold"),
            "pr_auc",
            "roc_auc",
            "precision",
            "recall",
            "f1",
            "prevalence",
        )
    )


def compare(cells: Mapping[str, DataFrame], part: str = "validation", threshold: float = 0.5) -> DataFrame:
    """Metrics of every model on one part, from the stored cells of its scores."""
    out: DataFrame | None = None
    for name, scored in cells.items():
        row = evaluate_cells(scored, name, part, threshold)
        out = row if out is None else out.unionByName(row)
    if out is None:
        raise ValueError("nothing to compare")
    return out


def champion(results: DataFrame, part: str = "validation") -> DataFrame:
    """Best model by average precision on one part; the name breaks ties."""
    return results.where(F.col("split") == part).orderBy(F.desc("pr_auc"), "model").limit(1)


# The boosting grid.
BOOSTING_GRID = {"depth": (3, 5), "rate": (0.03, 0.08), "trees": (200, 400)}


def grid_search(
    train: DataFrame,
    validation: DataFrame,
    grid: Mapping[str, Sequence] = BOOSTING_GRID,
    features: Sequence[str] = FEATURES,
    scheme: str = "scaled",
    parallelism: int = 4,
) -> tuple[DataFrame, PipelineModel]:
    """Try every grid point on the earlier period and rank it on the later one.

    The library's own validators split at random, which would mix periods. Points that differ only in
    their number of trees are prefixes of one ensemble: it is fitted once, with the most trees, and one pass
    over the validation rows scores all of them. The ensembles grow side by side.
    Returns the results table and the model of its best row.
    """
    spark: SparkSession = train.sparkSession
    shared = prepared(train, features)
    points = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    nests: dict[tuple, list[int]] = {}
    for i, point in enumerate(points):
        nests.setdefault(tuple(v for k, v in point.items() if k != "trees"), []).append(i)

    widest = [boosting(**{**points[nest[0]], "trees": max(points[i]["trees"] for i in nest)}) for nest in nests.values()]
    models = fit_side_by_side(train, widest, scheme, shared)

    def run(nest: list[int], model: PipelineModel) -> tuple[PipelineModel, list[tuple]]:
        sizes = [points[i]["trees"] for i in nest]
        scored = staged(prefix_scores(validation, model, sizes, [TARGET], "prefixes"), "prefix-scores")
        rows = []
        for k, i in enumerate(nest):
            cells = stored_cells(scored.select(TARGET, F.col("prefixes")[k].alias(PROBABILITY)), TARGET, PROBABILITY)
            metric = ranking_of_cells(cells).first()  # one row
            rows.append((i, *[float(v) for v in points[i].values()], metric["pr_auc"], metric["roc_auc"], metric["positives"] + metric["negatives"]))
        return model, rows

    with ThreadPoolExecutor(parallelism) as pool:
        done = list(pool.map(run, nests.values(), models))
    rows = sorted(row for _, found in done for row in found)
    schema = "point int, " + ", ".join(f"{k} double" for k in grid) + ", pr_auc double, roc_auc double, scored_rows long"
    results = spark.createDataFrame(rows, schema)
    best = max(rows, key=lambda r: (r[-3], -r[0]))[0]
    whole = next(model for (model, _), nest in zip(done, nests.values()) if best in nest)
    first = prefix_model(whole.stages[-1], points[best]["trees"], spark)
    return results.orderBy(F.desc("pr_auc"), "point"), PipelineModel(stages=[*whole.stages[:-1], first])
