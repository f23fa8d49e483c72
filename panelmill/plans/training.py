"""Train candidates, choose a champion and a threshold, test once, store the results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.operators import metrics as M
from panelmill.operators.dataset import assert_no_leakage
from panelmill.operators.explain import linear_attribution, mean_absolute, model_importance, tree_attribution
from panelmill.operators.models import candidates, champion, compare, evaluate_cells
from panelmill.operators.scoring import PROBABILITY, decide, top_risk, with_probability
from panelmill.schema import CUSTOMER, FEATURES, SNAPSHOT, SPLIT, TARGET
from panelmill.sources.tables import read_csv, staged, write_csv, write_json_record, write_parquet


@dataclass
class TrainingRun:
    models: dict[str, PipelineModel]
    results: DataFrame
    champion: str
    thresholds: DataFrame
    threshold: float
    test_metrics: DataFrame
    test_confusion: DataFrame
    test_report: DataFrame
    test_baselines: DataFrame
    test_predictions: DataFrame
    split_rows: DataFrame
    parts: dict[str, DataFrame]


def train(
    dataset: DataFrame,
    features: Sequence[str] = FEATURES,
    sweep: tuple[float, float, int] = M.FINE_SWEEP,
    sizes: Mapping[str, int] | None = None,
) -> TrainingRun:
    """The whole workflow on a dataset with a split column.

    The champion has the highest average precision on the validation period, its
    threshold the highest F1 there; the test period is looked at once, after both.
    Each part is scored once per model that looks at it, and what is asked of the scores
    starts from their stored cells. Only metric rows reach the driver. ``dataset`` should be a
    stored table, as ``build_model_dataset`` returns it. The frames of the run read tables in the
    scratch folder: ``store`` the run inside the same ``scratch_folder`` block.
    """
    assert_no_leakage(dataset, features)
    rows = dataset.select(CUSTOMER, SNAPSHOT, *features, TARGET, SPLIT)
    part = {s: rows.where(F.col(SPLIT) == s).drop(SPLIT) for s in ("train", "validation", "test")}

    models = candidates(part["train"], features, sizes)
    cells = {n: M.stored_cells(with_probability(part["validation"], m), TARGET, PROBABILITY) for n, m in models.items()}
    results = staged(compare(cells), "results")
    name = champion(results).first()["model"]
    model = models[name]

    thresholds = staged(M.sweep_of_cells(cells[name], sweep), "thresholds")
    threshold = M.best_threshold(thresholds).first()["threshold"]

    predictions = staged(
        with_probability(part["test"], model)
        .select(CUSTOMER, SNAPSHOT, TARGET, PROBABILITY)
        .withColumn("churn_prediction", (F.col(PROBABILITY) >= F.lit(threshold)).cast("int")),
        "test-predictions",
    )
    test_cells = M.stored_cells(predictions, TARGET, PROBABILITY)
    counts = M.confusion_of_cells(test_cells, threshold)
    return TrainingRun(
        models=models,
        results=results,
        champion=name,
        thresholds=thresholds,
        threshold=threshold,
        test_metrics=evaluate_cells(test_cells, name, "test", threshold),
        test_confusion=M.confusion_matrix(counts),
        test_report=M.classification_report(counts),
        test_baselines=M.baselines(part["test"], TARGET),
        test_predictions=predictions,
        split_rows=dataset.groupBy(SPLIT).agg(
            F.count("*").alias("rows"), F.min(SNAPSHOT).cast("string").alias("first"), F.max(SNAPSHOT).cast("string").alias("last")
        ),
        parts=part,
    )


def attributions(model: PipelineModel, rows: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame | None:
    """Attributions of a model to its features, row by row; none for a network."""
    last, keep = model.stages[-1], (CUSTOMER, SNAPSHOT)
    if hasattr(last, "featureImportances"):
        return tree_attribution(rows, model, keep, features)
    return linear_attribution(rows, model, keep, features) if hasattr(last, "coefficients") else None


def explain(run: TrainingRun, path: str, features: Sequence[str] = FEATURES, rows: DataFrame | None = None) -> None:
    """What the champion's scores rest on, as CSV: importances, attributions and their means, highest risks.

    ``rows`` are those to explain, the whole test period unless given. The hundred highest
    probabilities come from all scored test rows, with the actual label.
    """
    spark, model = run.results.sparkSession, run.models[run.champion]
    last = model.stages[-1]
    if hasattr(last, "featureImportances") or hasattr(last, "coefficients"):
        write_csv(model_importance(spark, model, features), f"{path}/importance")
    values = attributions(model, run.parts["test"] if rows is None else rows, features)
    if values is not None:
        values = staged(values, "attributions")
        write_csv(values, f"{path}/attribution_values")
        write_csv(mean_absolute(values, features), f"{path}/attribution_importance")
    exact = run.test_predictions.select(CUSTOMER, SNAPSHOT, TARGET, PROBABILITY)
    write_csv(decide(top_risk(exact, 100, ties=[SNAPSHOT, CUSTOMER]), run.threshold), f"{path}/high_risk")


def store(run: TrainingRun, path: str, features: Sequence[str] = FEATURES, grid: DataFrame | None = None) -> None:
    """Model, tables as CSV, scored test rows as parquet, run record as JSON; the table of a grid search, if any."""
    spark = run.results.sparkSession
    run.models[run.champion].write().overwrite().save(f"{path}/champion_model")
    write_csv(run.results, f"{path}/model_results")
    write_csv(run.thresholds, f"{path}/threshold_results")
    write_csv(run.test_report, f"{path}/test_report")
    write_csv(run.test_baselines, f"{path}/test_baselines")
    write_csv(run.test_confusion, f"{path}/test_confusion")
    if grid is not None:
        write_csv(grid, f"{path}/grid_results")
    write_parquet(run.test_predictions, f"{path}/test_predictions")
    test = run.test_metrics.first().asDict()
    sizes = {r[SPLIT]: r for r in run.split_rows.collect()}  # three rows
    validation = [r.asDict() for r in run.results.collect()]  # a row per candidate
    cells = {(r["actual"], r["predicted"]): r["rows"] for r in run.test_confusion.collect()}  # four rows
    write_json_record(spark, f"{path}/feature_names", {"features": list(features)})
    write_json_record(
        spark,
        f"{path}/run_record",
        {
            "champion_model": run.champion,
            "target": TARGET,
            "selection_metric": "validation_pr_auc",
            "threshold_selection_metric": "validation_f1",
            "threshold": run.threshold,
            "feature_count": len(features),
            "features": list(features),
            **{f"{s}_rows": sizes[s]["rows"] if s in sizes else 0 for s in ("train", "validation", "test")},
            **{f"{s}_{end}": sizes[s][end] if s in sizes else None for s in ("train", "validation", "test") for end in ("first", "last")},
            "validation_results": validation,
            "test_confusion_matrix": [[cells[a, p] for p in (0, 1)] for a in (0, 1)],
            **{f"test_{m}": test[m] for m in ("pr_auc", "roc_auc", "precision", "recall", "f1")},
        },
    )


def stored_rows(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """name and rows of tables of a stored run, counted from the files; a table that is not there is an error."""
    out: DataFrame | None = None
    for name in names:
        one = read_csv(spark, f"{path}/{name}", infer=True).agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no tables asked for")
    return out


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/champion_model")
