"""Files to tables to a trained and stored model, on the small test tables."""

from __future__ import annotations

from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelmill.catalog.queries import QUERIES
from panelmill.operators import ensembles
from panelmill.operators import models as L
from panelmill.operators.metrics import FINE_SWEEP
from panelmill.operators.scoring import with_probability
from panelmill.plans import medallion, training
from panelmill.schema import FEATURES, TARGET
from panelmill.session import SHUFFLE_CLEANUP, scratch_folder, scratch_path
from panelmill.sources import tables as X
from panelmill.sources.testviews import raw_tables, typed_tables
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def silver(spark):
    """Typed tables stored as silver."""
    root = scratch_path(spark, "silver")
    for name, df in typed_tables(spark, SF_SMALL).items():
        X.write_parquet(df, f"{root}/{name}")
    return root


@pytest.fixture(scope="module")
def dataset(spark, silver):
    gold_path, path = scratch_path(spark, "gold"), scratch_path(spark, "dataset")
    table = medallion.build_gold(spark, silver, gold_path)
    assert "observation_year" in table.columns
    return medallion.build_model_dataset(spark, gold_path, path)


def test_raw_file_to_silver(spark):
    root = scratch_path(spark, "raw")
    raw_tables(spark, SF_SMALL)["customers"].write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(f"{root}/customers.csv")
    profile = medallion.validate_raw(spark, root, "customers").collect()
    assert {r["columns"] for r in profile} == {5}
    row = medallion.ingest(spark, root, f"{root}/bronze", ["customers"]).first()
    assert row["rows"] == row["verified_rows"] and row["columns"] == row["verified_columns"] == 5
    row = medallion.refine(spark, f"{root}/bronze", f"{root}/silver", ["customers"]).first()
    assert row["rows"] == row["verified_rows"] > 0


def test_malformed_lines_are_kept_on_request(spark):
    path = scratch_path(spark, "bad")
    spark.createDataFrame([("a,b",), ("1,2",), ("1,x",), ("1",)], "value string").coalesce(1).write.text(path)
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    df = X.read_csv(spark, path, schema, keep_malformed=True).cache()
    assert {r[X.CORRUPT] for r in df.collect()} == {None, "1,x", "1"}
    with pytest.raises(ValueError, match="schema"):
        X.read_csv(spark, path, keep_malformed=True)
    assert X.read_csv(spark, path, infer=True).count() == 3


def test_partitions_are_pruned_and_rewritten_one_by_one_on_request(spark):
    path = scratch_path(spark, "parts")
    df = spark.range(100).select("id", (F.col("id") % 4).alias("p"))
    X.write_parquet(df, path, ["p"])
    part = X.read_part(spark, path, p=2)
    plan = part._jdf.queryExecution().toString()
    assert part.count() == 25 and "PartitionFilters: [isnotnull(p" in plan
    X.write_parquet(df.where("p = 1").limit(3), path, ["p"], refresh="partitions")
    assert spark.read.parquet(path).count() == 78  # only p=1 was replaced


def test_a_rebuild_leaves_nothing_of_the_table_before(spark):
    path = scratch_path(spark, "rebuilt")
    df = spark.range(100).select("id", (F.col("id") % 4).alias("p"))
    X.write_parquet(df, path, ["p"])
    X.write_parquet(df.where("p < 2"), path, ["p"])
    assert sorted(r["p"] for r in spark.read.parquet(path).select("p").distinct().collect()) == [0, 1]
    with pytest.raises(ValueError, match="refresh"):
        X.write_parquet(df, path, ["p"], refresh="some")


def test_scratch_folders_end_with_their_block(spark):
    with scratch_folder(spark) as folder:
        path = X.write_parquet(spark.range(3), scratch_path(spark, "x"))
        assert path.startswith(folder) and spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path).count()
    assert not scratch_path(spark, "y").startswith(folder)


def test_generations_write_their_partitions(spark, silver):
    path = scratch_path(spark, "gold2")
    table = medallion.build_gold(spark, silver, path, "v2")
    assert table.columns[-2:] == ["observation_year", "observation_month"]
    out = medallion.build_model_dataset(spark, path, scratch_path(spark, "dataset2"), "v2")
    assert out.columns[-1] == "dataset_split"
    assert not {"future_orders_90d", "last_purchase_timestamp"} & set(out.columns)


def test_training_run_is_stored_and_reloads(spark, dataset):
    sizes = {"logistic": 50, "forest": 5, "boosting": 3, "perceptron": 5}
    run = training.train(dataset, sweep=FINE_SWEEP, sizes=sizes)
    results = {r["model"]: r for r in run.results.collect()}
    assert len(results) == 5
    assert run.champion == max(results.values(), key=lambda r: r["pr_auc"])["model"]
    assert 0.01 <= run.threshold <= 0.99
    path = scratch_path(spark, "run")
    grid, _ = L.grid_search(run.parts["train"], run.parts["validation"], {"depth": (2,), "rate": (0.1,), "trees": (1, 2)})
    training.store(run, path, grid=grid)
    training.explain(run, path)
    tables = ["grid_results", "threshold_results", "test_confusion", "importance", "attribution_values", "attribution_importance"]
    linear_or_tree = not run.champion.startswith("neural")
    found = {r["name"]: r["rows"] for r in training.stored_rows(spark, path, tables if linear_or_tree else tables[:3]).collect()}
    assert found["grid_results"] == 2 and found["threshold_results"] == 99 and found["test_confusion"] == 4
    if linear_or_tree:
        assert found["importance"] == found["attribution_importance"] == len(FEATURES)
        assert found["attribution_values"] == run.parts["test"].count()
    stored = X.read_csv(spark, f"{path}/grid_results", infer=True).orderBy("point").collect()
    assert [r["pr_auc"] for r in stored] == [pytest.approx(r["pr_auc"]) for r in sorted(grid.collect(), key=lambda r: r["point"])]
    record = spark.read.json(f"{path}/run_record").first()
    assert record["champion_model"] == run.champion and list(record["features"]) == list(FEATURES)
    cells = sum(r["rows"] for r in run.test_confusion.collect())
    assert cells == record["test_rows"] == sum(sum(row) for row in record["test_confusion_matrix"])
    assert record["train_last"] < record["validation_first"] and len(record["validation_results"]) == 5
    risky = X.read_csv(spark, f"{path}/high_risk", infer=True)
    assert {TARGET, "churn_probability", "churn_prediction"} <= set(risky.columns) and risky.count() == min(100, cells)
    again = training.load_model(path)
    test = dataset.where("dataset_split = 'test'")
    scored = L.evaluate(again, test, run.champion, "test", run.threshold).first()
    assert scored["pr_auc"] == pytest.approx(record["test_pr_auc"])
    assert X.read_csv(spark, f"{path}/threshold_results", infer=True).count() == 99


def test_grid_search_ranks_every_point(dataset):
    grid = {"depth": (2, 3), "rate": (0.1,), "trees": (2,)}
    train, validation = (dataset.where(F.col("dataset_split") == s) for s in ("train", "validation"))
    table, model = L.grid_search(train, validation, grid)
    rows = table.collect()
    assert len(rows) == 2 and rows[0]["pr_auc"] >= rows[1]["pr_auc"]
    best = L.evaluate(model, validation, "best", "validation").first()
    assert best["pr_auc"] == pytest.approx(rows[0]["pr_auc"])


def test_prefix_and_separate_fit_are_equal(spark, dataset):
    """A fit of six trees holds the fit of three: trees, margins, probabilities and metrics."""
    train, validation = (dataset.where(F.col("dataset_split") == s) for s in ("train", "validation"))
    shared = L.prepared(train)
    long, short = (L.fit(train, L.boosting(n, rate=0.1), scheme="scaled", shared=shared) for n in (6, 3))
    cut = ensembles.prefix_model(long.stages[-1], 3, spark)
    nodes = [[t.toDebugString.partition("\n")[2] for t in m.trees] for m in (cut, short.stages[-1])]  # below the line with the uid
    assert nodes[0] == nodes[1]
    keys = ["customer_unique_id", "observation_date"]
    scored = ensembles.prefix_scores(validation, long, [3, 6], keys, "p").collect()
    for k, model in enumerate((short, long)):
        said = {tuple(r[c] for c in keys): r["churn_probability"] for r in with_probability(validation, model).collect()}
        assert {tuple(r[c] for c in keys): r["p"][k] for r in scored} == {x: pytest.approx(v, rel=1e-12) for x, v in said.items()}
    vectors = shared[0].transform(validation)
    probabilities = [[tuple(r[0]) for r in m.transform(vectors).select("probability").collect()] for m in (cut, short.stages[-1])]
    assert probabilities[0] == probabilities[1]
    path = scratch_path(spark, "cut")
    cut.write().save(path)
    assert type(cut).load(path).getNumTrees == 3


def test_grid_points_of_one_ensemble(dataset):
    grid = {"depth": (2,), "rate": (0.1, 0.3), "trees": (1, 4)}
    train, validation = (dataset.where(F.col("dataset_split") == s) for s in ("train", "validation"))
    table, model = L.grid_search(train, validation, grid)
    rows = {(r["rate"], r["trees"]): r for r in table.collect()}
    assert len(rows) == 4 and {r["scored_rows"] for r in rows.values()} == {validation.count()}
    alone = L.fit(train, L.boosting(1, 2, 0.3), scheme="scaled")
    assert L.evaluate(alone, validation, "m", "validation").first()["pr_auc"] == pytest.approx(rows[0.3, 1.0]["pr_auc"])
    best = max(rows.values(), key=lambda r: (r["pr_auc"], -r["point"]))
    assert model.stages[-1].getNumTrees == best["trees"]


def test_scoring_batch_needs_its_columns(spark):
    path = X.write_csv(spark.createDataFrame([(1, 2)], ["order_count_180d", TARGET]), scratch_path(spark, "b"))
    with pytest.raises(ValueError, match="recency_days"):
        X.read_scoring_batch(spark, path)
    assert X.inline_rows(spark, [(1, "a")], ["n", "s"]).columns == ["n", "s"]


@pytest.mark.parametrize("name", ["scored_csv_roundtrip", "csv_bronze_silver"])
def test_stages_between_files_are_compressed_and_go(spark, name, monkeypatch):
    """Batches, raw files and bronze tables stayed until the application ended, as plain text."""
    made, csv = [], DataFrameWriter.csv
    monkeypatch.setattr(DataFrameWriter, "csv", lambda self, path, *a, **k: (csv(self, path, *a, **k), made.extend(Path(urlparse(path).path).glob("part-*"))))
    before = spark.conf.get(SHUFFLE_CLEANUP)
    folder = Path(urlparse(scratch_path(spark, "x")).path).parent
    held = set(folder.iterdir()) if folder.exists() else set()
    rows = QUERIES[name](spark, SF_SMALL).count()
    assert rows and made and all(p.name.endswith(".csv.gz") for p in made)
    left = {p.name.rsplit("-", 1)[0] for p in folder.iterdir() if p not in held}
    assert left == ({"scored"} if name == "scored_csv_roundtrip" else {"silver", "verified"})
    assert spark.conf.get(SHUFFLE_CLEANUP) == before
