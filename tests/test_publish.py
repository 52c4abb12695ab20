"""Publication by one pointer: versions, rejected checks, interrupted promotions."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler

from campaignlens.operators import model
from campaignlens.sources import sinks


@pytest.fixture
def fitted(spark):
    rows = spark.createDataFrame([(float(i), float(i > 5)) for i in range(12)], "x double, label double")
    return Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LogisticRegression(maxIter=3)]).fit(rows)


def test_latest_pointer_wins(spark, tmp_path):
    root = f"{tmp_path}/r"
    assert sinks.published(spark, root) is None
    assert sinks.publish(spark, root, "a", {"roc_auc": 0.8}) == 1
    assert sinks.publish(spark, root, "b", {"roc_auc": 0.9}) == 2
    assert sinks.published(spark, root) == {"number": 2, "path": "b", "roc_auc": 0.9}
    assert [p["path"] for p in sinks.pointers(spark, root)] == ["a", "b"]


def test_promotion_that_stops_before_the_pointer_keeps_the_old_champion(spark, tmp_path, fitted, monkeypatch):
    path = f"{tmp_path}/champion"
    assert model.promote(fitted, 0.8, path)
    old = sinks.published(spark, path)
    monkeypatch.setattr(model, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        model.promote(fitted, 0.9, path)
    assert sinks.published(spark, path) == old and model.champion_auc(spark, path) == 0.8
    model.load_champion(path)
    monkeypatch.undo()
    assert model.promote(fitted, 0.9, path)
    assert model.champion_auc(spark, path) == 0.9 and sinks.published(spark, path)["path"] != old["path"]


def test_promotion_that_stops_while_the_model_is_written(spark, tmp_path, fitted):
    path = f"{tmp_path}/champion"
    assert model.promote(fitted, 0.8, path)

    class Broken:
        def write(self):
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        model.promote(Broken(), 0.95, path)
    assert model.champion_auc(spark, path) == 0.8
    model.load_champion(path)


def test_reruns_of_one_challenger_agree(spark, tmp_path, fitted):
    path = f"{tmp_path}/champion"
    for _ in range(2):
        assert model.champion_auc(spark, path, but="t") is None
        assert model.promote(fitted, 0.8, path, tag="t")
    assert len(sinks.pointers(spark, path)) == 1
    assert not model.promote(fitted, 0.75, path, tag="other")
    assert not model.promote(fitted, 0.5, f"{tmp_path}/none") and not model.promote(fitted, None, path)


def test_champion_must_exist(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        model.load_champion(f"{tmp_path}/nothing")


def test_rejected_version_leaves_the_view(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS checked LOCATION '{tmp_path}/checked'")
    one, none = spark.range(3).toDF("x"), spark.range(0).toDF("x")
    sinks.write_versioned(one, "t", 1, 1, "checked", check=lambda v: v.count() > 0)
    with pytest.raises(ValueError):
        sinks.write_versioned(none, "t", 2, 2, "checked", check=lambda v: v.count() > 0)
    assert spark.table("checked.t").count() == 3
    sinks.write_versioned(spark.range(5).toDF("x"), "t", 3, 3, "checked", check=lambda v: v.count() > 0)
    assert spark.table("checked.t").count() == 5


def test_partition_column_default_and_override(spark, tmp_path):
    assert sinks.partition_column(spark, "usage") == "day_dt"
    spark.conf.set("campaignlens.partition.usage", "month_dt")
    try:
        assert sinks.partition_column(spark, "usage") == "month_dt" and sinks.partition_column(spark, "other") == "day_dt"
        rows = spark.sql("SELECT DATE'2024-01-01' AS month_dt, 1 AS v UNION ALL SELECT DATE'2024-02-01', 2")
        path = f"{tmp_path}/b"
        assert sinks.backfill_date_range(rows, path, min_date="2024-01-01", max_date="2024-02-01", table="usage") == 1
        assert spark.read.parquet(path).count() == 1
    finally:
        spark.conf.unset("campaignlens.partition.usage")


def test_forest_scores_rows_after_a_metric_was_observed(spark):
    rows = spark.createDataFrame([(i, 1 + i % 4, float(i % 2), float(i % 7)) for i in range(80)],
                                 "rating_account_id long, fold int, label double, x double")
    observed, seen = sinks.observe_rows(rows, "n")
    observed.write.format("noop").mode("overwrite").save()
    assert seen.get["rows_affected"] == 80
    fitted = model.fit(rows, ["x"], model.forest(num_trees=3, min_leaf=2, max_depth=3))
    assert model.scores(fitted, rows).count() == 80
