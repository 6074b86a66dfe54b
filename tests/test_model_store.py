"""Stored fits are shared, and the newest whole model is the one that is loaded."""

import os

import pytest
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import functions as F

from chainstrata.operators import models
from chainstrata.session import shared_dir
from chainstrata.sources import model_store


def _rows(spark, high: bool):
    """The label follows x from above 1,000 on, or below it."""
    x = F.col("id").cast("double")
    return spark.range(2000).select(x.alias("x"), F.sin(x).alias("y"), ((x >= 1000) == F.lit(high)).cast("int").alias("target"))


def test_fingerprint_follows_content_not_order(spark):
    rows = [(1, 0.1 + 0.2, None), (2, 0.3, "b"), (2, 0.3, "b"), (None, None, None)]
    make = lambda r: spark.createDataFrame(r, "i bigint, x double, s string")
    one = model_store.fingerprint(make(rows))
    assert one == model_store.fingerprint(make(rows[::-1]).repartition(3))
    assert one == model_store.fingerprint(make([(1, 0.3, None), *rows[1:]]))  # last digits
    for other in (rows[:-1], [*rows, rows[1]], [(1, 0.30001, None), *rows[1:]], [(1, 0.3, ""), *rows[1:]], []):
        assert model_store.fingerprint(make(other)) != one
    swapped = spark.createDataFrame([(None, 5)], "a bigint, b bigint"), spark.createDataFrame([(5, None)], "a bigint, b bigint")
    assert model_store.fingerprint(swapped[0]) != model_store.fingerprint(swapped[1])


def test_a_fit_is_done_once_per_key(spark):
    calls = []

    def build():
        calls.append(1)
        return {"a": spark.range(len(calls)), "b": spark.range(5)}

    for key, times, n in (("k1", 1, 1), ("k1", 1, 1), ("k2", 2, 2), ("k1", 2, 1)):
        tables = model_store.stored_once(spark, "fit", key, build)
        assert set(tables) == {"a", "b"} and len(calls) == times
        assert (tables["a"].count(), tables["b"].count()) == (n, 5)


def test_a_build_that_fails_leaves_nothing(spark):
    def broken():
        return {"a": spark.range(3), "b": spark.range(3).select(F.raise_error(F.lit("stop")).alias("x"))}

    with pytest.raises(Exception, match="stop"):
        model_store.stored_once(spark, "fit", "broken", broken)
    assert set(model_store.stored_once(spark, "fit", "broken", lambda: {"a": spark.range(3)})) == {"a"}


def test_two_builds_at_once_give_one_result(spark):
    def slow():
        model_store.stored_once(spark, "fit", "race", lambda: {"a": spark.range(2)})
        return {"a": spark.range(9)}

    assert model_store.stored_once(spark, "fit", "race", slow)["a"].count() == 2


def test_newest_whole_model_scores_alike(spark):
    folder = f"{shared_dir(spark)}/models"
    with pytest.raises(FileNotFoundError):
        model_store.newest_model(spark, folder, GBTClassificationModel)
    old, new = (models.fit_classifier(_rows(spark, high), trees=2, features=("x", "y")) for high in (False, True))
    model_store.save_model(old, folder, "2024-01-01")
    model_store.save_model(new, folder, "2024-02-01")
    model_store.save_model(new, folder, "2024-03-01")
    os.remove(f"{folder}/version=2024-03-01/treesMetadata/_SUCCESS")  # a save that was cut off
    assert model_store.versions(spark, folder) == ["2024-01-01", "2024-02-01"]
    loaded = model_store.newest_model(spark, folder, GBTClassificationModel)
    of = lambda m: [r.probability for r in models.score(m, _rows(spark, True), ("x", "y")).orderBy("x").collect()]
    assert of(loaded) == pytest.approx(of(new)) and of(loaded) != pytest.approx(of(old))
