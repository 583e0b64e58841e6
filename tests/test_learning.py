"""Preparation, reports and a small training run."""

import itertools
import random
import statistics

import pytest
from pyspark.sql import functions as F

from vitalframe.operators import learning as ml


def test_policies_ignore_case(spark):
    df = spark.createDataFrame(
        [("p", 1, 2.0, "x", "y", "t")],
        "PATIENT_ID string, AGE int, BMI double, HYPERGLYCEMIA_URGENCY string, GENDER string, target string",
    )
    assert ml.feature_columns(df, "target", "exclude") == ["AGE", "BMI", "HYPERGLYCEMIA_URGENCY", "GENDER"]
    assert ml.feature_columns(df, "target", "no_leak") == ["AGE", "BMI", "GENDER"]
    assert ml.feature_columns(df, "target", "raw") == ["AGE", "GENDER", "BMI"]
    with pytest.raises(ValueError):
        ml.feature_columns(df, "target", "none")


def test_medians(spark):
    """All columns at once: mixed values, all different ones, one heavy value, an even split, nothing at all."""
    rng = random.Random(4)
    for n in (1, 2, 3, 501, 2000, 40_000):
        columns = {
            "mixed": [rng.gauss(0, 1) if rng.random() < 0.7 else 0.25 for _ in range(n)],
            "distinct": rng.sample(range(10 * n), n),
            "heavy": [5 if rng.random() < 0.95 else rng.randrange(10) for _ in range(n)],
            "split": [-1e9 if i < n / 2 else 1e9 for i in range(n)],
        }
        rows = [tuple(float(v[i]) for v in columns.values()) for i in range(n)] + [(None,) * 4]
        df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).withColumn("none", F.lit(None).cast("double"))
        got = {r["column"]: r["median"] for r in ml.medians(df.repartition(5), [*columns, "none"]).collect()}
        assert got == {c: pytest.approx(statistics.median(v), abs=1e-12) for c, v in columns.items()}


def test_prepared_keeps_rows_with_missing_values(spark):
    rows = [(1.0, "a", True, "x"), (None, "a", None, "y"), (3.0, None, False, "x"), (5.0, "b", True, "y")]
    df = spark.createDataFrame(rows, "n double, t string, b boolean, target string")
    ready, stages = ml.prepared(df, ["n", "t", "b"], "target")
    assert stages.fit(ready).transform(ready).select("features").count() == 4


def test_impute(spark):
    df = spark.createDataFrame(
        [(1.0, "b", None), (None, "a", None), (5.0, None, None), (2.0, "b", None), (None, "a", None)], "x double, t string, z string"
    )
    out = ml.impute(df, ["x"], ["t", "z"]).collect()
    assert [r.x for r in out] == [1.0, 2.0, 5.0, 2.0, 2.0]
    assert [r.t for r in out] == ["b", "a", "a", "b", "a"]  # a tie goes to the smaller value
    assert {r.z for r in out} == {"unknown"}


def test_standardize_uses_training_rows_only(spark):
    train = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    test = spark.createDataFrame([(5.0, 7.0)], "a double, b double")
    assert tuple(ml.standardize(test, ["a", "b"], train).first()) == (3.0, 0.0)


def test_evaluate_counts_missing_classes(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "c")], "y string, p string")
    out = {r["class"]: (r.support, r.precision, r.recall, r.f1) for r in ml.evaluate(df, "y", "p").collect()}
    assert out == {"a": (2, 1.0, 0.5, 0.6667), "b": (1, 0.0, 0.0, 0.0), "c": (0, 0.0, 0.0, 0.0)}


def test_gap_report(spark):
    rows = [("m1", 0.99, 0.98, 0.97), ("m2", 0.9, 0.84, 0.83), ("m3", 0.9, 0.7, 0.5)]
    out = ml.gap_report(spark.createDataFrame(rows, "model string, train_acc double, val_acc double, test_acc double")).collect()
    assert [(r.overfitting, r.representative, r.suspected_leak) for r in out] == [
        ("acceptable", True, True), ("moderate_gap", True, False), ("large_gap", False, False)
    ]


@pytest.mark.parametrize("family", [ml.train_rf, ml.train_gbt, ml.train_svm])
def test_training_and_reload(spark, tmp_path, family):
    df = spark.range(300).select(
        (F.col("id") % 30).cast("double").alias("a"),
        F.when(F.col("id") % 2 == 0, "u").otherwise("v").alias("g"),
        (F.col("id") % 5 == 0).alias("flag"),
        F.when(F.col("id") % 30 < 10, "low").when(F.col("id") % 30 < 20, "mid").otherwise("high").alias("y"),
    )
    ready, stages = ml.prepared(df, ["a", "g", "flag"], "y")
    fitted = stages.fit(ready)
    shaped = fitted.transform(ready)
    grids = {ml.train_rf: {"numTrees": [5], "maxDepth": [4]}, ml.train_gbt: {"maxIter": [3], "maxDepth": [2]}, ml.train_svm: {"regParam": [0.01], "maxIter": [5]}}
    model = family(ml.with_weights(shaped), grids[family], folds=2)
    assert ml.accuracy_of(model.bestModel, {"train": shaped})["train"] > 0.5
    ml.save_model(fitted, str(tmp_path / "m"))
    assert ml.load_model(str(tmp_path / "m")).transform(ready).select("label").count() == 300
    if family is ml.train_rf:
        report = ml.importance_report(spark, model.bestModel, ["a", "flag", "g_code"]).collect()
        assert report[0].feature == "a" and report[0].note == "dominates"


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_dictionary_with_as_many_values_as_rows(spark, monkeypatch, broadcast_rows):
    """Unique ids, one value in a third of all rows, NULLs and shared beginnings, with and without a broadcast."""
    monkeypatch.setattr(ml, "DICTIONARY_ROWS", broadcast_rows)
    monkeypatch.setattr(ml, "HOT_VALUES", 16)
    rows = [(f"https://host/{(i * 7919) % 3000:05d}", "hot" if i % 3 == 0 else None if i % 10 == 1 else f"v{i % 50}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a string, b string, i int").repartition(5)
    got = {r.i: (r.a, r.b) for r in ml.encode(df, ["a", "b"]).collect()}
    places = [{v: n for n, v in enumerate(sorted({r[c] for r in rows} - {None}))} for c in (0, 1)]
    assert got == {i: (places[0][a], places[1].get(b, len(places[1]))) for a, b, i in rows}
    assert ml.encode(df, ["a", "b"]).columns == ["a", "b", "i"]
    assert [tuple(r) for r in ml.encode(spark.createDataFrame([(None, 1)], "a string, i int"), ["a"]).collect()] == [(0, 1)]
    assert ml.encode(df.limit(0), ["a"]).count() == 0 and ml.encode(df, []) is df


def test_fitting_rows_keep_shares_and_folds(spark):
    df = spark.range(6000).select("id", F.when(F.col("id") % 10 == 0, 1.0).otherwise(0.0).alias("label"))
    some = {r.id: (r.label, r.fold) for r in ml.fitting_rows(df, "label", "id", 1000).collect()}
    again = {r.id: (r.label, r.fold) for r in ml.fitting_rows(df.repartition(7), "label", "id", 1000).collect()}
    assert some == again and sum(v[0] for v in some.values()) == 100 and len(some) == 1000
    assert {f for _, f in some.values()} == set(range(5))
    assert ml.fitting_rows(df, "label", "id", 6000).count() == 6000


def test_folds_of_the_table_are_used(spark):
    rows = [(float(i % 2), i % 4 // 2, [float(i % 2), 1.0]) for i in range(80)]
    from pyspark.ml.functions import array_to_vector

    df = spark.createDataFrame(rows, "label double, fold int, f array<double>").withColumn("features", array_to_vector("f"))
    model = ml.train_rf(ml.with_weights(df), {"numTrees": [3], "maxDepth": [2]}, folds=2)
    assert model.getFoldCol() == "fold" and model.avgMetrics == [1.0]


def test_published_grids():
    def points(grid):
        return __import__("math").prod(len(v) for v in grid.values())

    assert (points(ml.RF_GRID), points(ml.GBT_GRID), ml.FOLDS) == (8, 16, 5)
    assert ml.margin_grid(1000) == {"regParam": [0.01, 0.001, 0.0001]}


def test_weights_leave_the_rows_where_they_lie(spark):
    """A shuffle by class would put all rows of a class into one task."""
    df = spark.range(0, 900, 1, 6).select((F.col("id") % 3).cast("double").alias("label"), "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        weighed = ml.with_weights(df)
        assert weighed.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() == [150] * 6
        assert {r.class_weight for r in weighed.collect()} == {1.0}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _labelled(spark, n=600):
    """Three classes over numbers, flags and texts; a weight per class."""
    df = spark.range(n).select(
        ((F.col("id") * 7) % 29).cast("double").alias("a"),
        ((F.col("id") * 13) % 11).cast("int").alias("b"),
        F.element_at(F.array(*[F.lit(t) for t in "uvwxy"]), ((F.col("id") * 5 % 17) % 5 + 1).cast("int")).alias("g"),
        (F.col("id") % 5 == 0).alias("flag"),
        F.when((F.col("id") * 7 % 29 + F.col("id") * 5 % 17 + F.xxhash64("id") % 5) < 15, "low")
        .when((F.col("id") * 7 % 29 + F.col("id") * 13 % 11) < 25, "mid").otherwise("high").alias("y"),
    )
    ready, stages = ml.prepared(df, ["a", "b", "flag", "g"], "y")
    return ml.with_weights(stages.fit(ready).transform(ready)).cache()


def test_boosted_trees_are_those_of_spark(spark):
    """With all rows in every round, the trees on counted cells predict what the library's trees predict row by row.

    Deeper trees have nodes in which splits tie but for rounding.
    """
    depth = 2
    from pyspark.ml.classification import GBTClassifier, OneVsRest
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rows = _labelled(spark)
    plain = MulticlassClassificationEvaluator(metricName="accuracy")
    ours = ml.train_gbt(rows, {"maxIter": [4], "maxDepth": [depth], "minInstancesPerNode": [3]}, folds=2).bestModel
    theirs = OneVsRest(classifier=GBTClassifier(maxIter=4, maxDepth=depth, minInstancesPerNode=3, seed=42), weightCol="class_weight").fit(rows)
    for mine, other in zip(ours.models, theirs.models):
        a = [r.rawPrediction[1] for r in mine.transform(rows).select("rawPrediction").collect()]
        b = [r.rawPrediction[1] for r in other.transform(rows).select("rawPrediction").collect()]
        assert a == pytest.approx(b, abs=1e-9)
        assert mine.featureImportances.toArray() == pytest.approx(other.featureImportances.toArray(), abs=1e-9)
    assert ml.accuracy_of(ours, {"all": rows})["all"] == pytest.approx(plain.evaluate(ours.transform(rows)))


def test_boosted_search_tries_every_point_in_every_fold(spark, monkeypatch):
    """A point with fewer rounds scores as if it had been fitted alone; sampling and joint histograms change no row count."""
    from vitalframe.operators import boosting

    rows = _labelled(spark).withColumn("fold", (F.col("a") % 3).cast("int"))
    grid = {"maxDepth": [2, 3], "stepSize": [0.01, 0.3], "maxIter": [2, 5], "minInstancesPerNode": [3], "subsamplingRate": [0.8]}
    points = [dict(zip(grid, v)) for v in itertools.product(*grid.values())]
    best, scores = boosting.search(rows, points, 3)
    assert len(scores) == 8 and all(len(s) == 3 and all(0 < x <= 1 for x in s) for s in scores)
    assert boosting.search(rows, [points[4]], 3)[1] == [scores[4]]
    monkeypatch.setattr(boosting, "JOINT", 1)
    monkeypatch.setattr(boosting, "CHUNK", 100)
    monkeypatch.setattr(boosting, "IN_MEMORY", 0)
    piecewise = boosting.search(rows, [points[4] | {"subsamplingRate": 1.0}], 3)[1]
    monkeypatch.undo()
    assert piecewise == boosting.search(rows, [points[4] | {"subsamplingRate": 1.0}], 3)[1]
    assert [t.getNumTrees for t in best.models] == [int(max(points, key=lambda p: sum(scores[points.index(p)]))["maxIter"])] * 3
    with pytest.raises(ValueError):
        boosting.search(rows, [{"lossType": "logistic"}], 3)


def test_rows_are_drawn_by_count():
    import numpy as np

    from vitalframe.operators import boosting

    n = np.repeat([0, 1, 5, 63, 64, 500], 40_000)
    got = boosting._drawn(n, 0.8, boosting._quantiles(0.8), np.random.default_rng(1))
    assert (got <= n).all() and (got >= 0).all()
    for k in set(n.tolist()):
        mine = got[n == k]
        assert mine.mean() == pytest.approx(0.8 * k, abs=0.02 * max(1, k**0.5)) and mine.var() == pytest.approx(0.16 * k, rel=0.05)


def test_registered_boosted_search_is_whole(spark, sf, monkeypatch):
    """All published points and folds, not one point of five rounds in two folds."""
    import checks.reg_ml  # noqa: F401
    from checks.registry import QUERIES
    from vitalframe.operators import boosting

    seen = {}

    def search(train, points, folds):
        seen.update(points=[dict(p) for p in points], folds=folds, rows=train.count())
        raise InterruptedError

    monkeypatch.setattr(boosting, "search", search)
    with pytest.raises(InterruptedError):
        QUERIES["m06_train_gbt"](spark, sf)
    assert len(seen["points"]) == 16 and seen["folds"] == 5 and {p["maxIter"] for p in seen["points"]} == {100, 200} and seen["rows"] > 3000


def test_folds_are_kept_on_disk(spark, monkeypatch):
    """Every fit of a search reads folds that are stored, but not as objects in the executors' memory."""
    from pyspark.ml.classification import LinearSVC

    spark.range(5).cache().count()  # what other tests keep does not count
    levels, fit = [], LinearSVC._fit
    held = {i.id() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()}

    def seen(self, dataset):
        levels.extend(i.storageLevel().description() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo() if i.id() not in held)
        return fit(self, dataset)

    monkeypatch.setattr(LinearSVC, "_fit", seen)
    rows = spark.range(200).select((F.col("id") % 2).cast("double").alias("label"), F.lit(1.0).alias("class_weight"), F.array((F.col("id") % 7).cast("double")).alias("f"))
    from pyspark.ml.functions import array_to_vector

    ml.train_svm(rows.withColumn("features", array_to_vector("f")).drop("f"), {"regParam": [0.1, 0.01], "maxIter": [2]}, folds=2)
    kept = ml._DiskFolds(numFolds=2, seed=1)._kFold(rows)
    assert [d.storageLevel.useMemory or not d.storageLevel.useDisk for pair in kept for d in pair] == [False] * 4
    assert levels and not any("Memory" in level for level in levels)
