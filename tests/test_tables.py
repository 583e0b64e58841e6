"""Table maintenance on small tables."""

import datetime as dt

from pyspark.sql import functions as F

from vitalframe.operators import quality
from vitalframe.operators.cleaning import filter_valid
from vitalframe.sources import tables
from vitalframe.sources.schemas import APP, APP_DEFAULTS, APP_KEYS


def rows(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_every_app_table_can_be_created(spark):
    one = spark.range(1).select(F.lit("x").alias("user_id"))
    for name, schema in APP.items():
        out = tables.with_defaults(one, schema, APP_DEFAULTS[name])
        assert APP_KEYS[name][0] in out.columns
        assert out.count() == 1


def test_defaults_fill_absent_not_null(spark):
    df = spark.createDataFrame([("u1", None), ("u2", "closed")], "user_id string, account_status string")
    out = rows(tables.with_defaults(df, APP["users"], APP_DEFAULTS["users"]), "user_id")
    assert out["u1"]["account_status"] is None and out["u2"]["account_status"] == "closed"
    assert out["u1"]["failed_login_attempts"] == 0 and out["u1"]["email_verified"] is False
    assert out["u1"]["created_at"] is not None and out["u1"]["phone_number"] is None


def test_merge_updates_and_inserts(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 3, "z")], "k string, v int, w string")
    source = spark.createDataFrame([("b", None, "q"), ("c", 9, "r")], "k string, v int, w string")
    out = tables.merge_upsert(target, source, "k", ["v"], ["k", "v"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [("a", 1, "x"), ("b", None, "y"), (None, 3, "z"), ("c", 9, None)], key=str
    )


def test_patch_keeps_what_is_not_supplied(spark):
    old = dt.date(2020, 1, 1)
    target = spark.createDataFrame(
        [("a", 60.0, True, False, old), ("b", 70.0, True, True, old), ("c", 80.0, False, False, old)],
        "user_id string, weight_kg double, has_diabetes boolean, is_pregnant boolean, last_updated date",
    )
    patches = spark.createDataFrame(
        [("a", None, None, True, "Female"), ("b", 71.0, False, False, "Male")],
        "user_id string, weight_kg double, has_diabetes boolean, is_pregnant boolean, gender string",
    )
    day = dt.date(2024, 2, 1)
    out = rows(tables.patch_rows(target, patches, "user_id", F.lit(day), "gender"), "user_id")
    assert out["a"] == {"user_id": "a", "weight_kg": 60.0, "has_diabetes": True, "is_pregnant": True, "last_updated": day}
    assert out["b"]["has_diabetes"] is False and out["b"]["is_pregnant"] is True and out["b"]["weight_kg"] == 71.0
    assert out["c"]["last_updated"] == old


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", 2)], "k string, v int")
    assert sorted(r.k for r in tables.delete_where(df, F.col("v") == 1).collect()) == ["b", "c"]


def test_evolve_and_lookup(spark):
    df = spark.createDataFrame([("a'; drop", 1)], "k string, v int")
    out = tables.evolve(df, {"note": "string"}, {"v": "bigint"})
    assert dict(out.dtypes) == {"k": "string", "v": "bigint", "note": "string"}
    assert tables.lookup_rows(out, k="a'; drop", v=1).count() == 1
    assert tables.lookup_rows(out, k="' OR 1=1 --").count() == 0


def test_csv_and_json_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("p1", "c1"), ("p\n2", None)], "prompt string, completion string")
    tables.export_pairs(df, str(tmp_path / "pairs"))
    back = spark.read.schema("prompt string, completion string").json(str(tmp_path / "pairs"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted([("p1", "c1"), ("p\n2", None)], key=str)
    spark.createDataFrame([(1.5, "x"), (2.5, None)], "v double, t string").write.option("header", True).csv(str(tmp_path / "csv"))
    typed = tables.read_labeled_csv(spark, str(tmp_path / "csv"), "t")
    assert typed.dtypes == [("v", "double"), ("t", "string")] and typed.count() == 1


def test_materialize_replaces_and_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.materialize(spark.range(5), path)
    out = tables.materialize(spark.range(3).withColumn("g", F.col("id") % 2), path, ["g"])
    assert out.count() == 3 and (tmp_path / "t" / "g=0").exists()


def test_filters_reach_the_bronze_scan(spark, sf, tmp_path):
    from vitalframe.operators import silver
    from vitalframe.sources import fixtures

    fixtures.view(spark, sf, "raw_diabetes").write.parquet(str(tmp_path / "raw_diabetes.parquet"))
    raw = tables.read_source(spark, "raw_diabetes", str(tmp_path))
    plan = silver.stg_diabetes(raw)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(AGE,10.0)" in pushed.replace(" ", "") and "IsNotNull(GENDER)" in pushed
    few = filter_valid(raw, silver.DIABETES_RANGES).select("GENDER")
    read = few._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1].splitlines()[0]
    assert "HBA1C_LEVEL" in read and "SMOKING_HISTORY" not in read and "HEART_DISEASE" not in read


def test_checks_on_keys(spark):
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "user_id string")
    child = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "user_id string")
    assert quality.expect_unique(parent, "user_id").first()["failures"] == 1
    assert quality.expect_fk(child, parent, "user_id").first()["failures"] == 2
    assert quality.expect_not_null(child, "user_id").first()["failures"] == 1
    assert quality.expect_in(child, "user_id", ["a"]).first()["failures"] == 2
