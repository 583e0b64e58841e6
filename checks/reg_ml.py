"""Tabular learning."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import functions as F

from checks.gold_sql import chain
from checks.inputs import load, over
from checks.reg_eval import _PREDICTED, scored
from checks.registry import register
from checks.sqltext import half_up, pct, with_ctes
from vitalframe.operators import learning as ml
from vitalframe.operators import sampling as sp
from vitalframe.operators.ranking import row_hash
from vitalframe.plans.pipeline import run_pipeline
from vitalframe.plans.training_text import IDENTITY
from vitalframe.sources.tables import materialize, work_path

DAY = dt.date(2024, 2, 1)
TARGET = "glucose_urgency_level"


def diabetes(spark, sf, upto="risk"):
    return run_pipeline(spark, sf, "diabetes", upto, DAY)


@register(
    "m01_select_features",
    with_ctes(chain("diabetes", "prompts"), "SELECT age, gender, bmi, has_hypertension, has_heart_disease, smoking_history, is_current_smoker, "
              "has_smoking_history, diabetes_stage, bmi_category, cardiometabolic_disease_count, cardiovascular_risk_score, "
              "metabolic_syndrome_score, age_risk_category, has_multiple_conditions, has_diabetes, is_obese, is_severely_obese, "
              "glucose_urgency_level FROM gold"),
)
def _(spark, sf):
    return ml.select_features(diabetes(spark, sf, "prompts"), TARGET, "pattern")


_FILL = ("height_cm", "weight_kg"), ("blood_type", "smoking_status", "exercise_frequency")


def _mode(c):
    return f"(SELECT {c} FROM user_medical_profiles WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1)"


@register(
    "m02_impute",
    over("user_medical_profiles", "SELECT user_id, " + ", ".join(
        [f"coalesce({c}, (SELECT median({c}) FROM user_medical_profiles)) AS {c}" for c in _FILL[0]]
        + [f"coalesce({c}, {_mode(c)}) AS {c}" for c in _FILL[1]]) + " FROM user_medical_profiles"),
)
def _(spark, sf):
    return ml.impute(load(spark, sf, "user_medical_profiles"), *_FILL).select("user_id", *_FILL[0], *_FILL[1])


_CODES = ("diabetes_stage", "bmi_category", "gender")


@register(
    "m03_encode",
    with_ctes(chain("diabetes", "core"), "SELECT " + ", ".join(f"(dense_rank() OVER (ORDER BY {c}) - 1)::int AS {c}" for c in _CODES)
              + ", bmi FROM gold"),
)
def _(spark, sf):
    return ml.encode(diabetes(spark, sf, "core").select(*_CODES, "bmi"), _CODES)


_VITALS = ("systolic_bp", "diastolic_bp", "blood_sugar", "heart_rate")


@register(
    "m04_standardize",
    with_ctes(chain("maternal", "silver"), "SELECT " + ", ".join(
        half_up(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()", 6) + f" AS {c}" for c in _VITALS) + " FROM gold"),
)
def _(spark, sf):
    stg = run_pipeline(spark, sf, "maternal", "silver").select(*_VITALS)
    return ml.standardize(stg, _VITALS).select(*[F.round(c, 6).alias(c) for c in _VITALS])


# With Spark ML's own search, the published grids with five folds take hours on one machine: these searches have
# fewer points and two folds. Boosted trees are searched whole.
QUICK = {
    "random_forest": {"numTrees": [20], "maxDepth": [5, 8]},
    "margin": {"regParam": [0.01, 0.1], "maxIter": [10]},
    "forest": {"numTrees": [10], "maxDepth": [5]},
}


def learn(spark, sf, train, name):
    """Split, weigh, search and score one model family.

    The features and the split are written, as ranks, gaps, indexes and folds all read them again.
    """
    gold = diabetes(spark, sf)
    features = ml.feature_columns(gold, TARGET, "pattern")
    keyed = gold.withColumn("row_key", row_hash(IDENTITY["diabetes"])).select(*features, TARGET, "row_key")
    keyed = materialize(keyed, work_path(spark, "keyed_features"))
    parts = sp.stratified_split(keyed, TARGET, [("train", 7), ("val", 2), ("test", 1)], "row_key", 42)
    parts = materialize(parts.drop("row_key"), work_path(spark, "split_features"))
    ready, stages = ml.prepared(parts, features, TARGET)
    shaped = stages.fit(ready.filter("split = 'train'")).transform(ready).select("features", "label", "split").persist(StorageLevel.DISK_ONLY)
    weighed = ml.with_weights(shaped.filter("split = 'train'"))
    fitted = train(weighed, QUICK[name], folds=2) if name in QUICK else train(weighed)
    scores = ml.accuracy_of(fitted.bestModel, {p: shaped.filter(F.col("split") == p) for p in ("train", "val", "test")})
    text = ml.split_types(gold.select(*features))[1]
    names = [c for c in features if c not in text] + [f"{c}_code" for c in text]
    shaped.unpersist()
    return ml.gap_report(ml.compare_models(spark, {name: scores})), fitted.bestModel, names


@register("m05_train_rf")
def _(spark, sf):
    return learn(spark, sf, ml.train_rf, "random_forest")[0]


@register("m06_train_gbt")
def _(spark, sf):
    return learn(spark, sf, ml.train_gbt, "boosted_trees")[0]


@register("m07_train_svm")
def _(spark, sf):
    return learn(spark, sf, ml.train_svm, "margin")[0]


@register(
    "m08_evaluate",
    over("model_predictions", f"""SELECT class, support, {half_up('p', 4)} AS "precision", {half_up('r', 4)} AS recall,
 {half_up('if(p + r > 0, 2 * p * r / (p + r), 0.0::double)', 4)} AS f1 FROM (SELECT class, support::bigint AS support,
 if(called = 0, 0.0::double, hit / called) AS p, if(support = 0, 0.0::double, hit / support) AS r FROM (
 SELECT class, sum(a) AS support, sum(b) AS called, sum(t) AS hit FROM (SELECT ground_truth_urgency AS class, 1 AS a, 0 AS b,
 (ground_truth_urgency = predicted_urgency)::int AS t FROM scored UNION ALL SELECT predicted_urgency, 0, 1, 0 FROM scored) GROUP BY 1))""", _PREDICTED),
)
def _(spark, sf):
    return ml.evaluate(scored(spark, sf), "ground_truth_urgency", "predicted_urgency")


@register(
    "m09_gap_report",
    over("model_accuracy", f"""SELECT *, CASE WHEN train_val_gap > 0.10 THEN 'large_gap' WHEN train_val_gap > 0.05 THEN 'moderate_gap' ELSE 'acceptable' END
 AS overfitting, abs(val_test_gap) <= 0.05 AS representative, train_acc > 0.95 AND val_acc > 0.95 AS suspected_leak FROM (
 SELECT *, {half_up('train_acc - val_acc', 4)} AS train_val_gap, {half_up('val_acc - test_acc', 4)} AS val_test_gap FROM model_accuracy)"""),
)
def _(spark, sf):
    return ml.gap_report(load(spark, sf, "model_accuracy"))


@register("m10_importance_report")
def _(spark, sf):
    _, model, names = learn(spark, sf, ml.train_rf, "forest")
    return ml.importance_report(spark, model, names)


@register(
    "m11_imbalance",
    with_ctes(chain("diabetes", "risk"), f"SELECT glucose_urgency_level, n, {pct('n', 'sum(n) OVER ()')} AS percentage, "
              f"{pct('n', 'sum(n) OVER ()')} < 10 AS severe_imbalance FROM (SELECT glucose_urgency_level, count(*) AS n FROM gold GROUP BY 1)"),
)
def _(spark, sf):
    return ml.imbalance(diabetes(spark, sf), TARGET)
