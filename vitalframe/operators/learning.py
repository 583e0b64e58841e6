"""Tabular learning on Spark ML: feature choice, preparation, grid search and reports."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalframe.functions.rules import first_match
from vitalframe.operators import boosting
from vitalframe.operators.aggregates import share
from vitalframe.operators.sampling import class_weights, stratified_sample
from vitalframe.sources.tables import materialize, work_path

# Columns of each feature policy. Names are matched without regard to case.
NEVER_FEATURES = [
    "patient_id", "record_id", "id", "index", "created_at", "updated_at", "timestamp", "dbt_loaded_at",
    "should_ask_diabetic_symptoms", "should_ask_cardiovascular_symptoms", "should_ask_diet_habits",
    "should_ask_physical_activity", "should_ask_medication_adherence", "needs_specialist_referral_flag",
    "priority_education_topics",
]
LEAKING_FEATURES = [
    "hyperglycemia_urgency", "hypoglycemia_urgency", "glucose_control_status", "glucose_hba1c_concordance",
    "weight_management_priority", "smoking_cessation_priority", "should_ask_mental_health_screening",
    "should_ask_sleep_quality", "should_ask_substance_use", "should_ask_prenatal_history",
    "should_ask_menstrual_history",
]
RAW_FEATURES = [
    "age", "gender", "bmi", "hba1c_level", "blood_glucose_level", "has_hypertension", "has_heart_disease",
    "smoking_history", "is_current_smoker", "has_smoking_history",
]
PATTERN_FEATURES = [
    "age", "gender", "bmi", "has_hypertension", "has_heart_disease", "smoking_history", "is_current_smoker",
    "has_smoking_history", "diabetes_stage", "bmi_category", "cardiometabolic_disease_count",
    "cardiovascular_risk_score", "metabolic_syndrome_score", "age_risk_category", "has_multiple_conditions",
    "has_diabetes", "is_obese", "is_severely_obese",
]
TOP_LEAKS = ["hyperglycemia_urgency", "hypoglycemia_urgency", "glucose_control_status", "glucose_hba1c_concordance"]

# Thresholds of the reports.
GAP_LARGE, GAP_MODERATE, LEAK_ACCURACY = 0.10, 0.05, 0.95
DOMINANT, HIGH_IMPORTANCE, SMALL_CLASS_PERCENT = 0.5, 0.4, 10


# --- feature choice -----------------------------------------------------------------------------
def feature_columns(df: DataFrame, target: str, policy: str) -> list[str]:
    """Policies: ``exclude``, ``no_leak`` drop listed columns; ``raw``, ``pattern`` keep listed columns."""
    have = {c.lower(): c for c in df.columns}
    if policy in ("raw", "pattern"):
        allowed = RAW_FEATURES if policy == "raw" else PATTERN_FEATURES
        return [have[c] for c in allowed if c in have and c != target.lower()]
    dropped = {target.lower(), *NEVER_FEATURES}
    if policy == "no_leak":
        dropped |= set(LEAKING_FEATURES)
    elif policy != "exclude":
        raise ValueError(f"unknown policy {policy}")
    return [c for c in df.columns if c.lower() not in dropped]


def select_features(df: DataFrame, target: str, policy: str) -> DataFrame:
    return df.select(*feature_columns(df, target, policy), target)


def split_types(df: DataFrame, skip: Sequence[str] = ()) -> tuple[list[str], list[str], list[str]]:
    """Numeric, text and boolean columns."""
    fields = [f for f in df.schema.fields if f.name not in skip]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    boolean = [f.name for f in fields if isinstance(f.dataType, T.BooleanType)]
    return numeric, text, boolean


# --- preparation --------------------------------------------------------------------------------
# Precision of the sketch, and the share of ranks on either side of the middle that is looked at exactly;
# the sketch is off by at most 1 / SKETCH, so the slice always holds the median.
SKETCH = 10_000
MIDDLE = 5 / SKETCH


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median of each numeric column (``column``, ``median``); columns without a value are absent.

    A sketch bounds a thin slice around the middle of every column.  What lies below it is one count,
    its values are counted before they are ordered, so a heavy value is a single row.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    long = df.select(F.explode(pairs).alias("e")).select("e.*").filter("value is not null")
    ends = F.percentile_approx("value", [0.5 - MIDDLE, 0.5 + MIDDLE], SKETCH)
    edges = long.groupBy("column").agg(ends.alias("ends"), F.count("*").alias("n"))
    near = long.join(F.broadcast(edges), "column").filter(F.col("value") <= F.col("ends")[1])  # one row per column
    inside = F.when(F.col("value") >= F.col("ends")[0], F.col("value"))
    counts = near.groupBy("column", "n", inside.alias("value")).agg(F.count("*").alias("rows"))
    upto = F.sum("rows").over(W.partitionBy("column").orderBy(F.asc_nulls_first("value")))
    placed = counts.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("rows"))

    def holds(rank: Column) -> Column:
        return ((F.col("before") <= rank) & (rank < F.col("upto"))).cast("int")

    times = holds(F.floor((F.col("n") - 1) / 2)) + holds(F.floor(F.col("n") / 2))
    return placed.withColumn("times", times).filter("times > 0").groupBy("column").agg((F.sum(F.col("value") * F.col("times")) / 2).alias("median"))


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value of each text column, the smaller one on a tie, in one pass."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])).alias("e"))
    counts = long.select("e.*").filter("value is not null").groupBy("column", "value").agg(F.count("*").alias("n"))
    w = W.partitionBy("column").orderBy(F.desc("n"), "value")
    return counts.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("column", "value")


def impute(df: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> DataFrame:
    """NULL numbers become the median, NULL texts the mode (``unknown`` when a column is all NULL)."""
    present = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in [*numeric, *text]]).first()
    missing = [c for c in numeric if present[c]]
    middle = {r["column"]: r["median"] for r in medians(df, missing).collect()} if missing else {}
    missing_text = [c for c in text if present[c]]
    common = {r["column"]: r["value"] for r in modes(df, missing_text).collect()} if missing_text else {}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(middle.get(c))) for c in missing}
    filled |= {c: F.coalesce(F.col(c), F.lit(common.get(c, "unknown"))) for c in missing_text}
    return df.withColumns(filled) if filled else df


# A dictionary of at most so many values is broadcast; above that, the values that hold more than
# one row in HOT_VALUES are, and all others meet their rows in a shuffle.
DICTIONARY_ROWS = 100_000
HOT_VALUES = 1_024


def dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, value, n and code (place among the sorted distinct values, from 0) of all text columns, as a stored table.

    Distinct values go to ranges of (column, value); range counts and their running sums give each range
    its first code, so no task holds all values of a column.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("e"))
    values = long.select("e.*").where("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("n"))
    ranges = values.repartitionByRange(parts, "column", "value").withColumn("range", F.spark_partition_id())
    ranges = materialize(ranges, work_path(spark, "dictionary_ranges"))
    before = W.partitionBy("column").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranges.groupBy("column", "range").agg(F.count("*").alias("held"))
    offsets = offsets.select("column", "range", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(W.partitionBy("column", "range").orderBy("value"))
    coded = ranges.withColumn("inside", inside).join(offsets, ["column", "range"])
    coded = coded.select("column", "value", "n", (F.col("before") + F.col("inside") - 1).cast("int").alias("code"))
    return materialize(coded, work_path(spark, "dictionary"))


def encode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace text by its place among the sorted distinct values; NULL comes after the last one."""
    if not columns:
        return df
    known = dictionary(df, columns)
    sizes = {r["column"]: (r["values"], r["rows"]) for r in known.groupBy("column").agg(F.count("*").alias("values"), F.sum("n").alias("rows")).collect()}
    for c in columns:
        n_values, n_rows = sizes.get(c, (0, 0))
        of_column = known.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"), "n")
        rows = df.withColumn("_value", F.col(c).cast("string"))
        if n_values <= DICTIONARY_ROWS:
            found = rows.join(F.broadcast(of_column.drop("n")), "_value", "left")
        else:
            hot = F.broadcast(of_column.where(F.col("n") * HOT_VALUES > n_rows).drop("n"))  # at most HOT_VALUES rows
            cold = of_column.where(F.col("n") * HOT_VALUES <= n_rows).drop("n")
            rest = rows.where("_value IS NOT NULL").join(hot.select("_value"), "_value", "left_anti").join(cold, "_value")
            none = rows.where("_value IS NULL").withColumn("_code", F.lit(None).cast("int"))
            found = rows.join(hot, "_value").unionByName(rest).unionByName(none)
        df = found.withColumn(c, F.coalesce("_code", F.lit(n_values)).cast("int")).select(*df.columns)
    return df


def standardize(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population deviation; fit on the training rows only when they are given.

    A constant column becomes zero.
    """
    source = df if fitted_on is None else fitted_on
    stats = source.agg(
        *[F.avg(c).alias(f"_mean_{c}") for c in columns], *[F.stddev_pop(c).alias(f"_std_{c}") for c in columns]
    )
    scale = {
        c: (F.col(c) - F.col(f"_mean_{c}")) / F.when(F.col(f"_std_{c}") == 0, 1.0).otherwise(F.col(f"_std_{c}"))
        for c in columns
    }
    # ``stats`` is one row by construction.
    return df.crossJoin(F.broadcast(stats)).withColumns(scale).select(*df.columns)


def prepared(df: DataFrame, features: Sequence[str], target: str) -> tuple[DataFrame, Pipeline]:
    """Rows without missing features, and the unfitted stages that turn them into a feature vector and a label.

    No row is left out: a feature without any value at all, and a label that the fitted rows lack, fail.
    """
    _, text, boolean = split_types(df.select(*features))
    ready = df.withColumns({c: F.col(c).cast("int") for c in boolean}) if boolean else df
    coded = [f"{c}_code" for c in text]
    numbers = [c for c in features if c not in text]
    ready = impute(ready, numbers, text)
    stages = [
        StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="error"),
        VectorAssembler(inputCols=[*numbers, *coded], outputCol="features", handleInvalid="error"),
    ]
    if text:
        stages.insert(
            0,
            StringIndexer(inputCols=list(text), outputCols=coded, stringOrderType="alphabetAsc", handleInvalid="keep"),
        )
    return ready, Pipeline(stages=stages)


def with_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced class weight on every row; the weight table has one row per class.

    It is broadcast: a shuffle by class would leave the fits as many tasks as there are classes.
    """
    weights = class_weights(df, label).select(label, F.col("weight").alias("class_weight"))
    return df.join(F.broadcast(weights), label)


# --- training -----------------------------------------------------------------------------------
# Search grids, costs of the margin classifier and number of folds. Settings without a
# counterpart in Spark ML (L1 and L2 weights of trees, column samples, kernels) are left out.
RF_GRID = {
    "numTrees": [100, 200], "maxDepth": [10, 15], "minInstancesPerNode": [2, 4],
    "subsamplingRate": [0.8], "featureSubsetStrategy": ["sqrt"],
}
GBT_GRID = {
    "maxDepth": [3, 5], "stepSize": [0.01, 0.1], "maxIter": [100, 200], "minInstancesPerNode": [3, 5],
    "subsamplingRate": [0.8],
}
MARGIN_COSTS = [0.1, 1.0, 10.0]
FOLDS = 5

# Labelled rows that a search fits on; the bound of its cost, whatever the size of the table.
FIT_ROWS = 20_000


def fitting_rows(train: DataFrame, label: str, key: str, rows: int = FIT_ROWS, folds: int = FOLDS, seed: int = 42) -> DataFrame:
    """At most about ``rows`` training rows, class shares kept, with a ``fold`` by digest of the key.

    A table of no more rows is taken whole. Model families that search on the same table share the
    folds, and a row that is computed again is in the same fold.
    """
    if train.count() > rows:
        train = stratified_sample(train, label, rows, key, seed)
    return train.withColumn("fold", F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(folds)).cast("int"))


class _DiskFolds(CrossValidator):
    """Folds are kept on disk: as cached objects, those of a large table fill the executors' memory beside the fits."""

    def _kFold(self, dataset: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
        return [(a.persist(StorageLevel.DISK_ONLY), b.persist(StorageLevel.DISK_ONLY)) for a, b in super()._kFold(dataset)]


def _search(estimator, tuned, train: DataFrame, grid: Mapping[str, list], folds: int, parallel: int) -> CrossValidatorModel:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(getattr(tuned, name), values)
    scorer = MulticlassClassificationEvaluator(metricName="f1")  # class weights belong in the fit only
    search = _DiskFolds(
        estimator=estimator, estimatorParamMaps=builder.build(), evaluator=scorer, numFolds=folds, seed=42,
        parallelism=parallel, foldCol="fold" if "fold" in train.columns else "",
    )
    train = train.persist(StorageLevel.DISK_ONLY)
    fitted = search.fit(train)
    train.unpersist()
    return fitted


def train_rf(train: DataFrame, grid: Mapping[str, list] = RF_GRID, folds: int = FOLDS, parallel: int = 4):
    forest = RandomForestClassifier(weightCol="class_weight", seed=42)
    return _search(forest, forest, train, grid, folds, parallel)


def train_gbt(train: DataFrame, grid: Mapping[str, list] = GBT_GRID, folds: int = FOLDS):
    """Boosted trees, one model per class; all fits of the search work on counted cells (``boosting``)."""
    points = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    best, scores = boosting.search(train, points, folds)
    return CrossValidatorModel(best, [float(np.mean(s)) for s in scores], [], [float(np.std(s)) for s in scores])


def margin_grid(rows: int, costs: Sequence[float] = MARGIN_COSTS) -> dict[str, list]:
    """Costs of summed errors as weights of the penalty against the mean error, which Spark minimises."""
    return {"regParam": [1 / (c * max(rows, 1)) for c in costs]}


def train_svm(train: DataFrame, grid: Mapping[str, list] | None = None, folds: int = FOLDS, parallel: int = 1):
    """Linear margin classifier, one model per class; without a grid the fixed costs are searched.

    A fit holds its rows as blocks in memory, so one runs at a time unless more are asked for.
    """
    margin = LinearSVC(standardization=True)
    many = OneVsRest(classifier=margin, weightCol="class_weight")
    return _search(many, margin, train, grid or margin_grid(train.count()), folds, parallel)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- reports ------------------------------------------------------------------------------------
def evaluate(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class; everything after the first count is class-sized."""
    cells = df.groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    hit = F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0)

    def side(name: str, support: Column, called: Column, correct: Column) -> Column:
        return F.struct(F.col(name).alias("class"), support.alias("s"), called.alias("c"), correct.alias("t"))

    zero = F.lit(0).cast("bigint")
    sides = F.array(side("a", F.col("n"), zero, hit.cast("bigint")), side("p", zero, F.col("n"), zero))
    sums = (
        cells.select(F.explode(sides).alias("x")).select("x.*").filter(F.col("class").isNotNull()).groupBy("class")
        .agg(F.sum("s").alias("support"), F.sum("c").alias("predicted"), F.sum("t").alias("correct"))
    )

    def ratio(a: str, b: str) -> Column:
        return F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))

    rated = sums.withColumns({"precision": ratio("correct", "predicted"), "recall": ratio("correct", "support")})
    both = F.col("precision") + F.col("recall")
    f1 = F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0)
    return rated.select(
        "class", "support", F.round("precision", 4).alias("precision"), F.round("recall", 4).alias("recall"),
        F.round(f1, 4).alias("f1"),
    )


def gap_report(metrics: DataFrame) -> DataFrame:
    """Verdicts on train, validation and test accuracy per model."""
    gap = F.round(F.col("train_acc") - F.col("val_acc"), 4)
    drift = F.round(F.col("val_acc") - F.col("test_acc"), 4)
    return metrics.withColumns({"train_val_gap": gap, "val_test_gap": drift}).withColumns(
        {
            "overfitting": first_match(
                [("large_gap", F.col("train_val_gap") > GAP_LARGE), ("moderate_gap", F.col("train_val_gap") > GAP_MODERATE)],
                "acceptable",
            ),
            "representative": F.abs("val_test_gap") <= GAP_MODERATE,
            "suspected_leak": (F.col("train_acc") > LEAK_ACCURACY) & (F.col("val_acc") > LEAK_ACCURACY),
        }
    )


def importance_report(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """Features by importance with dominance and leakage notes; as long as the feature list."""
    values = model.featureImportances.toArray()
    order = sorted(zip(names, values), key=lambda nv: -nv[1])
    rows = [(i + 1, n, float(v)) for i, (n, v) in enumerate(order)]
    ranked = spark.createDataFrame(rows, "rank int, feature string, importance double")
    top = F.col("rank") == 1
    return ranked.withColumns(
        {
            "note": first_match(
                [
                    ("dominates", top & (F.col("importance") > DOMINANT)),
                    ("high", top & (F.col("importance") > HIGH_IMPORTANCE)),
                ],
                "ok",
            ),
            "leaky_in_top_10": (F.col("rank") <= 10) & F.regexp_replace("feature", "_code$", "").isin(TOP_LEAKS),
        }
    )


def imbalance(df: DataFrame, label: str) -> DataFrame:
    """Class shares with a warning on every class below ten percent."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    percent = share(F.col("n"), F.sum("n").over(W.partitionBy()))
    return counts.withColumn("percentage", percent).withColumn(
        "severe_imbalance", F.col("percentage") < SMALL_CLASS_PERCENT
    )


def accuracy_of(model, parts: Mapping[str, DataFrame]) -> dict[str, float]:
    limits = getattr(model, "bin_limits", None)
    if limits is not None:  # boosted trees: long to score, and alike for rows of the same bins
        return {name: boosting.accuracy(model, limits, df) for name, df in parts.items()}
    scorer = MulticlassClassificationEvaluator(metricName="accuracy")
    return {name: scorer.evaluate(model.transform(df)) for name, df in parts.items()}


def compare_models(spark: SparkSession, results: Mapping[str, Mapping[str, float]]) -> DataFrame:
    rows = [(m, r["train"], r["val"], r["test"]) for m, r in results.items()]
    return spark.createDataFrame(rows, "model string, train_acc double, val_acc double, test_acc double")

