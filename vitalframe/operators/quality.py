"""Declarative expectations and training-data quality reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitalframe.functions.rules import first_match
from vitalframe.operators.aggregates import duplicate_report, share


def _check(name: str, column: str, failures: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check"), F.lit(column).alias("column"), failures.cast("bigint").alias("failures")
    )


def _outside(column: str, values: Sequence[object]) -> Column:
    return F.count_if(~F.col(column).isin(list(values)))


def expect_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.agg(_check("not_null", column, F.count_if(F.col(column).isNull())).alias("r")).select("r.*")


def expect_in(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """NULL never fails this check."""
    return df.agg(_check("accepted_values", column, _outside(column, values)).alias("r")).select("r.*")


def expect_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, NULL ignored."""
    groups = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return groups.agg(_check("unique", column, F.count_if(F.col("n") > 1)).alias("r")).select("r.*")


def expect_fk(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent, counted by row; NULL keys pass."""
    used = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    orphans = used.join(parent.select(key), key, "left_anti")
    return orphans.agg(_check("foreign_key", key, F.coalesce(F.sum("n"), F.lit(0))).alias("r")).select("r.*")


def run_suite(df: DataFrame, not_null: Sequence[str], accepted: Mapping[str, Sequence[object]]) -> DataFrame:
    """All checks of a suite in one pass over the data, one row per check."""
    counts = {
        **{("not_null", c): F.count_if(F.col(c).isNull()) for c in not_null},
        **{("accepted_values", c): _outside(c, values) for c, values in accepted.items()},
    }
    names = {key: f"_{i}" for i, key in enumerate(counts)}
    row = df.agg(*[c.alias(names[key]) for key, c in counts.items()])
    checks = [_check(kind, column, F.col(names[kind, column])) for kind, column in counts]
    return row.select(F.explode(F.array(*checks)).alias("r")).select("r.*")


# --- reports over prompt/response pairs ---------------------------------------------------------
def _empty(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == "")


def null_check(pairs: DataFrame) -> DataFrame:
    user, answer = F.count_if(_empty("user_prompt")), F.count_if(_empty("assistant_response"))
    return pairs.agg(
        F.lit("NULL_CHECK").alias("validation_type"),
        F.count("*").alias("total_records"),
        user.alias("null_user_prompts"),
        answer.alias("null_assistant_responses"),
        F.count_if(F.col("ground_truth_urgency").isNull()).alias("null_urgency_labels"),
        share(user, F.count("*")).alias("pct_null_user"),
        share(answer, F.count("*")).alias("pct_null_assistant"),
    )


# Share limits of a balanced class.
UNDER_PERCENT, OVER_PERCENT = 5, 80


def class_balance(pairs: DataFrame, label: str) -> DataFrame:
    counts = pairs.groupBy(label).agg(F.count("*").alias("count"))
    exact = F.col("count") * 100.0 / F.sum("count").over(W.partitionBy())
    return counts.select(
        F.lit("CLASS_BALANCE").alias("validation_type"),
        label,
        "count",
        F.round(exact, 2).alias("percentage"),
        first_match(
            [("UNDERREPRESENTED", exact < UNDER_PERCENT), ("OVERREPRESENTED", exact > OVER_PERCENT)], "BALANCED"
        ).alias("balance_status"),
    ).orderBy(F.desc("count"), label)


def placeholder_check(pairs: DataFrame) -> DataFrame:
    user, answer = F.col("user_prompt"), F.col("assistant_response")

    def says_null(c: Column) -> Column:
        return c.like("%null%") | c.like("%NULL%")

    return pairs.agg(
        F.lit("PLACEHOLDER_CHECK").alias("validation_type"),
        F.count_if(says_null(user)).alias("contains_null_text"),
        F.count_if(says_null(answer)).alias("response_contains_null"),
        F.count_if(user.like("%undefined%")).alias("contains_undefined"),
        F.count_if(answer.like("%[missing]%")).alias("contains_missing_flag"),
        F.count_if(F.length(user) < 50).alias("suspiciously_short_user"),
        F.count_if(F.length(answer) < 100).alias("suspiciously_short_assistant"),
    )


def duplicate_check(pairs: DataFrame) -> DataFrame:
    return duplicate_report(pairs, "user_prompt").select(
        F.lit("DUPLICATE_CHECK").alias("validation_type"),
        F.col("num_duplicate").alias("num_duplicate_prompts"),
        "total_duplicate_records",
        "pct_duplicates",
    )


# Least useful length of each prompt component, with the report's column name.
COMPONENT_LENGTHS = {
    "patient_context": ("has_patient_context", 10),
    "clinical_presentation": ("has_clinical_presentation", 20),
    "comorbidities": ("has_comorbidities", 10),
    "risk_assessment": ("has_risk_assessment", 20),
    "symptom_inquiry": ("has_symptom_inquiry", 20),
    "management_recommendations": ("has_management_recs", 20),
    "education_guidance": ("has_education", 10),
    "triage_recommendation": ("has_triage", 20),
}


def coverage_check(pairs: DataFrame) -> DataFrame:
    return pairs.agg(
        F.lit("COMPONENT_COVERAGE").alias("validation_type"),
        F.count("*").alias("total_records"),
        *[F.count_if(F.length(c) > n).alias(name) for c, (name, n) in COMPONENT_LENGTHS.items()],
    )


# The word a response must carry for each label.
LABEL_WORDS = {"emergency": "EMERGENCY", "urgent": "URGENT", "routine": "ROUTINE"}


def label_consistency(pairs: DataFrame, label: str = "ground_truth_urgency") -> DataFrame:
    answer = F.col("assistant_response")
    agree = reduce(
        lambda a, b: a | b, [(F.col(label) == name) & answer.contains(word) for name, word in LABEL_WORDS.items()]
    )
    return pairs.groupBy(label).agg(
        F.count("*").alias("total"),
        *[F.count_if(answer.contains(w)).alias(f"contains_{name}_keyword") for name, w in LABEL_WORDS.items()],
        share(F.count_if(agree), F.count("*")).alias("consistency_percentage"),
    )


def quality_report(pairs: DataFrame) -> DataFrame:
    """Summary as numbered text lines, from a single aggregation."""
    labels = ("emergency", "urgent", "routine")
    n = F.count("*")
    row = pairs.agg(
        n.alias("n"),
        F.round(F.avg(F.length("user_prompt")) / 4, 0).alias("user_tokens"),
        F.round(F.avg(F.length("assistant_response")) / 4, 0).alias("answer_tokens"),
        *[F.count_if(F.col("ground_truth_urgency") == x).alias(x) for x in labels],
        *[share(F.count_if(F.col("ground_truth_urgency") == x), n, 1).alias(f"{x}_pct") for x in labels],
    )

    def line(head: str, *cols: str | Column) -> Column:
        return F.concat(F.lit(head), *[F.col(c).cast("string") if isinstance(c, str) else c for c in cols])

    lines = [
        F.lit("=== TRAINING DATA QUALITY SUMMARY ==="),
        line("Total Training Examples: ", "n"),
        line("Avg User Prompt Tokens: ", F.col("user_tokens").cast("bigint").cast("string")),
        line("Avg Assistant Tokens: ", F.col("answer_tokens").cast("bigint").cast("string")),
        *[line(f"{x.capitalize()} Cases: ", x, F.lit(" ("), f"{x}_pct", F.lit("%)")) for x in labels],
        F.lit("✅ VALIDATION COMPLETE"),
    ]
    return row.select(F.posexplode(F.array(*lines)).alias("line_no", "report_section"))


def dataset_check(datasets: Sequence[tuple[str, DataFrame]], column: str = "completion") -> DataFrame:
    """Rows, NULLs, empties and lengths of one text column, per dataset."""
    parts = [
        df.agg(
            F.lit(name).alias("dataset"),
            F.count("*").alias("total_rows"),
            F.count(column).alias("has_completion"),
            F.count_if(F.col(column).isNull()).alias("null_count"),
            F.count_if(_empty(column)).alias("empty_count"),
            F.min(F.length(column)).alias("min_length"),
            F.avg(F.length(column)).alias("avg_length"),
        )
        for name, df in datasets
    ]
    return reduce(DataFrame.unionByName, parts)
