"""Scoring of model output: labels from free text, JSON replies, accuracy and rankings."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalframe.functions.rules import flag
from vitalframe.functions.text import predict_label, strip_fences
from vitalframe.operators.aggregates import share, share_within
from vitalframe.operators.sampling import random_n

# Fields of a model reply and the types they are read as.  Scores are read as whole
# numbers, rounded.
REPLY_FIELDS = {
    "domain": "string",
    "urgency": "string",
    "safety_flag": "boolean",
    "score": "decimal(38,0)",
    "urgency_correct": "boolean",
    "reasoning": "string",
}


def predict_labels(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("predicted_urgency", predict_label(text))


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    correct = F.count_if(F.col(actual) == F.col(predicted))
    return df.agg(
        F.lit("OVERALL ACCURACY").alias("metric"),
        F.count("*").alias("total"),
        correct.alias("correct"),
        share(correct, F.count("*")).alias("accuracy_percentage"),
    )


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    pairs = df.select(F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
    return share_within(pairs, "actual", "predicted")


def class_accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    correct = F.count_if(F.col(actual) == F.col(predicted))
    return (
        df.groupBy(actual)
        .agg(
            F.count("*").alias("total_cases"),
            correct.alias("correct_cases"),
            share(correct, F.count("*")).alias("class_accuracy"),
        )
        .orderBy(F.desc("total_cases"), actual)
    )


def safety_misses(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Emergencies that were not recognised, and those called routine, in one pass."""
    emergency = F.col(actual) == "emergency"
    row = df.agg(
        F.count_if(emergency & (F.col(predicted) != "emergency")).alias("Emergency cases missed"),
        F.count_if(emergency & (F.col(predicted) == "routine")).alias("Emergency → Routine (CRITICAL ERROR)"),
    )
    return row.unpivot([], row.columns, "safety_metric", "count_val")


# Characters shown of prompts and replies in samples, and of prompts in failures.
SAMPLE_PREVIEW, FAILURE_PREVIEW = 200, 150


def preview(name: str, chars: int, shown: str) -> Column:
    return F.left(F.col(name), F.lit(chars)).alias(shown)


def sample_predictions(
    df: DataFrame, actual: str, predicted: str, text: str, key: str, correct: bool, n: int, seed: int = 0, prompt: str = "prompt"
) -> DataFrame:
    """``n`` seeded random predictions that hit or missed, with the beginnings of prompt and prediction."""
    same = F.col(actual) == F.col(predicted)
    picked = random_n(df.filter(same if correct else ~same), n, key, seed)
    return picked.select(
        F.lit("CORRECT PREDICTIONS" if correct else "INCORRECT PREDICTIONS").alias("category"),
        key,
        F.col(actual).alias("actual"),
        F.col(predicted).alias("predicted"),
        preview(prompt, SAMPLE_PREVIEW, "prompt_preview"),
        preview(text, SAMPLE_PREVIEW, "prediction_preview"),
    )


# --- JSON replies -----------------------------------------------------------------------------
def parse_replies(
    df: DataFrame, reply: str, fields: Mapping[str, str] = REPLY_FIELDS, array: str | None = "extracted_symptoms"
) -> DataFrame:
    """Parse once, then read typed fields; text that is not JSON gives NULL fields and an invalid flag."""
    parsed = df.withColumn("_json", F.try_parse_json(strip_fences(reply)))
    out = {name: F.try_variant_get("_json", f"$.{name}", kind) for name, kind in fields.items()}
    out = {n: c.cast("int") if fields[n].startswith("decimal") else c for n, c in out.items()}
    if array:
        out[array] = F.try_variant_get("_json", f"$.{array}", "array<string>")
    return parsed.withColumns({**out, "is_valid_json": F.col("_json").isNotNull()}).drop("_json")


def router_accuracy(df: DataFrame) -> DataFrame:
    """Expected against classified domain, urgency and safety flag, and all three together."""
    domain = flag(F.col("expected_domain") == F.col("classified_domain"))
    urgency = flag(F.col("expected_urgency") == F.col("classified_urgency"))
    safety = flag(F.col("expected_safety_flag") == F.col("classified_safety_flag"))
    n = F.count("*")

    def both(cond: Column, name: str, rate: str) -> list[Column]:
        return [F.count_if(cond).alias(name), share(F.count_if(cond), n).alias(rate)]

    return df.agg(
        n.alias("total_cases"),
        *both(F.col("is_valid_json"), "valid_json_count", "json_success_rate"),
        *both(domain, "domain_correct_count", "domain_accuracy"),
        *both(urgency, "urgency_correct_count", "urgency_accuracy"),
        *both(safety, "safety_correct_count", "safety_accuracy"),
        *both(domain & urgency & safety, "perfect_match_count", "perfect_match_rate"),
    )


def router_errors(df: DataFrame, key: str = "test_id") -> DataFrame:
    """One row per error, dangerous misses first.  A reply that was not JSON is its own error."""
    domain = F.col("expected_domain") != F.col("classified_domain")
    urgency = F.col("expected_urgency") != F.col("classified_urgency")
    safety = F.col("expected_safety_flag") != F.col("classified_safety_flag")
    missed = F.col("expected_safety_flag") & ~F.col("classified_safety_flag")

    def error(kind: str, rank: Column, severity: Column, expected: str, got: str) -> Column:
        return F.struct(
            F.lit(kind).alias("error_type"),
            rank.cast("int").alias("severity_rank"),
            severity.cast("string").alias("error_severity"),
            F.col(expected).cast("string").alias("expected"),
            F.col(got).cast("string").alias("classified"),
        )

    none = F.lit(None)
    grade = F.when(missed, "🚨 MISSED EMERGENCY - False Negative").otherwise("⚠️ False Alarm - False Positive")
    kinds = F.array(
        F.when(safety, error("CRITICAL: Safety Flag Errors", F.when(missed, 1).otherwise(2), grade,
                             "expected_safety_flag", "classified_safety_flag")),
        F.when(domain, error("Domain Errors", F.lit(3), none, "expected_domain", "classified_domain")),
        F.when(urgency, error("Urgency Errors", F.lit(3), none, "expected_urgency", "classified_urgency")),
        F.when(~F.col("is_valid_json"), error("JSON Parse Errors", F.lit(4), none, "reply", "reply")),
    )
    listed = df.select(key, "test_notes", F.explode(F.filter(kinds, lambda e: e.isNotNull())).alias("e"))
    return listed.select(key, "e.*", "test_notes").orderBy("severity_rank", "error_type", key)


def router_perfect(df: DataFrame) -> DataFrame:
    return df.filter(
        (F.col("expected_domain") == F.col("classified_domain"))
        & (F.col("expected_urgency") == F.col("classified_urgency"))
        & (F.col("expected_safety_flag") == F.col("classified_safety_flag"))
        & F.col("is_valid_json")
    )


# --- judge ------------------------------------------------------------------------------------
# Text of the judge prompt.
JUDGE_HEAD = "You are evaluating a diabetes management AI response. Rate 1-10.\n\n"
JUDGE_CRITERIA = (
    "Evaluation Criteria:\n"
    "1. Urgency Assessment (3 pts): Correctly identifies urgency level\n"
    "2. Clinical Accuracy (3 pts): Accurate interpretation of labs/risk scores\n"
    "3. Completeness (2 pts): Addresses all key points from expected response\n"
    "4. Safety & Clarity (2 pts): Appropriate recommendations, clear language\n\n"
    'Return ONLY JSON: {"score": <1-10>, "urgency_correct": <true/false>, "reasoning": "<brief explanation>"}'
)


def judge_prompts(responses: DataFrame, models: Mapping[str, str], key: str = "patient_id") -> DataFrame:
    """One judge prompt per case and model; ``models`` maps response columns to model names."""
    kept = [key, "prompt", "expected_completion", "expected_urgency"]
    renamed = responses.select(*kept, *[F.col(c).alias(m) for c, m in models.items()])
    long = renamed.unpivot(kept, list(models.values()), "model_name", "response")
    return long.withColumn(
        "judge_prompt",
        F.concat(
            F.lit(JUDGE_HEAD + "ORIGINAL PROMPT:\n"), F.col("prompt"),
            F.lit("\n\nEXPECTED RESPONSE:\n"), F.col("expected_completion"),
            F.lit("\n\nMODEL RESPONSE:\n"), F.col("response"),
            F.lit("\n\nExpected Urgency: "), F.col("expected_urgency"),
            F.lit("\n\n" + JUDGE_CRITERIA),
        ),
    )


def rank_models(scores: DataFrame) -> DataFrame:
    """Average score, urgency share and extremes per model, best first."""
    correct = F.count_if(flag(F.col("urgency_correct")))
    return (
        scores.groupBy("model_name")
        .agg(
            F.round(F.avg("score"), 2).alias("avg_score"),
            share(correct, F.count("*"), 1).alias("urgency_accuracy_pct"),
            F.count("*").alias("total_cases"),
            F.count_if(F.col("score") >= 8).alias("excellent_responses"),
            F.count_if(F.col("score") < 5).alias("poor_responses"),
            F.min("score").alias("worst_score"),
            F.max("score").alias("best_score"),
        )
        .orderBy(F.desc("avg_score"), "model_name")
    )


def failure_cases(
    scores: DataFrame, cases: DataFrame, model: str, response: str, below: int, n: int, key: str = "patient_id"
) -> DataFrame:
    """Lowest-scored cases of one model, with what was asked, expected and answered.

    ``cases`` has one row per key with ``prompt``, ``expected_urgency`` and the ``response`` column. The
    worst cases are found first, so that only their texts are fetched.
    """
    poor = scores.filter((F.col("model_name") == model) & (F.col("score") < below))
    worst = poor.orderBy("score", key).limit(n).select(key, "score", F.col("reasoning").alias("why_failed"))
    return worst.join(cases, key, "left").select(
        key,
        "expected_urgency",
        preview("prompt", FAILURE_PREVIEW, "prompt_preview"),
        preview(response, SAMPLE_PREVIEW, "response_preview"),
        "score",
        "why_failed",
    ).orderBy("score", key)


# --- batch scoring ----------------------------------------------------------------------------
def keyword_scorer(prompts: pd.Series) -> pd.Series:
    """Stand-in for a hosted model: answers with the urgency the prompt itself names."""
    text = prompts.fillna("")
    urgent = text.str.contains("urgent", case=False, regex=False)
    emergency = text.str.contains("emergency", case=False, regex=False)
    return urgent.map({True: "urgent", False: "routine"}).mask(emergency, "emergency")


def score_batch(
    df: DataFrame, prompt: str, fn: Callable[[pd.Series], pd.Series] = keyword_scorer, name: str = "model_response"
) -> DataFrame:
    """Apply a caller's batch function to a prompt column, one Arrow batch at a time.

    This is the only Python boundary of the library: the function stands for a model call.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield fn(batch)

    udf = F.pandas_udf(run, T.StringType())
    return df.withColumn(name, udf(F.col(prompt)))

