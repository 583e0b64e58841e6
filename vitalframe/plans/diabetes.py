"""Diabetes features in three tiers: core clinical, risk and urgency, conversation prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.functions.rules import (
    above,
    at_least,
    band,
    below,
    criteria_count,
    first_match,
    flag,
    flags_for,
    one_of,
    points,
    score,
    span,
    steps,
    topics,
    vocab,
)

# Cut points, labels and word lists.
HBA1C_STAGES = [
    ("normal", below(5.7)),
    ("prediabetes", span(5.7, 6.4)),
    ("diabetes_controlled", span(6.5, 7.9)),
    ("diabetes_uncontrolled", span(8.0, 9.9)),
    ("diabetes_severe", at_least(10.0)),
]
GLUCOSE_CONTROL = [
    ("normal", below(100)),
    ("prediabetes_range", span(100, 125)),
    ("diabetes_mild", span(126, 180)),
    ("diabetes_moderate", span(181, 250)),
    ("diabetes_severe", above(250)),
]
BMI_CLASSES = [
    ("underweight", below(18.5)),
    ("normal", span(18.5, 24.9)),
    ("overweight", span(25.0, 29.9)),
    ("obese_class1", span(30.0, 34.9)),
    ("obese_class2", span(35.0, 39.9)),
    ("obese_class3_severe", at_least(40.0)),
]
SMOKING_WORDS = {
    "current": ["current", "current smoker"],
    "former": ["former", "ex-smoker", "not current"],
    "never": ["never", "non-smoker"],
    "ever": ["ever", "yes"],
}
NON_SMOKING_WORDS = ["never", "non-smoker", "no info"]
HIGH_GLUCOSE = [
    ("emergency_hyperglycemia", above(400)),
    ("urgent_hyperglycemia", span(300, 400)),
    ("concerning_hyperglycemia", span(250, 299)),
]
LOW_GLUCOSE = [("emergency_hypoglycemia", below(54)), ("urgent_hypoglycemia", span(54, 70))]
HBA1C_COMPLICATION_POINTS = [(4, at_least(9.0)), (3, at_least(8.0)), (2, at_least(7.0)), (1, at_least(6.5))]
ONSET_AGES = [
    ("young_onset_high_risk", below(40)),
    ("standard_risk", span(40, 64)),
    ("elderly_high_risk", at_least(65)),
]
DIABETIC_STAGES = ("prediabetes", "diabetes_controlled", "diabetes_uncontrolled", "diabetes_severe")


def diabetes_core(stg: DataFrame) -> DataFrame:
    glucose, hba1c, bmi = F.col("blood_glucose_level"), F.col("hba1c_level"), F.col("bmi")
    smoking = F.lower(F.col("smoking_history"))
    diagnoses = [F.col("has_diabetes"), F.col("has_hypertension"), F.col("has_heart_disease")]
    glucose_high, hba1c_high = glucose >= 126, hba1c >= 6.5
    return stg.withColumns(
        {
            "diabetes_stage": band(hba1c, HBA1C_STAGES),
            "glucose_control_status": band(glucose, GLUCOSE_CONTROL),
            "glucose_hba1c_concordance": first_match(
                [
                    ("concordant_normal", ~glucose_high & ~hba1c_high),
                    ("concordant_diabetic", glucose_high & hba1c_high),
                    ("discordant_acute_high", glucose_high & ~hba1c_high),
                    ("discordant_chronic_poor", ~glucose_high & hba1c_high),
                ],
                "unknown",
            ),
            "bmi_category": band(bmi, BMI_CLASSES),
            "is_obese": flag(bmi >= 30),
            "is_severely_obese": flag(bmi >= 40),
            "cardiometabolic_disease_count": criteria_count(diagnoses),
            "has_triple_diagnosis": criteria_count(diagnoses) == 3,
            "has_multiple_conditions": criteria_count(diagnoses) >= 2,
            "smoking_status_clean": vocab("smoking_history", SMOKING_WORDS, "no_info"),
            "is_current_smoker": flag(smoking.isin(SMOKING_WORDS["current"])),
            "has_smoking_history": flag(~smoking.isin(NON_SMOKING_WORDS)),
        }
    )


def diabetes_risk(core: DataFrame) -> DataFrame:
    glucose, hba1c, bmi, age = (F.col(c) for c in ("blood_glucose_level", "hba1c_level", "bmi", "age"))
    diabetes, pressure, heart = F.col("has_diabetes"), F.col("has_hypertension"), F.col("has_heart_disease")
    smoker = F.col("is_current_smoker")
    comorbid = [points(pressure, 2), points(heart, 3), points(smoker, 2)]
    return core.withColumns(
        {
            "hyperglycemia_urgency": band(glucose, HIGH_GLUCOSE, "stable"),
            "hypoglycemia_urgency": band(glucose, LOW_GLUCOSE, "no_hypoglycemia"),
            "glucose_urgency_level": first_match(
                [
                    ("emergency", (glucose < 54) | (glucose > 400)),
                    ("urgent", glucose.between(54, 70) | glucose.between(300, 400)),
                    ("needs_attention", glucose.between(250, 299)),
                ],
                "routine",
            ),
            "cardiovascular_risk_score": score(points(diabetes, 2), *comorbid, points(bmi >= 30)),
            "metabolic_syndrome_score": score(
                points(bmi >= 30, 2), points(hba1c >= 5.7, 2), points(pressure, 2), points(glucose >= 100, 2)
            ),
            "diabetes_complication_risk_score": score(
                steps(hba1c, HBA1C_COMPLICATION_POINTS), *comorbid, points(bmi >= 35)
            ),
            "weight_management_priority": first_match(
                [
                    ("critical", bmi >= 40),
                    ("high", (bmi >= 35) & (diabetes | pressure)),
                    ("moderate", bmi >= 30),
                    ("low", bmi.between(25, 29.9)),
                ],
                "maintenance",
            ),
            "smoking_cessation_priority": first_match(
                [
                    ("critical", smoker & (heart | diabetes)),
                    ("high", smoker & pressure),
                    ("moderate", smoker),
                    ("relapse_prevention", F.col("smoking_status_clean") == "former"),
                ],
                "not_applicable",
            ),
            "age_risk_category": band(age, ONSET_AGES, None),
            "has_premature_disease": flag((age < 45) & (diabetes | heart)),
        }
    )


def diabetes_prompts(risk: DataFrame) -> DataFrame:
    hba1c, bmi = F.col("hba1c_level"), F.col("bmi")
    diabetes, pressure, heart = F.col("has_diabetes"), F.col("has_hypertension"), F.col("has_heart_disease")
    smoker = F.col("is_current_smoker")
    diabetic_stage = one_of("diabetes_stage", *DIABETIC_STAGES)
    watch_glucose = diabetes | (F.col("diabetes_stage") == "prediabetes")
    any_diagnosis = diabetes | pressure | heart
    overweight = bmi >= 25
    flags = flags_for(
        [
            (diabetic_stage, ["should_ask_diabetic_symptoms"]),
            (heart | (F.col("cardiovascular_risk_score") >= 5), ["should_ask_cardiovascular_symptoms"]),
            (diabetes & (hba1c >= 8), ["should_ask_neuropathy_symptoms"]),
            (watch_glucose | overweight, ["should_ask_diet_habits"]),
            (overweight | diabetes | heart, ["should_ask_physical_activity"]),
            (any_diagnosis, ["should_ask_medication_adherence", "needs_bp_monitoring_discussion"]),
            (watch_glucose, ["needs_glucose_monitoring_discussion"]),
            (
                (diabetes & (hba1c >= 9)) | F.col("has_triple_diagnosis") | (heart & smoker),
                ["needs_specialist_referral_flag"],
            ),
        ]
    )
    education = topics(
        [
            ("diabetes_management", diabetic_stage),
            ("weight_management", bmi >= 30),
            ("smoking_cessation", smoker),
            ("blood_pressure_control", pressure),
            ("cardiovascular_health", heart),
            ("complication_prevention", hba1c >= 8),
        ]
    )
    return risk.withColumns({**flags, "priority_education_topics": education})
