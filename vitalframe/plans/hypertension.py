"""Hypertension features in three tiers."""

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
    lookup,
    mean_arterial,
    one_of,
    points,
    safe_ratio,
    score,
    span,
    steps,
    topics,
    tri_flag,
    up_to,
    vocab,
)
from vitalframe.plans.diabetes import BMI_CLASSES

# Cut points and labels.
SYSTOLIC_BANDS = [
    ("normal", below(120)),
    ("elevated", span(120, 129)),
    ("stage1", span(130, 139)),
    ("stage2_moderate", span(140, 159)),
    ("stage2_severe", span(160, 179)),
    ("crisis", at_least(180)),
]
DIASTOLIC_BANDS = [
    ("normal", below(80)),
    ("stage1", span(80, 89)),
    ("stage2_moderate", span(90, 99)),
    ("stage2_severe", span(100, 119)),
    ("crisis", at_least(120)),
]
PULSE_BANDS = [("normal", below(40)), ("borderline", span(40, 60)), ("widened_high_risk", above(60))]
MAP_BANDS = [("normal", below(93)), ("elevated", span(93, 106)), ("high", above(106))]
HEART_RATE_BANDS = [
    ("bradycardia", below(60)),
    ("normal", span(60, 100)),
    ("mild_tachycardia", span(101, 120)),
    ("tachycardia", above(120)),
]
CHOLESTEROL_BANDS = [("desirable", below(200)), ("borderline_high", span(200, 239)), ("high", at_least(240))]
LDL_BANDS = [
    ("optimal", below(100)),
    ("near_optimal", span(100, 129)),
    ("borderline_high", span(130, 159)),
    ("high", span(160, 189)),
    ("very_high", at_least(190)),
]
HDL_BANDS = [("low_major_risk", below(40)), ("borderline_low", span(40, 59)), ("high_protective", at_least(60))]
TRIGLYCERIDE_BANDS = [
    ("normal", below(150)),
    ("borderline_high", span(150, 199)),
    ("high", span(200, 499)),
    ("very_high", at_least(500)),
]
RATIO_BANDS = [("low_risk", below(3.5)), ("moderate_risk", span(3.5, 5.0)), ("high_risk", above(5.0))]
GLUCOSE_BANDS = [("normal", below(100)), ("prediabetes", span(100, 125)), ("diabetes_range", at_least(126))]
SMOKING_WORDS = {"current": ["current"], "former": ["former"], "never": ["never"]}
ACTIVITY_WORDS = {"sedentary": ["low"], "moderate": ["moderate"], "active": ["high"]}
ALCOHOL_BANDS = [("low_moderate", below(7)), ("moderate_high", span(7, 14)), ("excessive", above(14))]
SALT_BANDS = [("within_guidelines", below(5)), ("elevated", span(5, 10)), ("excessive", above(10))]
SLEEP_BANDS = [("insufficient", below(6)), ("adequate", span(6, 9)), ("excessive", above(9))]
STRESS_BANDS = [("low", up_to(3)), ("moderate", span(4, 6)), ("high", span(7, 8)), ("very_high", at_least(9))]
AGE_POINTS = [(0, below(40)), (1, span(40, 49)), (2, span(50, 59)), (3, span(60, 69)), (4, at_least(70))]
STAGE_POINTS = {
    "normal": 0,
    "elevated": 0,
    "stage1_hypertension": 2,
    "stage2_hypertension": 3,
    "hypertensive_crisis": 4,
}
CHOLESTEROL_POINTS = {"desirable": 0, "borderline_high": 1, "high": 2}
HDL_POINTS = {"high_protective": -1, "low_major_risk": 2}
CARDIAC_STAGE_POINTS = {
    "hypertensive_crisis": 4,
    "stage2_hypertension": 3,
    "stage1_hypertension": 2,
    "elevated": 1,
}
TEN_YEAR_BANDS = [("low_risk", below(5)), ("moderate_risk", span(5, 9)), ("high_risk", at_least(10))]
TONES = {
    "hypertensive_crisis_emergency": "urgent_immediate_action",
    "severe_urgency": "serious_prompt_action",
    "moderate_urgency": "concerned_timely_action",
    "needs_attention": "informative_preventive",
}


def hypertension_core(stg: DataFrame) -> DataFrame:
    s, d, bmi = F.col("systolic_bp"), F.col("diastolic_bp"), F.col("bmi")
    pulse, arterial = s - d, mean_arterial("systolic_bp", "diastolic_bp")
    ratio = safe_ratio("cholesterol", "hdl")
    return stg.withColumns(
        {
            # A diastolic value in 80-89 decides before any higher systolic band, and the crisis
            # label stands behind a wider condition: both are part of the published rule.
            "bp_stage": first_match(
                [
                    ("normal", (s < 120) & (d < 80)),
                    ("elevated", s.between(120, 129) & (d < 80)),
                    ("stage1_hypertension", s.between(130, 139) | d.between(80, 89)),
                    ("stage2_hypertension", (s >= 140) | (d >= 90)),
                    ("hypertensive_crisis", (s >= 180) | (d >= 120)),
                ],
                "unknown",
            ),
            "systolic_category": band(s, SYSTOLIC_BANDS),
            "diastolic_category": band(d, DIASTOLIC_BANDS),
            "pulse_pressure": pulse,
            "pulse_pressure_category": band(pulse, PULSE_BANDS),
            "has_isolated_systolic_htn": flag((s >= 140) & (d < 90)),
            "mean_arterial_pressure": F.round(arterial, 1),
            "map_category": band(arterial, MAP_BANDS),
            "heart_rate_category": band("heart_rate", HEART_RATE_BANDS),
            "cholesterol_category": band("cholesterol", CHOLESTEROL_BANDS),
            "ldl_category": band("ldl", LDL_BANDS),
            "hdl_category": band("hdl", HDL_BANDS),
            "triglycerides_category": band("triglycerides", TRIGLYCERIDE_BANDS),
            "cholesterol_hdl_ratio": F.round(ratio, 2),
            "cholesterol_ratio_risk": band(ratio, RATIO_BANDS),
            "bmi_category": band(bmi, BMI_CLASSES),
            "is_obese": flag(bmi >= 30),
            "glucose_status": band("glucose", GLUCOSE_BANDS),
            "smoking_status_clean": vocab("smoking_status", SMOKING_WORDS),
            "is_current_smoker": flag(F.lower("smoking_status") == "current"),
            "activity_level_clean": vocab("physical_activity_level", ACTIVITY_WORDS),
            "is_sedentary": flag(F.lower("physical_activity_level") == "low"),
            "alcohol_risk_level": band("alcohol_intake", ALCOHOL_BANDS),
            "salt_intake_risk": band("salt_intake", SALT_BANDS),
            "sleep_adequacy": band("sleep_duration", SLEEP_BANDS),
            "stress_category": band("stress_level", STRESS_BANDS),
            "has_hypertension_diagnosis": tri_flag("hypertension_status", "high", "low"),
        }
    )


def hypertension_risk(core: DataFrame) -> DataFrame:
    s, d, bmi, age = (F.col(c) for c in ("systolic_bp", "diastolic_bp", "bmi", "age"))
    stage = F.col("bp_stage")
    stage1, elevated = stage == "stage1_hypertension", stage == "elevated"
    stage2up = one_of(stage, "stage2_hypertension", "hypertensive_crisis")
    raised = ~one_of(stage, "normal", "elevated")
    smoker, obese, sedentary = F.col("is_current_smoker"), F.col("is_obese"), F.col("is_sedentary")
    sugar = F.col("has_diabetes") | (F.col("glucose_status") == "diabetes_range")
    high_cholesterol = F.col("cholesterol_category") == "high"
    crisis = (s >= 180) | (d >= 120)
    stressed = one_of("stress_category", "high", "very_high")
    alcohol = F.col("alcohol_risk_level")
    criteria = [
        raised,
        one_of("glucose_status", "prediabetes", "diabetes_range"),
        one_of("triglycerides_category", "high", "very_high"),
        F.col("hdl_category") == "low_major_risk",
        bmi >= 30,
    ]
    scored = core.withColumns(
        {
            "bp_urgency_level": first_match(
                [
                    ("hypertensive_crisis_emergency", crisis),
                    ("severe_urgency", (s >= 160) | (d >= 100)),
                    ("moderate_urgency", stage == "stage2_hypertension"),
                    ("needs_attention", stage1),
                ],
                "routine",
            ),
            "potential_hypertensive_emergency": flag(crisis),
            # Unknown age, stage or cholesterol leaves the score NULL on purpose.
            "cardiovascular_risk_score": score(
                steps(age, AGE_POINTS, None),
                lookup(stage, STAGE_POINTS),
                lookup("cholesterol_category", CHOLESTEROL_POINTS),
                lookup("hdl_category", HDL_POINTS, 0),
                points(smoker, 2),
                points(sugar, 2),
                points(obese),
            ),
            "metabolic_syndrome_criteria_count": criteria_count(criteria),
            "stroke_risk_factors_count": criteria_count(
                [stage2up, age >= 65, sugar, smoker, high_cholesterol, F.col("has_family_history")]
            ),
            "dietary_modification_priority": first_match(
                [
                    ("critical", stage2up),
                    ("high", stage1 & (F.col("salt_intake_risk") == "excessive")),
                    ("moderate", stage1),
                    ("preventive", elevated),
                ],
                "maintenance",
            ),
            "exercise_priority": first_match(
                [
                    ("high", sedentary & one_of(stage, "stage1_hypertension", "stage2_hypertension")),
                    ("moderate", sedentary & elevated),
                    ("preventive", sedentary),
                ],
                "maintenance",
            ),
            "weight_loss_priority": first_match(
                [
                    ("critical", obese & stage2up),
                    ("high", obese & stage1),
                    ("moderate", (bmi >= 25) & (elevated | stage1)),
                ],
                "maintenance",
            ),
            "smoking_cessation_priority_htn": first_match(
                [
                    ("critical", smoker & stage2up),
                    ("high", smoker & stage1),
                    ("moderate", smoker),
                    ("relapse_prevention", F.col("smoking_status_clean") == "former"),
                ],
                "not_applicable",
            ),
            "alcohol_reduction_priority": first_match(
                [
                    ("high", (alcohol == "excessive") & raised),
                    ("moderate", (alcohol == "excessive") | ((alcohol == "moderate_high") & raised)),
                ],
                "maintenance",
            ),
            "stress_management_priority": first_match([("high", stressed & raised), ("moderate", stressed)], "low"),
            "cardiac_damage_risk_score": score(
                lookup(stage, CARDIAC_STAGE_POINTS, 0),
                points(F.col("pulse_pressure_category") == "widened_high_risk", 2),
                points(high_cholesterol),
                points(smoker),
            ),
            "kidney_damage_risk": first_match(
                [("high_nephropathy_risk", stage2up & sugar), ("moderate_nephropathy_risk", stage2up)], "low_risk"
            ),
            "age_bp_risk_category": first_match(
                [
                    ("young_onset_critical", (age < 40) & (stage1 | stage2up)),
                    ("midlife_high_risk", age.between(40, 64) & stage2up),
                    ("elderly_high_risk", (age >= 65) & stage2up),
                    ("isolated_systolic_elderly", (age >= 65) & F.col("has_isolated_systolic_htn")),
                ],
                "standard_management",
            ),
        }
    )
    risk = F.col("cardiovascular_risk_score")
    return scored.withColumns(
        {
            "ten_year_cv_risk_category": band(risk, TEN_YEAR_BANDS, None),
            "has_metabolic_syndrome": F.col("metabolic_syndrome_criteria_count") >= 3,
            "likely_needs_medication": flag(stage2up) | flag(stage1 & ((risk >= 8) | sugar)),
            "medication_urgency": first_match(
                [
                    ("immediate", stage == "hypertensive_crisis"),
                    ("urgent", stage == "stage2_hypertension"),
                    ("prompt", stage1 & (risk >= 8)),
                    ("consider", stage1),
                ],
                "lifestyle_first",
            ),
        }
    )


def hypertension_prompts(risk: DataFrame) -> DataFrame:
    stage, cv = F.col("bp_stage"), F.col("cardiovascular_risk_score")
    crisis, stage2 = stage == "hypertensive_crisis", stage == "stage2_hypertension"
    raised, not_normal = ~one_of(stage, "normal", "elevated"), stage != "normal"
    diagnosed, syndrome = F.col("has_hypertension_diagnosis"), F.col("has_metabolic_syndrome")
    stressed = one_of("stress_category", "high", "very_high")
    salty = one_of("salt_intake_risk", "elevated", "excessive")
    short_sleep = F.col("sleep_adequacy") == "insufficient"
    kidney = one_of("kidney_damage_risk", "high_nephropathy_risk", "moderate_nephropathy_risk")
    damage, obese = F.col("cardiac_damage_risk_score"), F.col("is_obese")
    smoker, sedentary = F.col("is_current_smoker"), F.col("is_sedentary")
    young = F.col("age_bp_risk_category") == "young_onset_critical"
    sugar_signs = one_of("glucose_status", "prediabetes", "diabetes_range")
    emergency = F.col("potential_hypertensive_emergency")
    flags = flags_for(
        [
            (F.col("bp_urgency_level") == "hypertensive_crisis_emergency", ["should_ask_crisis_symptoms"]),
            (stage2 | crisis | (cv >= 8), ["should_ask_cardiovascular_symptoms"]),
            ((F.col("stroke_risk_factors_count") >= 3) | crisis, ["should_ask_stroke_symptoms"]),
            (kidney, ["should_ask_kidney_symptoms", "needs_kidney_function_testing"]),
            (stage2 | crisis, ["should_ask_headache_vision"]),
            ((damage >= 5) | crisis, ["should_ask_chest_symptoms"]),
            (raised | salty, ["should_ask_diet_sodium"]),
            (sedentary | not_normal, ["should_ask_exercise_habits"]),
            (stressed | short_sleep | raised, ["should_ask_stress_sleep"]),
            (one_of("alcohol_risk_level", "moderate_high", "excessive") | raised, ["should_ask_alcohol_use"]),
            (obese | ((F.col("bmi") >= 25) & raised), ["should_ask_weight_management"]),
            (diagnosed | raised, ["should_ask_current_medications"]),
            (diagnosed & raised, ["should_ask_medication_adherence"]),
            (diagnosed, ["should_ask_medication_sideeffects"]),
            (not_normal, ["needs_home_bp_monitoring"]),
            (
                one_of("cholesterol_category", "borderline_high", "high") | (cv >= 7),
                ["needs_lipid_management_discussion"],
            ),
            ((sugar_signs | syndrome) & ~F.col("has_diabetes"), ["needs_diabetes_screening"]),
            (crisis | young | (stage2 & ((cv >= 10) | syndrome)), ["needs_specialist_referral_flag"]),
            (emergency, ["needs_emergency_care_flag"]),
            ((damage >= 6) | young, ["consider_cardiology_referral"]),
        ]
    )
    urgent_or_moderate = ("critical", "high", "moderate")
    return risk.withColumns(
        {
            **flags,
            "priority_education_topics": topics(
                [
                    ("blood_pressure_basics", not_normal),
                    ("DASH_diet", one_of("dietary_modification_priority", "critical", "high")),
                    ("sodium_reduction", salty),
                    ("exercise_prescription", one_of("exercise_priority", "high", "moderate")),
                    ("weight_management", one_of("weight_loss_priority", "critical", "high")),
                    ("smoking_cessation", smoker),
                    ("stress_reduction", one_of("stress_management_priority", "high", "moderate")),
                    ("medication_education", F.col("likely_needs_medication")),
                    ("metabolic_syndrome", syndrome),
                    ("cardiovascular_risk_reduction", cv >= 8),
                    ("home_bp_monitoring", not_normal),
                ]
            ),
            "lifestyle_modification_focus": topics(
                [
                    ("diet", one_of("dietary_modification_priority", *urgent_or_moderate)),
                    ("exercise", one_of("exercise_priority", "high", "moderate")),
                    ("weight", one_of("weight_loss_priority", *urgent_or_moderate)),
                    ("smoking", one_of("smoking_cessation_priority_htn", *urgent_or_moderate)),
                    ("alcohol", one_of("alcohol_reduction_priority", "high", "moderate")),
                    ("stress", one_of("stress_management_priority", "high", "moderate")),
                    ("sleep", short_sleep),
                ]
            ),
            "communication_tone": lookup("bp_urgency_level", TONES, "supportive_maintenance"),
        }
    )
