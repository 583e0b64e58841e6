"""Maternal vital-sign features in three tiers.

Blood sugar arrives in mmol/L while the glucose rules use mg/dL cut points, so with valid silver
rows every glucose rule stays silent.  The rules are kept as published.
"""

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
    score,
    span,
    steps,
    topics,
    vocab,
)

# Cut points, labels and points.
AGE_BANDS = [
    ("adolescent_high_risk", below(18)),
    ("teenage_pregnancy", span(18, 19)),
    ("optimal_reproductive_age", span(20, 34)),
    ("advanced_maternal_age", span(35, 39)),
    ("very_advanced_maternal_age", at_least(40)),
]
SYSTOLIC_BANDS = [
    ("hypotension", below(90)),
    ("normal", span(90, 119)),
    ("elevated", span(120, 139)),
    ("stage1_htn", span(140, 159)),
    ("severe_htn", at_least(160)),
]
DIASTOLIC_BANDS = [
    ("hypotension", below(60)),
    ("normal", span(60, 79)),
    ("elevated", span(80, 89)),
    ("stage1_htn", span(90, 109)),
    ("severe_htn", at_least(110)),
]
MAP_BANDS = [("low", below(90)), ("normal", span(90, 105)), ("elevated_preeclampsia_risk", above(105))]
HEART_RATE_BANDS = [
    ("bradycardia", below(60)),
    ("normal_pregnancy", span(60, 100)),
    ("mildly_elevated", span(101, 110)),
    ("tachycardia_concerning", span(111, 120)),
    ("severe_tachycardia", above(120)),
]
SUGAR_BANDS = [
    ("normal", below(140)),
    ("impaired_glucose_tolerance", span(140, 199)),
    ("gestational_diabetes_suspected", at_least(200)),
]
HYPERGLYCEMIA_BANDS = [
    ("normal", below(140)),
    ("mild_hyperglycemia", span(140, 179)),
    ("moderate_hyperglycemia", span(180, 249)),
    ("severe_hyperglycemia", at_least(250)),
]
TEMPERATURE_BANDS = [
    ("hypothermia", below(97.0)),
    ("normal", span(97.0, 99.5)),
    ("low_grade_fever", span(99.6, 100.3)),
    ("fever", span(100.4, 102.9)),
    ("high_fever", at_least(103.0)),
]
RISK_WORDS = {"low_risk": ["low risk"], "moderate_risk": ["mid risk"], "high_risk": ["high risk"]}
SUGAR_POINTS = [(4, at_least(200)), (2, at_least(140))]
GDM_AGE_POINTS = [(2, at_least(35)), (1, at_least(30))]
PREECLAMPSIA_BANDS = [
    ("low_risk", span(0, 0)),
    ("moderate_risk", span(1, 3)),
    ("high_risk", span(4, 6)),
    ("severe_risk", at_least(7)),
]
GDM_BANDS = [("low_risk", span(0, 0)), ("moderate_risk", span(1, 3)), ("high_risk", at_least(4))]
MONITORING_SUGAR = [
    ("multiple_daily_monitoring", at_least(200)),
    ("fasting_postprandial_monitoring", at_least(140)),
]
STRATA = [
    ("very_high_risk", at_least(10)),
    ("high_risk", span(7, 9)),
    ("moderate_risk", span(4, 6)),
    ("low_moderate_risk", span(1, 3)),
]
TONES = {
    "emergency": "urgent_directive_immediate_action",
    "urgent": "serious_concerned_prompt_action",
    "needs_attention": "informative_supportive_followup",
}
FOLLOW_UPS = {"emergency": "immediate_now", "urgent": "within_24_hours", "needs_attention": "within_1_week"}


def _pressure(systolic: int, diastolic: int):
    """Either reading at or above its limit."""
    return (F.col("systolic_bp") >= systolic) | (F.col("diastolic_bp") >= diastolic)


def maternal_core(stg: DataFrame) -> DataFrame:
    s, d, age = F.col("systolic_bp"), F.col("diastolic_bp"), F.col("age")
    sugar, temp, rate = F.col("blood_sugar"), F.col("body_temperature"), F.col("heart_rate")
    arterial = mean_arterial("systolic_bp", "diastolic_bp")
    warning, severe = _pressure(140, 90), _pressure(160, 110)
    age_risk = (age < 18) | (age >= 35)
    return stg.withColumns(
        {
            "maternal_age_category": band(age, AGE_BANDS),
            "pregnancy_bp_stage": first_match(
                [
                    ("normal", (s < 120) & (d < 80)),
                    ("elevated_monitor", s.between(120, 139) | d.between(80, 89)),
                    ("gestational_htn_stage1", s.between(140, 159) | d.between(90, 109)),
                    ("severe_htn_preeclampsia_risk", severe),
                ],
                "unknown",
            ),
            "systolic_category_pregnancy": band(s, SYSTOLIC_BANDS),
            "diastolic_category_pregnancy": band(d, DIASTOLIC_BANDS),
            "pulse_pressure": s - d,
            "mean_arterial_pressure": F.round(arterial, 1),
            "map_risk_category": band(arterial, MAP_BANDS),
            "heart_rate_category_pregnancy": band(rate, HEART_RATE_BANDS),
            "blood_sugar_category": band(sugar, SUGAR_BANDS),
            "hyperglycemia_severity": band(sugar, HYPERGLYCEMIA_BANDS),
            "temperature_category": band(temp, TEMPERATURE_BANDS),
            "risk_level_clean": vocab("risk_level", RISK_WORDS),
            **flags_for(
                [
                    (age_risk, ["has_age_related_risk"]),
                    (warning, ["preeclampsia_bp_warning"]),
                    (severe, ["severe_preeclampsia_bp_warning", "has_severe_preeclampsia_features"]),
                    (rate > 100, ["has_tachycardia"]),
                    (sugar >= 140, ["gestational_diabetes_risk"]),
                    (temp >= 100.4, ["has_fever"]),
                    (
                        severe | (rate > 120) | (rate < 50) | (temp >= 103) | (sugar >= 250),
                        ["has_critical_vitals"],
                    ),
                ]
            ),
            "abnormal_vitals_count": criteria_count(
                [
                    (s >= 140) | (s < 90),
                    (d >= 90) | (d < 60),
                    (rate > 100) | (rate < 60),
                    (temp >= 100.4) | (temp < 97),
                    sugar >= 140,
                ]
            ),
            "preeclampsia_indicator_count": score(points(warning, 2), points(arterial > 105), points(age_risk)),
        }
    )


def maternal_risk(core: DataFrame) -> DataFrame:
    age, sugar, temp, rate = (F.col(c) for c in ("age", "blood_sugar", "body_temperature", "heart_rate"))
    stage, abnormal = F.col("pregnancy_bp_stage"), F.col("abnormal_vitals_count")
    severe, warning, elevated = _pressure(160, 110), _pressure(140, 90), _pressure(120, 80)
    emergencies = [
        ("hypertensive_emergency", severe),
        ("high_fever_emergency", temp >= 103),
        ("hyperglycemic_emergency", sugar >= 250),
        ("severe_tachycardia_emergency", rate > 130),
    ]
    any_emergency = severe | (temp >= 103) | (sugar >= 250) | (rate > 130)
    scored = core.withColumns(
        {
            "preeclampsia_risk_score": score(
                first_match([(5, severe), (3, warning), (1, elevated)], 0),
                first_match([(2, (age < 18) | (age >= 40)), (1, age >= 35)], 0),
                points(sugar >= 140),
                points(rate > 100),
            ),
            "gestational_diabetes_risk_score": score(
                steps(sugar, SUGAR_POINTS), steps(age, GDM_AGE_POINTS), points(stage != "normal"), points(warning)
            ),
            "maternal_emergency_type": first_match(emergencies, "no_emergency"),
            "maternal_urgency_level": first_match(
                [
                    ("emergency", any_emergency),
                    (
                        "urgent",
                        (abnormal >= 3)
                        | (stage == "gestational_htn_stage1")
                        | sugar.between(200, 249)
                        | temp.between(101.0, 102.9),
                    ),
                    (
                        "needs_attention",
                        (abnormal >= 1) | (stage == "elevated_monitor") | sugar.between(140, 199),
                    ),
                ],
                "routine",
            ),
            "maternal_complication_risk_score": score(
                first_match([(3, F.col("preeclampsia_bp_warning")), (1, stage == "elevated_monitor")], 0),
                *[
                    points(c, 2)
                    for c in (
                        F.col("gestational_diabetes_risk"),
                        F.col("has_age_related_risk"),
                        F.col("has_tachycardia"),
                        F.col("has_fever"),
                        abnormal >= 2,
                        F.col("severe_preeclampsia_bp_warning"),
                    )
                ],
            ),
            "fetal_risk_category": first_match(
                [
                    ("high_fetal_risk", severe | (sugar >= 200)),
                    (
                        "moderate_fetal_risk",
                        F.col("preeclampsia_bp_warning") | F.col("gestational_diabetes_risk"),
                    ),
                ],
                "standard_monitoring",
            ),
            "bp_monitoring_frequency": first_match(
                [
                    ("continuous_hospital", severe),
                    ("twice_daily_home", warning),
                    ("daily_home", stage == "elevated_monitor"),
                ],
                "routine_prenatal",
            ),
            "glucose_monitoring_frequency": band(sugar, MONITORING_SUGAR, "routine_screening"),
            "likely_needs_medication": flag(warning | (sugar >= 200)),
        }
    )
    preeclampsia = F.col("preeclampsia_risk_score")
    return scored.withColumns(
        {
            "preeclampsia_risk_category": band(preeclampsia, PREECLAMPSIA_BANDS, None),
            "gestational_diabetes_risk_category": band("gestational_diabetes_risk_score", GDM_BANDS, None),
            "hospitalization_recommendation": first_match(
                [
                    ("immediate_hospitalization", severe),
                    ("consider_admission", preeclampsia >= 7),
                    ("observation_needed", abnormal >= 3),
                ],
                "outpatient_management",
            ),
            "delivery_timing_consideration": first_match(
                [("expedited_delivery_consideration", severe), ("early_delivery_planning", preeclampsia >= 8)],
                "routine_delivery_planning",
            ),
        }
    )


def maternal_prompts(risk: DataFrame) -> DataFrame:
    s, d = F.col("systolic_bp"), F.col("diastolic_bp")
    sugar, temp, rate = F.col("blood_sugar"), F.col("body_temperature"), F.col("heart_rate")
    severe, warning, elevated = _pressure(160, 110), _pressure(140, 90), _pressure(120, 80)
    stage, urgency, abnormal = F.col("pregnancy_bp_stage"), F.col("maternal_urgency_level"), F.col("abnormal_vitals_count")
    pre, gdm = F.col("preeclampsia_risk_score"), F.col("gestational_diabetes_risk_score")
    complication = F.col("maternal_complication_risk_score")
    bp_warning, severe_warning = F.col("preeclampsia_bp_warning"), F.col("severe_preeclampsia_bp_warning")
    sugar_risk, age_risk = F.col("gestational_diabetes_risk"), F.col("has_age_related_risk")
    fast, fever = F.col("has_tachycardia"), F.col("has_fever")
    high_sugar, high_temp = sugar >= 140, temp >= 103
    hypertensive = one_of(stage, "gestational_htn_stage1", "severe_htn_preeclampsia_risk")
    acute = urgency.isin("emergency", "urgent")
    flags = flags_for(
        [
            (bp_warning | (pre >= 3), ["should_ask_preeclampsia_symptoms"]),
            (warning | (pre >= 4), ["should_ask_headaches"]),
            (severe | severe_warning, ["should_ask_vision_changes"]),
            (bp_warning | (pre >= 5), ["should_ask_abdominal_pain"]),
            (hypertensive | (pre >= 3), ["should_ask_swelling"]),
            (bp_warning, ["should_ask_urine_output"]),
            (
                sugar_risk | high_sugar,
                ["should_ask_gdm_symptoms", "should_ask_diet_nutrition", "should_ask_glucose_monitoring"],
            ),
            ((sugar >= 180) | (gdm >= 4), ["should_ask_excessive_thirst", "should_ask_frequent_urination"]),
            (sugar >= 200, ["should_ask_blurred_vision_diabetes"]),
            (fever | (temp >= 100.4), ["should_ask_infection_symptoms", "should_ask_vaginal_symptoms"]),
            (fever, ["should_ask_urinary_symptoms"]),
            (temp >= 101, ["should_ask_exposure_history"]),
            (severe | fast | (rate > 120), ["should_ask_chest_symptoms"]),
            ((rate > 100) | fast, ["should_ask_palpitations"]),
            ((rate > 110) | (s >= 160), ["should_ask_shortness_breath"]),
            ((s < 90) | (d < 60) | severe, ["should_ask_dizziness"]),
            (acute | bp_warning | (sugar_risk & (sugar >= 200)), ["should_ask_fetal_movement"]),
            (severe | fever, ["should_ask_contractions"]),
            (warning | (abnormal >= 2), ["should_ask_vaginal_bleeding"]),
            (fever | (abnormal >= 2), ["should_ask_fluid_leakage"]),
            (acute | bp_warning, ["should_ask_gestational_age"]),
            ((pre >= 3) | sugar_risk | age_risk, ["should_ask_previous_complications"]),
            (abnormal >= 1, ["should_ask_current_complications", "should_ask_prenatal_visits"]),
            (bp_warning | sugar_risk, ["should_ask_multiple_pregnancy"]),
            (warning | high_sugar | (abnormal >= 2), ["should_ask_current_medications"]),
            (sugar_risk | age_risk, ["should_ask_prenatal_vitamins"]),
            (hypertensive | (sugar >= 200), ["should_ask_medication_adherence"]),
            (warning | sugar_risk, ["should_ask_supplements"]),
            (sugar_risk | (stage == "elevated_monitor"), ["should_ask_physical_activity"]),
            (warning | fast, ["should_ask_stress_levels"]),
            (warning, ["should_ask_sleep_quality"]),
            (bp_warning | (abnormal >= 2), ["should_ask_work_activity"]),
            (elevated, ["should_ask_home_bp_monitoring"]),
            ((pre >= 5) | (gdm >= 4) | age_risk, ["should_ask_specialist_care"]),
            (
                (urgency == "emergency") | severe | high_temp | (sugar >= 250),
                ["needs_immediate_ob_evaluation"],
            ),
            (
                (urgency == "urgent")
                | (stage == "gestational_htn_stage1")
                | sugar.between(200, 249)
                | (abnormal >= 3),
                ["needs_urgent_ob_appointment"],
            ),
            ((pre >= 7) | (gdm >= 6) | (age_risk & (abnormal >= 2)), ["needs_mfm_referral"]),
            (
                (F.col("hospitalization_recommendation") == "immediate_hospitalization")
                | severe_warning
                | high_temp,
                ["needs_hospitalization_flag"],
            ),
            (
                severe | high_temp | (sugar >= 250) | F.col("has_critical_vitals"),
                ["needs_emergency_department"],
            ),
            (((pre >= 5) & (gdm >= 4)) | (complication >= 10), ["needs_multidisciplinary_care"]),
        ]
    )
    return risk.withColumns(
        {
            **flags,
            "priority_education_topics": topics(
                [
                    ("preeclampsia_warning_signs", bp_warning),
                    ("gestational_diabetes_management", sugar_risk),
                    ("blood_pressure_monitoring", stage == "elevated_monitor"),
                    ("high_risk_pregnancy_care", age_risk),
                    ("glucose_control_diet", high_sugar),
                    ("cardiovascular_health_pregnancy", fast),
                    ("when_to_call_doctor", abnormal >= 2),
                    ("delivery_planning", pre >= 5),
                ],
                "routine_prenatal_education",
            ),
            "selfmonitoring_focus_areas": topics(
                [
                    ("home_blood_pressure", elevated),
                    ("blood_glucose_testing", sugar_risk),
                    ("daily_symptom_check", bp_warning),
                    ("fetal_movement_counting", urgency.isin("urgent", "needs_attention")),
                    ("carbohydrate_counting", high_sugar),
                ],
                "routine_prenatal_monitoring",
            ),
            "lifestyle_modification_priorities": topics(
                [
                    ("sodium_restriction", stage != "normal"),
                    ("dietary_modifications", sugar_risk),
                    ("activity_modification", warning),
                    ("stress_reduction", fast),
                    ("meal_planning", high_sugar),
                    ("adequate_rest", abnormal >= 2),
                ],
                "healthy_pregnancy_lifestyle",
            ),
            "communication_tone": lookup(urgency, TONES, "reassuring_educational"),
            "recommended_followup_timeframe": lookup(urgency, FOLLOW_UPS, "routine_prenatal_schedule"),
            "monitoring_intensity_needed": first_match(
                [
                    ("continuous_inpatient", urgency == "emergency"),
                    ("intensive_outpatient", pre >= 7),
                    ("frequent_monitoring", urgency == "urgent"),
                    ("increased_monitoring", abnormal >= 1),
                ],
                "routine_prenatal",
            ),
            "conversation_starting_point": first_match(
                [
                    ("emergency_assessment", urgency == "emergency"),
                    ("preeclampsia_screening", severe_warning),
                    ("infection_assessment", fever),
                    ("risk_assessment", bp_warning | sugar_risk),
                ],
                "routine_check_in",
            ),
            "primary_clinical_concern": first_match(
                [
                    ("severe_hypertension_preeclampsia", severe),
                    ("maternal_fever_sepsis_risk", high_temp),
                    ("severe_hyperglycemia", sugar >= 250),
                    ("preeclampsia_high_risk", pre >= 7),
                    ("gestational_diabetes_management", gdm >= 6),
                    ("gestational_hypertension", stage == "gestational_htn_stage1"),
                    ("multiple_abnormalities", abnormal >= 3),
                    ("advanced_maternal_age_monitoring", age_risk),
                ],
                "routine_prenatal_care",
            ),
            "overall_risk_stratification": band(complication, STRATA, "low_risk"),
        }
    )
