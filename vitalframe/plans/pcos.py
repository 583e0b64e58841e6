"""PCOS features in three tiers, built around the three Rotterdam criteria."""

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
    one_of,
    points,
    safe_ratio,
    score,
    span,
    steps,
    topics,
    up_to,
    vocab,
)
from vitalframe.plans.diabetes import BMI_CLASSES

# Cut points, labels and points.
AGE_BANDS = [
    ("adolescent", below(18)),
    ("young_reproductive", span(18, 25)),
    ("prime_reproductive", span(26, 35)),
    ("late_reproductive", span(36, 45)),
    ("perimenopausal_or_older", above(45)),
]
LH_BANDS = [
    ("low", below(1.9)),
    ("normal", span(1.9, 12.5)),
    ("elevated_mild", span(12.6, 20.0)),
    ("elevated_high", above(20.0)),
]
FSH_BANDS = [
    ("low", below(1.4)),
    ("normal", span(1.4, 9.9)),
    ("elevated_mild", span(10.0, 20.0)),
    ("elevated_high", above(20.0)),
]
RATIO_BANDS = [
    ("low_ratio", below(1.0)),
    ("normal_ratio", span(1.0, 1.9)),
    ("elevated_pcos_suggestive", span(2.0, 2.9)),
    ("very_elevated_pcos_likely", at_least(3.0)),
]
AMH_BANDS = [
    ("low_ovarian_reserve", below(1.0)),
    ("normal", span(1.0, 4.0)),
    ("elevated_pcos_risk", span(4.1, 7.0)),
    ("very_elevated_pcos_likely", above(7.0)),
]
RESERVE_BANDS = [
    ("diminished_ovarian_reserve", below(1.0)),
    ("low_normal", span(1.0, 2.0)),
    ("normal", span(2.1, 4.0)),
    ("polycystic_ovary_pattern", above(4.0)),
]
TESTOSTERONE_BANDS = [
    ("low", below(10)),
    ("normal", span(10, 70)),
    ("mildly_elevated", span(71, 150)),
    ("moderately_elevated", span(151, 300)),
    ("severely_elevated", above(300)),
]
ANDROGEN_BANDS = [
    ("no_hyperandrogenism", up_to(70)),
    ("mild_hyperandrogenism", span(71, 100)),
    ("moderate_hyperandrogenism", span(101, 150)),
    ("severe_hyperandrogenism", above(150)),
]
CYCLE_WORDS = {"regular": ["regular"], "irregular": ["irregular"]}
TESTOSTERONE_POINTS = [(4, above(150)), (3, above(100)), (2, above(70))]
RATIO_POINTS = [(3, at_least(3.0)), (2, at_least(2.0)), (1, at_least(1.5))]
AMH_POINTS = [(3, above(10.0)), (2, above(7.0)), (1, above(4.0))]
SEVERITY_BMI_POINTS = [(2, at_least(35)), (1, at_least(30))]
METABOLIC_BMI_POINTS = [(3, at_least(30)), (1, at_least(25))]
FERTILITY_AMH_POINTS = [(4, below(1.0)), (3, above(10.0)), (2, above(7.0))]
FERTILITY_BMI_POINTS = [(2, at_least(35)), (2, below(18.5))]
# The published age rule tests 35 before 40, so the second step never fires.
FERTILITY_AGE_POINTS = [(2, at_least(35)), (4, at_least(40))]
SEVERITY_BANDS = [
    ("no_pcos", span(0, 0)),
    ("mild_pcos", span(1, 4)),
    ("moderate_pcos", span(5, 9)),
    ("severe_pcos", at_least(10)),
]
METABOLIC_BANDS = [("low_risk", span(0, 0)), ("moderate_risk", span(1, 4)), ("high_risk", at_least(5))]
FERTILITY_BANDS = [
    ("low_fertility_risk", span(0, 0)),
    ("moderate_fertility_risk", span(1, 4)),
    ("high_fertility_risk", at_least(5)),
]
TONES = {
    "needs_prompt_evaluation": "concerned_supportive_timely",
    "needs_specialist_evaluation": "informative_encouraging_referral",
    "needs_evaluation": "educational_supportive",
}
FOLLOW_UPS = {
    "needs_prompt_evaluation": "within_2_weeks",
    "needs_specialist_evaluation": "within_1_month",
    "needs_evaluation": "within_3_months",
}


def pcos_core(stg: DataFrame) -> DataFrame:
    age, bmi = F.col("age"), F.col("bmi")
    lh, fsh, amh, androgen = (F.col(c) for c in ("lh_level", "fsh_level", "amh_level", "testosterone_level"))
    ratio = safe_ratio("lh_level", "fsh_level")
    cycle = F.lower("menstrual_cycle_pattern")
    irregular, hyper, polycystic = cycle == "irregular", androgen > 70, amh > 4.0
    rotterdam = [irregular, hyper, polycystic]
    hormonal = [lh > 12.5, ratio >= 2, polycystic, hyper]
    return stg.withColumns(
        {
            "reproductive_age_category": band(age, AGE_BANDS),
            "lh_level_category": band(lh, LH_BANDS),
            "fsh_level_category": band(fsh, FSH_BANDS),
            "lh_fsh_ratio": F.round(ratio, 2),
            "lh_fsh_ratio_category": band(ratio, RATIO_BANDS),
            "amh_level_category": band(amh, AMH_BANDS),
            "ovarian_reserve_status": band(amh, RESERVE_BANDS),
            "testosterone_category": band(androgen, TESTOSTERONE_BANDS),
            "hyperandrogenism_severity": band(androgen, ANDROGEN_BANDS),
            "bmi_category": band(bmi, BMI_CLASSES),
            "menstrual_pattern_clean": vocab(cycle, CYCLE_WORDS),
            **flags_for(
                [
                    (age.between(18, 35), ["in_peak_pcos_age"]),
                    (ratio >= 2, ["has_pcos_lh_fsh_pattern"]),
                    (polycystic, ["has_elevated_amh_pcos"]),
                    (hyper, ["has_hyperandrogenism"]),
                    (bmi >= 30, ["is_obese"]),
                    (bmi >= 25, ["is_overweight_or_obese"]),
                    (irregular, ["has_irregular_cycles"]),
                    (F.col("has_family_history"), ["has_pcos_family_history"]),
                ]
            ),
            "rotterdam_criterion_irregular_cycles": points(irregular),
            "rotterdam_criterion_hyperandrogenism": points(hyper),
            "rotterdam_criterion_pco_morphology": points(polycystic),
            "rotterdam_criteria_count": criteria_count(rotterdam),
            "meets_pcos_rotterdam_criteria": criteria_count(rotterdam) >= 2,
            # A patient with all three criteria is phenotype A; the others drop exactly one.
            "pcos_phenotype": first_match(
                [
                    ("phenotype_a_classic", irregular & hyper & polycystic),
                    ("phenotype_b_anovulatory_hyperandrogenic", irregular & hyper & ~polycystic),
                    ("phenotype_c_ovulatory_hyperandrogenic", (cycle == "regular") & hyper & polycystic),
                    ("phenotype_d_mild_pcos", irregular & ~hyper & polycystic),
                ],
                "no_pcos_phenotype",
            ),
            "hormonal_abnormality_count": criteria_count(hormonal),
            "has_severe_hormonal_imbalance": criteria_count(hormonal) >= 3,
        }
    )


def pcos_risk(core: DataFrame) -> DataFrame:
    age, bmi, amh, androgen = (F.col(c) for c in ("age", "bmi", "amh_level", "testosterone_level"))
    ratio = safe_ratio("lh_level", "fsh_level")
    irregular, hyper = F.col("has_irregular_cycles"), F.col("has_hyperandrogenism")
    meets, criteria = F.col("meets_pcos_rotterdam_criteria"), F.col("rotterdam_criteria_count")
    family, heavy = F.col("has_pcos_family_history"), F.col("is_overweight_or_obese")
    obese = bmi >= 30
    scored = core.withColumns(
        {
            "pcos_severity_score": score(
                points(irregular, 3),
                steps(androgen, TESTOSTERONE_POINTS),
                steps(ratio, RATIO_POINTS),
                steps(amh, AMH_POINTS),
                steps(bmi, SEVERITY_BMI_POINTS),
            ),
            "metabolic_syndrome_risk_score": score(
                steps(bmi, METABOLIC_BMI_POINTS), points(hyper, 2), points(irregular, 2), points(meets, 3)
            ),
            "infertility_risk_score": score(
                points(irregular, 4),
                steps(amh, FERTILITY_AMH_POINTS),
                steps(age, FERTILITY_AGE_POINTS),
                steps(bmi, FERTILITY_BMI_POINTS),
            ),
            "type2_diabetes_risk": first_match(
                [("very_high_risk", meets & obese), ("high_risk", meets | obese), ("moderate_risk", heavy)],
                "average_risk",
            ),
            "cardiovascular_risk_category": first_match(
                [
                    ("very_high_risk", meets & obese & hyper),
                    ("high_risk", meets & (obese | hyper)),
                    ("moderate_risk", meets),
                ],
                "average_risk",
            ),
            "endometrial_cancer_risk": first_match(
                [("elevated_risk", irregular & meets), ("moderate_risk", irregular)], "average_risk"
            ),
            "weight_management_priority": first_match(
                [
                    ("critical_priority", meets & (bmi >= 35)),
                    ("high_priority", meets & obese),
                    ("moderate_priority", meets & (bmi >= 25)),
                    ("recommended", heavy),
                ],
                "not_indicated",
            ),
            "hormonal_treatment_indication": first_match(
                [
                    (
                        "likely_needs_treatment",
                        (meets & irregular)
                        | one_of(
                            "hyperandrogenism_severity", "moderate_hyperandrogenism", "severe_hyperandrogenism"
                        ),
                    ),
                    ("consider_treatment", criteria >= 1),
                ],
                "not_indicated",
            ),
        }
    )
    severity, fertility = F.col("pcos_severity_score"), F.col("infertility_risk_score")
    return scored.withColumns(
        {
            "pcos_severity_category": band(severity, SEVERITY_BANDS, None),
            "metabolic_risk_category": band("metabolic_syndrome_risk_score", METABOLIC_BANDS, None),
            "fertility_risk_category": band(fertility, FERTILITY_BANDS, None),
            "pcos_urgency_level": first_match(
                [
                    ("needs_prompt_evaluation", (severity >= 12) | (androgen > 200)),
                    ("needs_specialist_evaluation", meets),
                    ("needs_evaluation", (criteria == 1) & family),
                    ("routine_monitoring", criteria == 1),
                    ("screening_recommended", family),
                ],
                "routine",
            ),
            "fertility_treatment_priority": first_match(
                [
                    ("high_priority_referral", fertility >= 8),
                    ("consider_fertility_specialist", fertility >= 5),
                    ("fertility_counseling_recommended", irregular & F.col("in_peak_pcos_age")),
                ],
                "routine_fertility_education",
            ),
        }
    )


def pcos_prompts(risk: DataFrame) -> DataFrame:
    age, amh, androgen = F.col("age"), F.col("amh_level"), F.col("testosterone_level")
    irregular, hyper = F.col("has_irregular_cycles"), F.col("has_hyperandrogenism")
    meets, criteria = F.col("meets_pcos_rotterdam_criteria"), F.col("rotterdam_criteria_count")
    family, heavy, obese = F.col("has_pcos_family_history"), F.col("is_overweight_or_obese"), F.col("is_obese")
    severity, metabolic = F.col("pcos_severity_score"), F.col("metabolic_syndrome_risk_score")
    fertility, androgen_level = F.col("infertility_risk_score"), F.col("hyperandrogenism_severity")
    marked = one_of(androgen_level, "moderate_hyperandrogenism", "severe_hyperandrogenism")
    extreme = androgen_level == "severe_hyperandrogenism"
    sugar_prone = one_of("type2_diabetes_risk", "high_risk", "very_high_risk")
    heart_prone = one_of("cardiovascular_risk_category", "high_risk", "very_high_risk")
    urgency, any_criterion = F.col("pcos_urgency_level"), criteria >= 1
    top_sugar = F.col("type2_diabetes_risk") == "very_high_risk"
    flags = flags_for(
        [
            (irregular | any_criterion, ["should_ask_menstrual_details"]),
            (irregular, ["should_ask_cycle_length", "should_ask_missed_periods"]),
            (
                irregular | meets,
                [
                    "should_ask_heavy_bleeding",
                    "should_ask_ovulation_symptoms",
                    "should_ask_anxiety",
                    "should_ask_birth_control",
                    "needs_gynecologist_referral",
                ],
            ),
            (
                (fertility >= 5) | (irregular & F.col("in_peak_pcos_age")),
                ["should_ask_fertility_concerns"],
            ),
            (hyper | meets, ["should_ask_hirsutism", "should_ask_skin_changes"]),
            (hyper | meets | (androgen > 70), ["should_ask_acne"]),
            (hyper | (androgen > 100), ["should_ask_hair_loss"]),
            (extreme | (androgen > 150), ["should_ask_voice_changes"]),
            (meets | heavy, ["should_ask_weight_changes", "should_ask_cravings", "should_ask_physical_activity"]),
            ((meets & obese) | (severity >= 8), ["should_ask_weight_loss_difficulty"]),
            (meets | (metabolic >= 5), ["should_ask_fatigue", "needs_metabolic_screening"]),
            ((meets & obese) | (metabolic >= 6), ["should_ask_skin_darkening"]),
            (sugar_prone | (metabolic >= 7), ["should_ask_diabetes_symptoms"]),
            (meets | obese, ["should_ask_glucose_testing_history", "should_ask_sleep_quality"]),
            (meets | heart_prone, ["should_ask_lipid_testing", "needs_lipid_panel"]),
            (
                (meets & obese) | (F.col("cardiovascular_risk_category") == "very_high_risk"),
                ["should_ask_blood_pressure"],
            ),
            (meets | (severity >= 8), ["should_ask_mood_depression"]),
            (hyper | (obese & meets), ["should_ask_body_image"]),
            ((severity >= 10) | marked, ["should_ask_selfesteem"]),
            (any_criterion, ["should_ask_family_pcos_history", "should_ask_previous_diagnoses"]),
            (meets | sugar_prone, ["should_ask_family_diabetes_history"]),
            (
                meets,
                [
                    "should_ask_family_cardiovascular_history",
                    "should_ask_stress_levels",
                    "should_ask_supplements",
                ],
            ),
            (meets | heavy | (metabolic >= 4), ["should_ask_diet_habits"]),
            (meets | any_criterion, ["should_ask_current_medications"]),
            ((fertility >= 5) | (irregular & (age >= 30)), ["should_ask_fertility_treatments"]),
            (any_criterion & ~meets, ["needs_hormonal_panel_screening"]),
            (any_criterion | (amh > 7), ["needs_pelvic_ultrasound"]),
            (sugar_prone | (meets & obese), ["needs_glucose_tolerance_test"]),
            (
                (severity >= 10) | (androgen > 200) | (meets & (metabolic >= 7)),
                ["needs_endocrinologist_referral"],
            ),
            ((fertility >= 8) | (irregular & (age >= 35)), ["needs_reproductive_endo_referral"]),
            (
                (meets & obese) | one_of("weight_management_priority", "critical_priority", "high_priority"),
                ["needs_nutritionist_referral"],
            ),
            ((severity >= 12) | extreme, ["needs_mental_health_referral"]),
            ((meets & obese & (metabolic >= 7)) | (severity >= 12), ["needs_multidisciplinary_care"]),
        ]
    )
    return risk.withColumns(
        {
            **flags,
            "priority_education_topics": topics(
                [
                    ("pcos_overview_education", meets),
                    ("menstrual_cycle_regulation", irregular),
                    ("hyperandrogenism_management", hyper),
                    ("weight_management_pcos", heavy),
                    ("diabetes_prevention", sugar_prone),
                    ("fertility_in_pcos", fertility >= 5),
                    ("cardiovascular_health", heart_prone),
                    ("metabolic_syndrome_prevention", metabolic >= 5),
                ],
                "hormonal_health_education",
            ),
            "lifestyle_modification_focus": topics(
                [
                    ("nutrition_optimization", heavy),
                    ("regular_exercise", meets),
                    ("sustainable_weight_loss", obese),
                    ("insulin_resistance_management", metabolic >= 5),
                    ("stress_management", meets),
                    ("sleep_hygiene", obese),
                ],
                "healthy_lifestyle_maintenance",
            ),
            "recommended_treatment_modalities": topics(
                [
                    ("hormonal_contraceptives", irregular & meets),
                    ("metformin_consideration", obese & meets),
                    ("antiandrogen_therapy", marked),
                    ("fertility_medications", fertility >= 8),
                    (
                        "medical_weight_management",
                        F.col("weight_management_priority") == "critical_priority",
                    ),
                ],
                "lifestyle_first_approach",
            ),
            "communication_tone": lookup(urgency, TONES, "reassuring_informative"),
            "recommended_followup_timeframe": lookup(urgency, FOLLOW_UPS, "routine_annual"),
            "monitoring_intensity_needed": first_match(
                [
                    ("intensive_monitoring", severity >= 12),
                    ("frequent_monitoring", meets & top_sugar),
                    ("regular_monitoring", meets),
                    ("periodic_monitoring", any_criterion),
                ],
                "routine_screening",
            ),
            "conversation_starting_point": first_match(
                [
                    ("pcos_diagnosis_discussion", meets),
                    ("symptom_assessment", any_criterion),
                    ("risk_screening", family),
                ],
                "hormonal_health_checkup",
            ),
            "primary_clinical_concern": first_match(
                [
                    ("severe_hyperandrogenism", androgen > 200),
                    ("severe_pcos_symptoms", severity >= 12),
                    ("pcos_with_fertility_concerns", meets & (fertility >= 8)),
                    ("pcos_metabolic_complications", meets & top_sugar),
                    ("confirmed_pcos_management", meets),
                    ("possible_pcos_screening", criteria == 1),
                    ("menstrual_irregularity", irregular),
                    ("hyperandrogenic_symptoms", hyper),
                ],
                "hormonal_wellness_checkup",
            ),
            "overall_complexity_level": first_match(
                [
                    ("very_high_complexity", severity >= 12),
                    ("high_complexity", severity >= 8),
                    ("moderate_complexity", meets),
                    ("low_moderate_complexity", any_criterion),
                ],
                "low_complexity",
            ),
        }
    )
