"""Mental-health survey features in three tiers."""

from __future__ import annotations

import datetime as dt

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
    score,
    span,
    steps,
    topics,
    vocab,
    years_since,
)

# Word lists, labels, points and cut points.
AGE_BANDS = [
    ("adolescent", below(18)),
    ("young_adult", span(18, 25)),
    ("adult", span(26, 40)),
    ("middle_age", span(41, 60)),
    ("senior", above(60)),
]
HISTORY_WORDS = {"documented_history": ["yes"], "no_history": ["no"], "possible_history": ["maybe"]}
MOOD_WORDS = {"severe": ["high"], "moderate": ["medium"], "mild": ["low"]}
STRESS_WORDS = {"significant_stress": ["yes"], "possible_stress": ["maybe"], "no_stress": ["no"]}
SOCIAL_WORDS = {"social_impairment": ["yes"], "social_difficulty": ["maybe"], "intact_social_function": ["no"]}
WORK_WORDS = {"anhedonia_work": ["no"], "reduced_motivation": ["maybe"], "maintained_interest": ["yes"]}
HABIT_WORDS = {"significant_changes": ["yes"], "some_changes": ["maybe"], "stable_habits": ["no"]}
OUTDOOR_WORDS = ["go out every day", "go out everyday"]
ISOLATION_WORDS = {
    "no_isolation": OUTDOOR_WORDS,
    "mild_isolation": ["1-14 days"],
    "moderate_isolation": ["15-30 days"],
    "severe_isolation": ["31-60 days", "more than 2 months"],
}
ISOLATION_SCORES = {0: OUTDOOR_WORDS, 1: ["1-14 days"], 2: ["15-30 days"], 3: ["31-60 days"], 4: ["more than 2 months"]}
CARE_WORDS = {"aware_of_options": ["yes"], "uncertain_about_care": ["not sure"], "unaware_of_options": ["no"]}
OCCUPATION_WORDS = {
    "student": ["student"],
    "professional": ["corporate", "business"],
    "homemaker": ["housewife"],
    "other": ["others"],
}
COMFORT_WORDS = {
    "comfortable_discussing": ["yes"],
    "somewhat_comfortable": ["maybe"],
    "uncomfortable_discussing": ["no"],
}
GENDER_WORDS = {"male": ["male", "m"], "female": ["female", "f"]}
WORK_POINTS = {"no": 3, "maybe": 2}
MOOD_POINTS = {"high": 3, "medium": 2, "low": 1}
HABIT_POINTS = {"yes": 2, "maybe": 1}
STRESS_POINTS = {"yes": 3, "maybe": 2}
SOCIAL_POINTS = {"yes": 3, "maybe": 2}
ISOLATION_POINTS = [(3, at_least(3)), (2, span(2, 2)), (1, span(1, 1))]
ISOLATION_LEVEL_POINTS = {"severe_isolation": 3, "moderate_isolation": 2, "mild_isolation": 1}
DEPRESSION_BANDS = [
    ("minimal_depression", span(0, 0)),
    ("mild_depression", span(1, 4)),
    ("moderate_depression", span(5, 9)),
    ("moderately_severe_depression", span(10, 14)),
    ("severe_depression", at_least(15)),
]
ANXIETY_BANDS = [
    ("minimal_anxiety", span(0, 0)),
    ("mild_anxiety", span(1, 4)),
    ("moderate_anxiety", span(5, 9)),
    ("severe_anxiety", at_least(10)),
]
IMPAIRMENT_BANDS = [
    ("no_impairment", span(0, 0)),
    ("mild_impairment", span(1, 3)),
    ("moderate_impairment", span(4, 6)),
    ("severe_impairment", at_least(7)),
]
COMPLEXITY_BANDS = [
    ("complex_multidisciplinary", at_least(4)),
    ("moderate_coordinated_care", span(3, 3)),
    ("standard_single_provider", span(1, 2)),
]
TONES = {
    "emergency": "urgent_compassionate_immediate",
    "urgent": "serious_supportive_prompt",
    "needs_attention": "concerned_encouraging",
    "routine": "supportive_informative",
}
FOLLOW_UPS = {
    "emergency": "immediate_within_24hrs",
    "urgent": "within_1_week",
    "needs_attention": "within_2_weeks",
    "routine": "within_1_month",
}


def mental_core(stg: DataFrame, as_of: dt.date) -> DataFrame:
    age = years_since("survey_timestamp", as_of)
    history, interview = F.lower("mental_health_history"), F.lower("mental_health_interview")
    mood, stress, social = F.lower("mood_swings"), F.lower("growing_stress"), F.lower("social_weakness")
    work, habits, indoors = F.lower("work_interest"), F.lower("changes_habits"), F.lower("days_indoors")
    job = F.lower("occupation")
    family, coping = F.col("has_family_history"), F.col("has_coping_struggles")
    treated = F.col("receiving_treatment")
    documented, withdrawn, listless = history == "yes", social == "yes", work == "no"
    return stg.withColumns(
        {
            "calculated_age": age,
            "age_category": band(age, AGE_BANDS),
            "mental_health_history_clean": vocab(history, HISTORY_WORDS),
            "has_mental_health_history": flag(documented),
            "has_family_mental_health_history": flag(family),
            "genetic_history_risk": first_match(
                [
                    ("high_genetic_risk", documented & family),
                    ("moderate_risk", documented | family),
                    ("possible_risk", history == "maybe"),
                ],
                "low_risk",
            ),
            "mood_swing_severity": vocab(mood, MOOD_WORDS, "none_reported"),
            "stress_level": vocab(stress, STRESS_WORDS),
            "has_coping_difficulties": flag(coping),
            "social_functioning_status": vocab(social, SOCIAL_WORDS),
            "work_motivation_status": vocab(work, WORK_WORDS),
            "behavioral_change_status": vocab(habits, HABIT_WORDS),
            "social_isolation_level": vocab(indoors, ISOLATION_WORDS),
            "isolation_severity_score": vocab(indoors, ISOLATION_SCORES, None),
            "in_active_treatment": flag(treated),
            "care_awareness_status": vocab("care_options", CARE_WORDS),
            "has_treatment_gap": flag(~treated & documented),
            "occupation_category": vocab(job, OCCUPATION_WORDS),
            "employment_status": first_match(
                [
                    ("self_employed", F.col("is_self_employed")),
                    ("student", job == "student"),
                    ("homemaker", job == "housewife"),
                ],
                "employed",
            ),
            "mental_health_disclosure_comfort": vocab(interview, COMFORT_WORDS),
            "perceived_workplace_stigma": flag(interview == "no"),
            "symptom_count": criteria_count(
                [
                    mood.isin("medium", "high"),
                    stress == "yes",
                    coping,
                    withdrawn,
                    listless,
                    habits == "yes",
                    ~indoors.isin(OUTDOOR_WORDS),
                ]
            ),
            "severe_symptom_count": criteria_count(
                [mood == "high", coping, withdrawn, listless, indoors.isin(ISOLATION_WORDS["severe_isolation"])]
            ),
            "gender_clean": vocab("gender", GENDER_WORDS, "other"),
        }
    )


def mental_risk(core: DataFrame) -> DataFrame:
    mood = F.lower("mood_swings")
    coping, treated = F.col("has_coping_struggles"), F.col("in_active_treatment")
    isolation, severe = F.col("isolation_severity_score"), F.col("severe_symptom_count")
    work_points = lookup(F.lower("work_interest"), WORK_POINTS, 0)
    habit_points = lookup(F.lower("changes_habits"), HABIT_POINTS, 0)
    scored = core.withColumns(
        {
            "depression_risk_score": score(
                work_points,
                lookup(mood, MOOD_POINTS, 0),
                steps(isolation, ISOLATION_POINTS),
                habit_points,
                points(coping, 3),
            ),
            "anxiety_risk_score": score(
                lookup(F.lower("growing_stress"), STRESS_POINTS, 0),
                points(coping, 3),
                lookup(F.lower("social_weakness"), SOCIAL_POINTS, 0),
                points(mood.isin("medium", "high"), 2),
            ),
            "functional_impairment_score": score(
                work_points,
                lookup("social_isolation_level", ISOLATION_LEVEL_POINTS, 0),
                habit_points,
                points(coping, 2),
            ),
        }
    )
    low, worry, impairment = (
        F.col(c) for c in ("depression_risk_score", "anxiety_risk_score", "functional_impairment_score")
    )
    gap = F.col("has_treatment_gap")
    either_10, either_5 = (low >= 10) | (worry >= 10), (low >= 5) | (worry >= 5)
    cut_off = (severe >= 4) & (isolation >= 3)
    return scored.withColumns(
        {
            "depression_severity": band(low, DEPRESSION_BANDS, None),
            "anxiety_severity": band(worry, ANXIETY_BANDS, None),
            "functional_impairment_category": band(impairment, IMPAIRMENT_BANDS, None),
            "mental_health_urgency_level": first_match(
                [
                    ("emergency", cut_off & ~treated),
                    ("urgent", either_10 & ~treated),
                    ("needs_attention", low.between(5, 9) | worry.between(5, 9) | gap),
                    ("routine", F.col("symptom_count") >= 2),
                ],
                "monitoring",
            ),
            "therapy_priority": first_match(
                [
                    ("high_priority", either_10),
                    ("moderate_priority", either_5),
                    ("low_priority", F.col("symptom_count") >= 3),
                ],
                "preventive",
            ),
            "medication_evaluation_priority": first_match(
                [
                    ("psychiatric_evaluation_urgent", low >= 15),
                    ("psychiatric_evaluation_needed", either_10),
                    ("consider_evaluation", either_5),
                ],
                "not_indicated",
            ),
            "needs_suicide_risk_screening": flag(cut_off | (low >= 15)),
            "has_comorbid_depression_anxiety": flag((low >= 5) & (worry >= 5)),
            "case_complexity_score": criteria_count(
                [
                    F.col("has_mental_health_history"),
                    F.col("has_family_history"),
                    gap,
                    impairment >= 7,
                    F.col("perceived_workplace_stigma"),
                ]
            ),
        }
    )


def mental_prompts(risk: DataFrame) -> DataFrame:
    low, worry = F.col("depression_risk_score"), F.col("anxiety_risk_score")
    symptoms, severe = F.col("symptom_count"), F.col("severe_symptom_count")
    isolation, level = F.col("isolation_severity_score"), F.col("social_isolation_level")
    impairment, impaired = F.col("functional_impairment_score"), F.col("functional_impairment_category")
    work, habits, mood = F.lower("work_interest"), F.lower("changes_habits"), F.lower("mood_swings")
    social, urgency = F.lower("social_weakness"), F.col("mental_health_urgency_level")
    coping, history = F.col("has_coping_struggles"), F.col("has_mental_health_history")
    treated, gap, stigma = F.col("in_active_treatment"), F.col("has_treatment_gap"), F.col("perceived_workplace_stigma")
    screening, comorbid = F.col("needs_suicide_risk_screening"), F.col("has_comorbid_depression_anxiety")
    depressed, anxious = low >= 5, worry >= 5
    listless, unsettled, withdrawn = work == "no", habits == "yes", social == "yes"
    deep = one_of("depression_severity", "moderately_severe_depression", "severe_depression")
    severe_depression = F.col("depression_severity") == "severe_depression"
    moderate_up = deep | (F.col("depression_severity") == "moderate_depression")
    anxiety_up = one_of("anxiety_severity", "moderate_anxiety", "severe_anxiety")
    isolated = one_of(level, "moderate_isolation", "severe_isolation")
    stressed = F.col("stress_level") == "significant_stress"
    unaware = F.col("care_awareness_status") == "unaware_of_options"
    untreated_load = ~treated & (symptoms >= 3)
    working_age = one_of("occupation_category", "professional", "student")
    impaired_day = one_of(impaired, "moderate_impairment", "severe_impairment")
    wants_therapy = one_of("therapy_priority", "high_priority", "moderate_priority")
    flags = flags_for(
        [
            (moderate_up | depressed, ["should_ask_depressive_symptoms"]),
            (anxiety_up | anxious, ["should_ask_anxiety_symptoms"]),
            (depressed | anxious | unsettled, ["should_ask_sleep_patterns"]),
            (depressed | unsettled, ["should_ask_appetite_changes"]),
            (work.isin("no", "maybe") | depressed | anxious, ["should_ask_concentration"]),
            (listless | depressed | (isolation >= 2), ["should_ask_energy_levels"]),
            (screening | severe_depression | (severe >= 4), ["should_screen_suicidal_ideation"]),
            (deep | (history & coping), ["should_assess_selfharm_history"]),
            (screening | (low >= 15), ["should_evaluate_safety_plan"]),
            (isolated | withdrawn | (symptoms >= 3), ["should_ask_social_support"]),
            (
                social.isin("yes", "maybe") | ~one_of(level, "no_isolation", "unknown"),
                ["should_ask_relationships"],
            ),
            (
                F.col("has_family_history") | one_of("age_category", "adolescent", "young_adult"),
                ["should_ask_family_dynamics"],
            ),
            (work.isin("no", "maybe") | (impairment >= 4), ["should_ask_work_functioning"]),
            (unsettled | impaired_day, ["should_ask_daily_activities"]),
            (listless | depressed, ["should_ask_motivation", "should_ask_hobbies_interests"]),
            ((isolation >= 1) | depressed, ["should_ask_physical_activity"]),
            (coping | moderate_up | anxiety_up, ["should_ask_substance_use"]),
            (coping | stressed | (symptoms >= 3), ["should_ask_coping_strategies"]),
            (history | gap, ["should_ask_past_treatment"]),
            (treated | history, ["should_ask_current_medications"]),
            (treated | history | wants_therapy, ["should_ask_therapy_experience"]),
            (treated, ["should_ask_medication_sideeffects", "should_ask_treatment_satisfaction"]),
            (
                one_of("care_awareness_status", "uncertain_about_care", "unaware_of_options") | gap,
                ["should_ask_care_access"],
            ),
            (untreated_load | unaware, ["should_ask_financial_barriers"]),
            (
                stigma
                | (F.col("mental_health_disclosure_comfort") == "uncomfortable_discussing")
                | untreated_load,
                ["should_ask_stigma_concerns"],
            ),
            (~treated & working_age, ["should_ask_scheduling_barriers"]),
            (anxiety_up | ((mood == "high") & anxious), ["should_explore_panic_symptoms"]),
            (withdrawn | (anxious & (level != "no_isolation")), ["should_explore_social_anxiety"]),
            ((severe >= 3) | (history & coping), ["should_explore_trauma_history"]),
            ((mood == "high") | history, ["should_explore_mood_episodes"]),
            ((urgency == "emergency") | (screening & ~treated), ["needs_crisis_referral"]),
            (
                one_of(
                    "medication_evaluation_priority",
                    "psychiatric_evaluation_urgent",
                    "psychiatric_evaluation_needed",
                )
                | (severe_depression & ~treated),
                ["needs_psychiatrist_referral"],
            ),
            ((wants_therapy & ~treated) | gap, ["needs_therapist_referral"]),
            (isolated | withdrawn, ["needs_support_group_referral"]),
            (impaired_day | (listless & working_age), ["needs_workplace_accommodation"]),
        ]
    )
    return risk.withColumns(
        {
            **flags,
            "priority_education_topics": topics(
                [
                    ("depression_psychoeducation", depressed),
                    ("anxiety_management", anxious),
                    ("stress_reduction_techniques", stressed),
                    ("coping_skills_training", coping),
                    ("social_connection_strategies", level != "no_isolation"),
                    ("behavioral_activation", listless),
                    ("daily_functioning_skills", impairment >= 4),
                    ("mental_health_stigma_education", stigma),
                    ("treatment_options_overview", unaware),
                    ("when_to_seek_help", untreated_load),
                ]
            ),
            "selfcare_focus_areas": topics(
                [
                    ("physical_activity", isolation >= 1),
                    ("sleep_hygiene", depressed),
                    ("relaxation_techniques", stressed),
                    ("social_engagement", level != "no_isolation"),
                    ("routine_establishment", unsettled),
                    ("pleasurable_activities", listless),
                ]
            ),
            "recommended_therapy_modalities": topics(
                [
                    ("CBT_for_depression", low >= 10),
                    ("CBT_for_anxiety", worry >= 10),
                    ("interpersonal_therapy", isolated),
                    ("DBT_skills", coping),
                    ("mindfulness_based_therapy", stressed),
                    ("integrated_treatment", comorbid),
                ]
            ),
            "communication_tone": lookup(urgency, TONES, "positive_preventive"),
            "recommended_followup_timeframe": lookup(urgency, FOLLOW_UPS, "as_needed"),
            "treatment_plan_complexity": band("case_complexity_score", COMPLEXITY_BANDS, "basic_self_help"),
            "monitoring_intensity_needed": first_match(
                [
                    ("intensive_monitoring", screening),
                    ("frequent_monitoring", urgency.isin("emergency", "urgent")),
                    ("regular_monitoring", (low >= 10) | (worry >= 10)),
                    ("periodic_monitoring", symptoms >= 2),
                ],
                "self_monitoring",
            ),
            "conversation_starting_point": first_match(
                [
                    ("safety_assessment", screening),
                    ("crisis_intervention", urgency == "emergency"),
                    ("treatment_review", treated),
                    ("history_exploration", history),
                ],
                "symptom_screening",
            ),
            "primary_clinical_concern": first_match(
                [
                    ("immediate_safety", screening),
                    ("severe_depression", (low > worry) & (low >= 10)),
                    ("severe_anxiety", (worry > low) & (worry >= 10)),
                    ("comorbid_conditions", comorbid),
                    ("functional_decline", impaired == "severe_impairment"),
                    ("treatment_discontinuation", gap),
                    ("social_withdrawal", level == "severe_isolation"),
                ],
                "symptom_management",
            ),
        }
    )
