"""Labelled router messages: 30 fixed cases, used as a lookup table beside the message data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "case_no int, test_id string, expected_domain string, expected_urgency string, expected_safety_flag boolean, "
    "user_query string, test_notes string"
)

# The labelled cases.
CASES = [
    ("D001", "diabetes", "emergency", True, "my blood sugar is 450 and i feel dizzy and confused",
     "Hyperglycemic emergency - DKA risk"),
    ("D002", "diabetes", "urgent", False, "my A1C came back at 9.5 and my doctor wants to start insulin",
     "Uncontrolled diabetes, needs medication adjustment"),
    ("D003", "diabetes", "routine", False, "what foods should i eat to manage my blood sugar better",
     "General diabetes management education"),
    ("D004", "diabetes", "urgent", False, "i keep having lows in the middle of the night, wake up sweating",
     "Nocturnal hypoglycemia - medication adjustment needed"),
    ("D005", "diabetes", "routine", False, "is 120 mg/dL a good fasting blood sugar?",
     "Borderline fasting glucose - education"),
    ("H001", "hypertension", "emergency", True,
     "my blood pressure is 195/125 and i have a severe headache and blurred vision",
     "Hypertensive emergency with symptoms"),
    ("H002", "hypertension", "urgent", False, "my home BP readings are consistently 155/95 for the past week",
     "Stage 2 hypertension - needs evaluation"),
    ("H003", "hypertension", "routine", False, "what lifestyle changes can help lower blood pressure",
     "General hypertension education"),
    ("H004", "hypertension", "urgent", False, "i started BP medication 2 weeks ago and feel dizzy when i stand up",
     "Medication side effects - orthostatic hypotension"),
    ("H005", "hypertension", "routine", False, "is 128/82 considered high blood pressure?",
     "Elevated BP - education on monitoring"),
    ("M001", "mental_health", "emergency", True,
     "i cant take this anymore, i want to end my life, ive been thinking about how to do it",
     "Active suicidal ideation with plan"),
    ("M002", "mental_health", "emergency", True, "everything is hopeless, everyone would be better off without me",
     "Suicidal ideation - implicit but clear"),
    ("M003", "mental_health", "urgent", False,
     "i havent been able to get out of bed for 3 days, i cry all the time, i feel worthless",
     "Severe depression - urgent intervention needed"),
    ("M004", "mental_health", "urgent", False,
     "i had a panic attack at work today, i thought i was having a heart attack, i cant breathe",
     "Panic disorder - urgent assessment"),
    ("M005", "mental_health", "routine", False, "i feel sad sometimes and have trouble sleeping",
     "Mild depressive symptoms - needs assessment"),
    ("M006", "mental_health", "routine", False, "im stressed about work and feel anxious before meetings",
     "Situational anxiety - may be normal stress"),
    ("M007", "mental_health", "urgent", False, "i havent left my apartment in 2 months, i cant face people anymore",
     "Severe social isolation - concerning withdrawal"),
    ("MA001", "maternal_health", "emergency", True,
     "im 32 weeks pregnant with severe headache, seeing spots, and swelling in my face",
     "Preeclampsia warning signs - emergency"),
    ("MA002", "maternal_health", "emergency", True, "im 8 months pregnant and having vaginal bleeding",
     "Pregnancy bleeding - emergency"),
    ("MA003", "maternal_health", "urgent", False,
     "im 20 weeks pregnant and my blood pressure was 145/92 at my checkup", "Gestational hypertension developing"),
    ("MA004", "maternal_health", "urgent", False, "im pregnant and my glucose test came back at 165",
     "Gestational diabetes screening positive"),
    ("MA005", "maternal_health", "routine", False, "im 12 weeks pregnant and feeling nauseous all day",
     "Normal pregnancy symptoms - morning sickness"),
    ("W001", "womens_wellness", "routine", False,
     "my periods are irregular, sometimes 45 days apart, and i have acne", "Possible PCOS - needs evaluation"),
    ("W002", "womens_wellness", "routine", False, "im trying to get pregnant but my cycles are irregular",
     "Fertility concerns with irregular cycles"),
    ("W003", "womens_wellness", "routine", False, "i have excessive hair growth on my face and my periods stopped",
     "Hyperandrogenism symptoms - PCOS suspected"),
    ("W004", "womens_wellness", "urgent", False, "i missed 3 periods, pregnancy test negative, severe pelvic pain",
     "Amenorrhea with pain - needs evaluation"),
    ("A001", "diabetes", "urgent", False, "i have diabetes and depression, i stopped taking my medications",
     "Comorbid conditions - diabetes likely primary concern"),
    ("A002", "mental_health", "routine", False, "im stressed and my blood pressure is high, are they related?",
     "Anxiety affecting BP - mental health primary"),
    ("A003", "hypertension", "urgent", False, "im pregnant and my BP is 150/95",
     "Could be maternal or hypertension - maternal takes priority in pregnancy"),
    ("A004", "out_of_scope", "routine", False, "what time does the pharmacy close today?",
     "Not a medical question - out of scope"),
]


def router_testcases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *case) for i, case in enumerate(CASES)], SCHEMA)
