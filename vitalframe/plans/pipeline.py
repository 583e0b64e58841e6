"""Tier chains: silver, core, risk, prompts for each clinical domain."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from vitalframe.operators.silver import SILVER
from vitalframe.plans import diabetes, hypertension, maternal, mental, pcos
from vitalframe.sources import fixtures

TIERS = ("silver", "core", "risk", "prompts")

# Tags of the feature tables, used to select domains the way the published models are grouped.
TAGS = {
    "diabetes": ("features", "lifestyle_diseases"),
    "hypertension": ("features", "lifestyle_diseases", "hypertension"),
    "mental_health": ("features", "mental_health"),
    "maternal": ("features", "womens_wellness", "maternal_health"),
    "pcos": ("features", "womens_wellness", "pcos"),
}


def stages(domain: str, as_of: dt.date) -> list:
    """Functions from silver to prompts, in order."""
    return {
        "diabetes": [diabetes.diabetes_core, diabetes.diabetes_risk, diabetes.diabetes_prompts],
        "hypertension": [
            hypertension.hypertension_core,
            hypertension.hypertension_risk,
            hypertension.hypertension_prompts,
        ],
        "mental_health": [partial(mental.mental_core, as_of=as_of), mental.mental_risk, mental.mental_prompts],
        "maternal": [maternal.maternal_core, maternal.maternal_risk, maternal.maternal_prompts],
        "pcos": [pcos.pcos_core, pcos.pcos_risk, pcos.pcos_prompts],
    }[domain]


def refine(silver: DataFrame, domain: str, upto: str = "prompts", as_of: dt.date | None = None) -> DataFrame:
    """Feature tiers on top of a silver table; extra columns, such as a row id, travel along."""
    depth = TIERS.index(upto)
    if depth:
        for step in stages(domain, as_of or dt.date.today())[:depth]:
            silver = step(silver)
    return silver


def features(bronze: DataFrame, domain: str, upto: str = "prompts", as_of: dt.date | None = None) -> DataFrame:
    """Run one domain's chain on its bronze table up to the named tier."""
    return refine(SILVER[domain][1](bronze), domain, upto, as_of)


def run_pipeline(
    spark: SparkSession, sf_dir: str, domain: str, upto: str = "prompts", as_of: dt.date | None = None
) -> DataFrame:
    """The same chain on the shared test tables."""
    return features(fixtures.view(spark, sf_dir, SILVER[domain][0]), domain, upto, as_of)


def select_domains(*tags: str) -> list[str]:
    """Domains whose feature tables carry every given tag."""
    return [domain for domain, have in TAGS.items() if set(tags) <= set(have)]
