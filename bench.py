"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (cores), BENCH_RUNS (timed runs, the best counts).
"""

from __future__ import annotations

import importlib.util
import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from vitalframe.session import build_session  # noqa: E402

HEADLINE = [
    "b11_stg_diabetes",
    "b12_stg_blood_pressure",
    "g03_diabetes_prompts",
    "g06_hypertension_prompts",
    "g09_mental_health_prompts",
    "g12_maternal_prompts",
    "g15_pcos_prompts",
    "t01_surrogate_id",
    "t06_hypertension_pairs",
    "p02_stratified_sample",
    "d01_share_of_total",
    "d06_duplicate_report",
    "q04_suite_hypertension",
    "e03_confusion",
    "e09_router_accuracy",
    "e13_judge_ranking",
    "a07_merge_upsert",
    "k01_triage_documents",
    "k04_extract_metrics",
    "k07_metric_trends",
    "k09_similar_by_embedding",
    "k09_similar_by_text",
    "k10_keyword_fallback",
    "k14_build_context",
    "k15_session_transcripts",
    "s02_stream_triage",
]


def registered():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module.queries()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = sys.argv[1:]
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    queries = registered()
    times = {}
    for name in HEADLINE:
        if only and not any(name.startswith(o) for o in only):
            continue
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
