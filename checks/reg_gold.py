"""Gold tables, training text, sampling, aggregation, joins and quality checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from checks.gold_sql import chain, derived_columns, gold_sql
from checks.inputs import load, over
from checks.pair_sql import pair_sql, rows_sql, seeded, view_ctes
from checks.registry import register
from checks.sqltext import lit, pct, with_ctes
from vitalframe.operators import aggregates as ag
from vitalframe.operators import quality as q
from vitalframe.operators import sampling as sp
from vitalframe.operators.conversation import user_profile, without_history
from vitalframe.operators.ranking import ranked
from vitalframe.plans import prompt_texts as txt
from vitalframe.plans import suites
from vitalframe.plans import training_text as tt
from vitalframe.plans.pipeline import refine, run_pipeline, select_domains
from vitalframe.sources import tables
from vitalframe.sources.fixtures import shared
from vitalframe.sources.router_cases import router_testcases

DAY = dt.date(2024, 2, 1)


def gold(spark, sf, domain, upto="prompts"):
    return run_pipeline(spark, sf, domain, upto, DAY)


def numbered(spark, sf, domain):
    return tt.numbered_silver(load(spark, sf, tt.DOMAIN_SOURCE[domain]), domain)


def view(spark, sf, domain):
    return tt.SELECT[domain](refine(numbered(spark, sf, domain), domain, as_of=DAY))


def pairs(spark, sf, domain):
    return tt.PAIRS[domain](view(spark, sf, domain))


def sides(spark, sf, domain):
    """Training and validation patients: the numbered silver table, written once, and nothing built on it yet."""
    written = tables.materialize(numbered(spark, sf, domain), tables.work_path(spark, f"{domain}_numbered"))
    return sp.hash_split(written, "patient_id")


def texts(part, domain, system):
    """Training rows of numbered silver rows, built row by row."""
    return tt.to_training_rows(tt.PAIRS[domain](tt.SELECT[domain](refine(part, domain, as_of=DAY))), system[domain])


def rows(spark, sf, domain):
    """Training and validation rows; each row's texts are built once, on its own side."""
    train, valid = sides(spark, sf, domain)
    return texts(train, domain, txt.TRAIN_SYSTEM), texts(valid, domain, txt.VALIDATION_SYSTEM)


# --- gold tables --------------------------------------------------------------------------------
def _gold(key, domain, upto):
    @register(key, gold_sql(domain, upto))
    def _(spark, sf):
        return gold(spark, sf, domain, upto)


for _i, _d in enumerate(("diabetes", "hypertension", "mental_health", "maternal", "pcos")):
    for _j, _t in enumerate(("core", "risk", "prompts")):
        _gold(f"g{_i * 3 + _j + 1:02d}_{_d}_{_t}", _d, _t)


_PIPE_SQL = " UNION ALL ".join(
    f"SELECT * FROM ({gold_sql(d, 'silver').replace('SELECT * FROM gold', f'''SELECT {lit(d)} AS domain, count(*) AS n FROM gold''')})"
    for d in ("maternal", "pcos")
)


@register("g16_run_pipeline", _PIPE_SQL)
def _(spark, sf):
    parts = [
        gold(spark, sf, d).agg(F.lit(d).alias("domain"), F.count("*").alias("n")) for d in select_domains("womens_wellness")
    ]
    return parts[0].unionAll(parts[1])


# --- training text --------------------------------------------------------------------------------
@register("t01_surrogate_id", with_ctes(view_ctes("hypertension"), "SELECT patient_id, systolic_bp, diastolic_bp FROM view"))
def _(spark, sf):
    return view(spark, sf, "hypertension").select("patient_id", "systolic_bp", "diastolic_bp")


def _view(key, domain):
    @register(key, with_ctes(view_ctes(domain), "SELECT * FROM view"))
    def _(spark, sf):
        return view(spark, sf, domain)


def _pairs(key, domain):
    @register(key, pair_sql(domain, "SELECT * FROM pairs"))
    def _(spark, sf):
        return pairs(spark, sf, domain)


_view("t02_select_hypertension_features", "hypertension")
_view("t03_select_mental_features", "mental_health")
_view("t04_select_diabetes_features", "diabetes")
_pairs("t05_diabetes_pairs", "diabetes")
_pairs("t06_hypertension_pairs", "hypertension")
_pairs("t07_mental_pairs", "mental_health")


@register("t08_training_rows", rows_sql("hypertension", "SELECT 'train' AS part, * FROM train UNION ALL SELECT 'validation', * FROM valid"))
def _(spark, sf):
    train, valid = rows(spark, sf, "hypertension")
    return train.select(F.lit("train").alias("part"), "*").unionAll(valid.select(F.lit("validation"), "*"))


@register(
    "t09_chat_messages",
    pair_sql("diabetes", "SELECT patient_id, condition_type, ground_truth_urgency, to_json(struct_pack(messages := ["
             f"struct_pack(role := 'system', content := {lit(txt.CHAT_SYSTEM['diabetes'])}), "
             "struct_pack(role := 'user', content := user_prompt), "
             "struct_pack(role := 'assistant', content := assistant_response)]))::varchar AS messages FROM pairs"),
)
def _(spark, sf):
    chat = tt.to_chat_messages(pairs(spark, sf, "diabetes"), txt.CHAT_SYSTEM["diabetes"])
    return chat.withColumn("messages", F.to_json("messages"))


@register(
    "t10_apply_template",
    over("conversation_history", "SELECT conversation_id, lead || user_message AS complete_prompt FROM conversation_history, "
         "(VALUES ('Classify: '), ('Grade: ')) AS t(lead)"),
)
def _(spark, sf):
    template = spark.createDataFrame([("Classify: ",), ("Grade: ",)], "system_prompt string")
    talk = load(spark, sf, "conversation_history")
    return tt.apply_template(talk, template, "user_message").select("conversation_id", "complete_prompt")


@register(
    "t11_preview",
    pair_sql("mental_health", "SELECT patient_id, length(user_prompt) AS user_prompt_len, length(assistant_response) AS assistant_response_len, "
             "left(user_prompt, 150) AS user_prompt_preview, left(assistant_response, 200) AS assistant_response_preview FROM pairs"),
)
def _(spark, sf):
    return tt.preview(pairs(spark, sf, "mental_health"), {"user_prompt": 150, "assistant_response": 200}, ["patient_id"])


# --- sampling -------------------------------------------------------------------------------------
@register(
    "p01_hash_split",
    over("model_predictions", "SELECT patient_id, if(concat('0x', substr(md5(patient_id), 1, 8))::ubigint % 10 < 8, 'train', 'validation') AS split "
         "FROM model_predictions"),
)
def _(spark, sf):
    return sp.with_split(load(spark, sf, "model_predictions"), "patient_id").select("patient_id", "split")


_TARGETS = (
    "targets",
    "SELECT ground_truth_urgency, (2 * {n} * count(*) + sum(count(*)) OVER ()) // (2 * sum(count(*)) OVER ()) AS target "
    "FROM train GROUP BY 1",
)


def _sample_sql(domain, n, seed):
    ranked_rows = (
        "numbered",
        f"SELECT *, row_number() OVER (PARTITION BY ground_truth_urgency ORDER BY {seeded(seed)}, patient_id) AS rn FROM train",
    )
    return [(_TARGETS[0], _TARGETS[1].format(n=n)), ranked_rows, (
        "sample", "SELECT numbered.* EXCLUDE (rn) FROM numbered JOIN targets USING (ground_truth_urgency) WHERE rn <= target")]


@register("p02_stratified_sample", rows_sql("hypertension", "SELECT * FROM sample", *_sample_sql("hypertension", 16000, 7)))
def _(spark, sf):
    silver = tables.materialize(numbered(spark, sf, "hypertension"), tables.work_path(spark, "numbered_silver"))

    def train_rows(part):
        train, _ = sp.hash_split(part, "patient_id")
        return texts(train, "hypertension", txt.TRAIN_SYSTEM)

    return sp.sample_before(silver, train_rows, "ground_truth_urgency", 16000, "patient_id", 7)


@register("p03_random_n", rows_sql("hypertension", f"SELECT * FROM valid ORDER BY {seeded(7)}, patient_id LIMIT 3000"))
def _(spark, sf):
    _, valid = sides(spark, sf, "hypertension")
    # ids are drawn before any text is built
    return texts(sp.random_n(valid, 3000, "patient_id", 7), "hypertension", txt.VALIDATION_SYSTEM)


@register("p04_shuffle", over("model_predictions", "SELECT * FROM model_predictions"))
def _(spark, sf):
    return sp.shuffled(load(spark, sf, "model_predictions"), "patient_id", 7)


@register(
    "p05_head_labeled",
    rows_sql("diabetes", "SELECT * FROM valid WHERE ground_truth_urgency IS NOT NULL ORDER BY patient_id LIMIT 200"),
)
def _(spark, sf):
    return sp.head_labeled(rows(spark, sf, "diabetes")[1], "ground_truth_urgency", 200, ["patient_id"])


def _split_sql(parts):
    whole = sum(w for _, w in parts)
    body, upto = "", 0
    for name, w in parts[:-1]:
        upto += w
        body += f"WHEN rn * {whole} <= n * {upto} THEN '{name}' "
    return (
        f"SELECT patient_id, ground_truth_urgency, CASE {body}ELSE '{parts[-1][0]}' END AS split FROM (SELECT *, "
        f"row_number() OVER (PARTITION BY ground_truth_urgency ORDER BY {seeded(3)}, patient_id) AS rn, "
        "count(*) OVER (PARTITION BY ground_truth_urgency) AS n FROM model_predictions)"
    )


def _split(key, parts):
    @register(key, over("model_predictions", _split_sql(parts)))
    def _(spark, sf):
        out = sp.stratified_split(load(spark, sf, "model_predictions"), "ground_truth_urgency", parts, "patient_id", 3)
        return out.select("patient_id", "ground_truth_urgency", "split")


_split("p06_stratified_split_80_20", [("train", 8), ("test", 2)])
_split("p07_stratified_split_70_20_10", [("train", 7), ("validation", 2), ("test", 1)])


@register(
    "p08_class_weights",
    over("model_predictions", "SELECT ground_truth_urgency, n, (sum(n) OVER ())::double / (count(*) OVER () * n)::double AS weight FROM "
         "(SELECT ground_truth_urgency, count(*) AS n FROM model_predictions GROUP BY 1)"),
)
def _(spark, sf):
    return sp.class_weights(load(spark, sf, "model_predictions"), "ground_truth_urgency")


@register(
    "p09_budget_check",
    rows_sql("diabetes", "SELECT 'Training' AS dataset, count(*) AS row_count, 3 * count(*) AS total_steps, "
             "if(3 * count(*) <= 50000, 'under_limit', 'over_limit') AS status FROM sample UNION ALL "
             "SELECT 'Validation', count(*), NULL, 'ok' FROM (SELECT * FROM valid LIMIT 3000)", *_sample_sql("diabetes", 16000, 7)),
)
def _(spark, sf):
    train, valid = rows(spark, sf, "diabetes")
    sample = sp.stratified_sample(train, "ground_truth_urgency", 16000, "patient_id", 7)
    return sp.budget_check([("Training", sample), ("Validation", sp.random_n(valid, 3000, "patient_id", 7))])


# --- aggregation ----------------------------------------------------------------------------------
@register(
    "d01_share_of_total",
    with_ctes(chain("diabetes", "core"), f"SELECT diabetes_stage, n AS count, {pct('n', 'sum(n) OVER ()')} AS percentage FROM "
              "(SELECT diabetes_stage, count(*) AS n FROM gold GROUP BY 1)"),
)
def _(spark, sf):
    return ag.share_of_total(gold(spark, sf, "diabetes", "core"), ["diabetes_stage"])


@register(
    "d02_share_within",
    over("conversation_history", "SELECT routed_to_domain, urgency_level, n AS count_val, "
         f"{pct('n', 'sum(n) OVER (PARTITION BY routed_to_domain)')} AS percentage FROM "
         "(SELECT routed_to_domain, urgency_level, count(*) AS n FROM conversation_history GROUP BY 1, 2)"),
)
def _(spark, sf):
    return ag.share_within(load(spark, sf, "conversation_history"), "routed_to_domain", "urgency_level")


@register(
    "d03_count_if",
    over("uploaded_documents", "SELECT user_id, count(*) AS total, sum((processing_status = 'completed')::int)::bigint AS done, "
         "sum((file_size_bytes > 100000)::int)::bigint AS large FROM uploaded_documents GROUP BY 1"),
)
def _(spark, sf):
    conditions = {"done": F.col("processing_status") == "completed", "large": F.col("file_size_bytes") > 100000}
    return ag.count_if(load(spark, sf, "uploaded_documents"), conditions, ["user_id"])


_LENGTHS = """SELECT round(avg(length(user_prompt)), 0) AS avg_user_chars, min(length(user_prompt)) AS min_user_chars,
 max(length(user_prompt)) AS max_user_chars, round(avg(length(user_prompt)) / 4, 0) AS avg_user_tokens,
 count(*) FILTER (length(user_prompt) > 8192) AS user_exceeds_limit, round(avg(length(assistant_response)), 0) AS avg_assistant_chars,
 min(length(assistant_response)) AS min_assistant_chars, max(length(assistant_response)) AS max_assistant_chars,
 round(avg(length(assistant_response)) / 4, 0) AS avg_assistant_tokens,
 count(*) FILTER (length(assistant_response) > 8192) AS assistant_exceeds_limit,
 round(avg(length(user_prompt) + length(assistant_response)) / 4, 0) AS avg_total_tokens FROM pairs"""
_SHORT = {"user_prompt": "user", "assistant_response": "assistant"}


@register("d04_length_stats", pair_sql("mental_health", _LENGTHS))
def _(spark, sf):
    return ag.length_stats(pairs(spark, sf, "mental_health"), _SHORT)


@register("d05_value_counts", over("conversation_history", "SELECT urgency_level, count(*) AS count FROM conversation_history GROUP BY 1"))
def _(spark, sf):
    return ag.value_counts(load(spark, sf, "conversation_history"), ["urgency_level"])


def _duplicates_sql(column, source):
    return (
        f"SELECT count(*) FILTER (n > 1) AS num_duplicate, sum(n) FILTER (n > 1) AS total_duplicate_records, "
        f"{pct('coalesce(sum(n) FILTER (n > 1), 0)', 'sum(n)')} AS pct_duplicates FROM "
        f"(SELECT {column}, count(*) AS n FROM {source} GROUP BY 1)"
    )


@register("d06_duplicate_report", _duplicates_sql("text", "documents"))
def _(spark, sf):
    return ag.duplicate_report(shared(spark, sf, "documents"), "text")


@register(
    "d07_pct_of",
    with_ctes(chain("mental_health", "risk"), "SELECT count(*) FILTER (needs_suicide_risk_screening) AS matching, count(*) AS total, "
              f"{pct('count(*) FILTER (needs_suicide_risk_screening)', 'count(*)')} AS pct FROM gold"),
)
def _(spark, sf):
    return ag.pct_of(gold(spark, sf, "mental_health", "risk"), F.col("needs_suicide_risk_screening"))


@register(
    "d08_summary",
    over("health_metrics", "SELECT count(*) AS rows, count(DISTINCT user_id) AS users, min(metric_value) AS low, max(metric_value) AS high "
         "FROM health_metrics"),
)
def _(spark, sf):
    return load(spark, sf, "health_metrics").agg(
        F.count("*").alias("rows"), F.countDistinct("user_id").alias("users"), F.min("metric_value").alias("low"),
        F.max("metric_value").alias("high"),
    )


@register(
    "d10_rank_rows",
    over("health_metrics", "SELECT metric_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY measurement_date, metric_id) AS rank "
         "FROM health_metrics"),
)
def _(spark, sf):
    bucket = F.concat_ws("|", F.col("measurement_date").cast("string"), F.left(F.col("metric_id"), F.lit(4)))
    out = ranked(load(spark, sf, "health_metrics"), ["user_id"], ["measurement_date", "metric_id"], bucket)
    return out.select("metric_id", "user_id", "rank")


@register(
    "d11_window_totals",
    over("conversation_history", "SELECT routed_to_domain, urgency_level, n, sum(n) OVER ()::bigint AS everything, "
         "sum(n) OVER (PARTITION BY routed_to_domain)::bigint AS in_domain FROM "
         "(SELECT routed_to_domain, urgency_level, count(*) AS n FROM conversation_history GROUP BY 1, 2)"),
)
def _(spark, sf):
    counts = load(spark, sf, "conversation_history").groupBy("routed_to_domain", "urgency_level").agg(F.count("*").alias("n"))
    return counts.withColumns(
        {"everything": F.sum("n").over(W.partitionBy()), "in_domain": F.sum("n").over(W.partitionBy("routed_to_domain"))}
    )


@register(
    "d12_ordered_output",
    over("conversation_history", "SELECT conversation_id, urgency_level FROM conversation_history "
         "ORDER BY (urgency_level = 'emergency') DESC, conversation_id"),
)
def _(spark, sf):
    talk = load(spark, sf, "conversation_history").select("conversation_id", "urgency_level")
    return talk.orderBy(F.when(F.col("urgency_level") == "emergency", 1).otherwise(2), "conversation_id")


@register(
    "d13_latest_k",
    over("conversation_history", "SELECT user_id, conversation_id, message_timestamp, row_number() OVER (PARTITION BY user_id "
         "ORDER BY message_timestamp DESC, conversation_id DESC) AS recency FROM conversation_history QUALIFY recency <= 3"),
)
def _(spark, sf):
    talk = load(spark, sf, "conversation_history")
    return ag.latest_k(talk, ["user_id"], "message_timestamp", 3, "conversation_id").select(
        "user_id", "conversation_id", "message_timestamp", "recency"
    )


@register(
    "d14_router_testcases",
    over("router_cases", "SELECT c.expected_domain, c.expected_urgency, c.expected_safety_flag, count(*) AS count FROM router_cases c "
         "JOIN events e ON e.event_id % 30 = c.case_no GROUP BY 1, 2, 3"),
)
def _(spark, sf):
    messages = shared(spark, sf, "events").select((F.col("event_id") % 30).cast("int").alias("case_no"))
    joined = messages.join(F.broadcast(router_testcases(spark)), "case_no")
    return ag.value_counts(joined, ["expected_domain", "expected_urgency", "expected_safety_flag"])


@register(
    "d15_stack_models",
    over("model_responses", "SELECT patient_id, model_name, response FROM (UNPIVOT (SELECT patient_id, small_reply AS small, "
         "large_reply AS large FROM model_responses) ON small, large INTO NAME model_name VALUE response)"),
)
def _(spark, sf):
    return ag.stack_columns(
        load(spark, sf, "model_responses"), ["patient_id"], {"small_reply": "small", "large_reply": "large"}, "model_name",
        "response",
    )


_REPORT = """SELECT * FROM (
 SELECT 0 AS line_no, '=== TRAINING DATA QUALITY SUMMARY ===' AS report_section UNION ALL
 SELECT 1, 'Total Training Examples: ' || count(*) FROM pairs UNION ALL
 SELECT 2, 'Avg User Prompt Tokens: ' || round(avg(length(user_prompt)) / 4, 0)::bigint FROM pairs UNION ALL
 SELECT 3, 'Avg Assistant Tokens: ' || round(avg(length(assistant_response)) / 4, 0)::bigint FROM pairs UNION ALL
 """ + " UNION ALL ".join(
    f"SELECT {i}, '{x.capitalize()} Cases: ' || count(*) FILTER (ground_truth_urgency = '{x}') || ' (' || "
    + pct(f"count(*) FILTER (ground_truth_urgency = '{x}')", "count(*)", 1) + " || '%)' FROM pairs"
    for i, x in ((4, "emergency"), (5, "urgent"), (6, "routine"))
) + " UNION ALL SELECT 7, '✅ VALIDATION COMPLETE')"


@register("d16_text_report", pair_sql("hypertension", _REPORT))
def _(spark, sf):
    return q.quality_report(pairs(spark, sf, "hypertension"))


# --- joins ----------------------------------------------------------------------------------------
@register("j01_user_profile", over("users user_medical_profiles", "SELECT u.*, p.* EXCLUDE (user_id) FROM users u LEFT JOIN user_medical_profiles p USING (user_id)"))
def _(spark, sf):
    return user_profile(load(spark, sf, "users"), load(spark, sf, "user_medical_profiles"))


@register(
    "j02_class_target_join",
    over("model_predictions", "SELECT patient_id, target FROM (SELECT *, row_number() OVER (PARTITION BY ground_truth_urgency "
         "ORDER BY patient_id) AS rn FROM model_predictions) JOIN (SELECT ground_truth_urgency, "
         "(2 * 300 * count(*) + sum(count(*)) OVER ()) // (2 * sum(count(*)) OVER ()) AS target FROM model_predictions GROUP BY 1) "
         "USING (ground_truth_urgency) WHERE rn <= target"),
)
def _(spark, sf):
    df = load(spark, sf, "model_predictions")
    placed = ranked(df, ["ground_truth_urgency"], ["patient_id"], F.substring("patient_id", 1, 4), "rn")
    targets = sp.class_targets(df, "ground_truth_urgency", 300).drop("original_count")
    return placed.join(targets, "ground_truth_urgency").filter("rn <= target").select("patient_id", "target")


@register(
    "j03_cross_one_row",
    over("uploaded_documents", "SELECT document_id, file_size_bytes, (SELECT sum(file_size_bytes) FROM uploaded_documents)::bigint AS all_bytes "
         "FROM uploaded_documents"),
)
def _(spark, sf):
    docs = load(spark, sf, "uploaded_documents")
    whole = docs.agg(F.sum("file_size_bytes").alias("all_bytes"))  # one row by construction
    return docs.crossJoin(F.broadcast(whole)).select("document_id", "file_size_bytes", "all_bytes")


@register(
    "j04_without_history",
    over("users conversation_history", "SELECT * FROM users WHERE user_id NOT IN (SELECT user_id FROM conversation_history)"),
)
def _(spark, sf):
    return without_history(load(spark, sf, "users"), load(spark, sf, "conversation_history"))


@register(
    "j05_unmatched_inserts",
    over("users incoming_users", "SELECT user_id, full_name FROM incoming_users i WHERE NOT EXISTS (FROM users u WHERE u.user_id = i.user_id)"),
)
def _(spark, sf):
    return load(spark, sf, "incoming_users").join(load(spark, sf, "users").select("user_id"), "user_id", "left_anti").select(
        "user_id", "full_name"
    )


# --- quality --------------------------------------------------------------------------------------
def _check_sql(kind, column, failures, source):
    return f"SELECT '{kind}' AS \"check\", '{column}' AS \"column\", {failures}::bigint AS failures FROM {source}"


@register("q01_not_null", over("raw_diabetes", _check_sql("not_null", "GENDER", "count(*) - count(gender)", "raw_diabetes")))
def _(spark, sf):
    return q.expect_not_null(load(spark, sf, "raw_diabetes"), "GENDER")


@register(
    "q02_accepted_values",
    over("raw_diabetes", _check_sql("accepted_values", "SMOKING_HISTORY", "count(*) FILTER (smoking_history NOT IN ('never', 'current', 'former'))", "raw_diabetes")),
)
def _(spark, sf):
    return q.expect_in(load(spark, sf, "raw_diabetes"), "SMOKING_HISTORY", ["never", "current", "former"])


@register(
    "q03_unique",
    over("raw_pcos_infertility", _check_sql("unique", "PATIENT_FILE_NO", "count(*) FILTER (n > 1)",
         "(SELECT patient_file_no, count(*) AS n FROM raw_pcos_infertility WHERE patient_file_no IS NOT NULL GROUP BY 1)")),
)
def _(spark, sf):
    return q.expect_unique(load(spark, sf, "raw_pcos_infertility"), "PATIENT_FILE_NO")


def _is_boolean(name):
    starts = ("has_", "is_", "in_", "should_", "needs_", "likely_", "meets_", "consider_", "potential_", "perceived_")
    return name.startswith(starts) or name.endswith("_warning") or name == "gestational_diabetes_risk"


def _suite_sql(domain):
    """One count per declared check over the derived columns."""
    suite = suites.SUITES[domain]
    tested = [c for c in derived_columns(domain) if c not in suite.untested]
    accepted = {}
    for c in tested:
        if c in suite.labels:
            accepted[c] = suite.labels[c]
        elif c in suite.counts:
            accepted[c] = range(suite.counts[c] + 1)
        elif _is_boolean(c):
            accepted[c] = [True, False]
    parts = [
        _check_sql("accepted_values", c, f"count(*) FILTER ({c} NOT IN ({', '.join(lit(v) for v in values)}))", "gold")
        for c, values in accepted.items()
    ]
    parts += [
        _check_sql("not_null", c, f"count(*) FILTER ({c} IS NULL)", "gold") for c in tested if c not in suite.may_be_null
    ]
    return " UNION ALL ".join(parts)


def _suite(key, domain):
    @register(key, with_ctes(chain(domain, "prompts"), _suite_sql(domain)))
    def _(spark, sf):
        table = gold(spark, sf, domain)
        not_null, accepted = suites.suite_for(table, gold(spark, sf, domain, "silver"), domain)
        return q.run_suite(table, not_null, accepted)


for _d in suites.SUITES:
    _suite(f"q04_suite_{_d}", _d)


@register(
    "q05_null_check",
    pair_sql("hypertension", "SELECT 'NULL_CHECK' AS validation_type, count(*) AS total_records, "
             "count(*) FILTER (coalesce(user_prompt, '') = '') AS null_user_prompts, "
             "count(*) FILTER (coalesce(assistant_response, '') = '') AS null_assistant_responses, "
             "count(*) FILTER (ground_truth_urgency IS NULL) AS null_urgency_labels, "
             + pct("count(*) FILTER (coalesce(user_prompt, '') = '')", "count(*)") + " AS pct_null_user, "
             + pct("count(*) FILTER (coalesce(assistant_response, '') = '')", "count(*)") + " AS pct_null_assistant FROM pairs"),
)
def _(spark, sf):
    return q.null_check(pairs(spark, sf, "hypertension"))


@register(
    "q06_length_check",
    pair_sql("hypertension", "SELECT ground_truth_urgency, count(*) AS count, round(avg(length(user_prompt)), 0) AS avg_user_chars, "
             "round(avg(length(user_prompt)) / 4, 0) AS avg_user_tokens, round(avg(length(assistant_response)), 0) AS avg_assistant_chars, "
             "round(avg(length(assistant_response)) / 4, 0) AS avg_assistant_tokens FROM pairs GROUP BY 1"),
)
def _(spark, sf):
    return ag.length_by(pairs(spark, sf, "hypertension"), "ground_truth_urgency", _SHORT)


@register(
    "q07_class_balance",
    pair_sql("mental_health", "SELECT 'CLASS_BALANCE' AS validation_type, ground_truth_urgency, n AS count, "
             f"{pct('n', 'sum(n) OVER ()')} AS percentage, CASE WHEN 20 * n < sum(n) OVER () THEN 'UNDERREPRESENTED' "
             "WHEN 5 * n > 4 * sum(n) OVER () THEN 'OVERREPRESENTED' ELSE 'BALANCED' END AS balance_status FROM "
             "(SELECT ground_truth_urgency, count(*) AS n FROM pairs GROUP BY 1)"),
)
def _(spark, sf):
    return q.class_balance(pairs(spark, sf, "mental_health"), "ground_truth_urgency")


@register(
    "q08_placeholder_check",
    pair_sql("diabetes", "SELECT 'PLACEHOLDER_CHECK' AS validation_type, "
             "count(*) FILTER (regexp_matches(user_prompt, 'null|NULL')) AS contains_null_text, "
             "count(*) FILTER (regexp_matches(assistant_response, 'null|NULL')) AS response_contains_null, "
             "count(*) FILTER (contains(user_prompt, 'undefined')) AS contains_undefined, "
             "count(*) FILTER (contains(assistant_response, '[missing]')) AS contains_missing_flag, "
             "count(*) FILTER (length(user_prompt) < 50) AS suspiciously_short_user, "
             "count(*) FILTER (length(assistant_response) < 100) AS suspiciously_short_assistant FROM pairs"),
)
def _(spark, sf):
    return q.placeholder_check(pairs(spark, sf, "diabetes"))


@register(
    "q09_duplicate_check",
    pair_sql("diabetes", "SELECT 'DUPLICATE_CHECK' AS validation_type, num_duplicate AS num_duplicate_prompts, total_duplicate_records, "
             f"pct_duplicates FROM ({_duplicates_sql('user_prompt', 'pairs')})"),
)
def _(spark, sf):
    return q.duplicate_check(pairs(spark, sf, "diabetes"))


@register(
    "q10_coverage_check",
    pair_sql("diabetes", "SELECT 'COMPONENT_COVERAGE' AS validation_type, count(*) AS total_records, "
             + ", ".join(f"count(*) FILTER (length({c}) > {n}) AS {a}" for c, (a, n) in {
                 "patient_context": ("has_patient_context", 10), "clinical_presentation": ("has_clinical_presentation", 20),
                 "comorbidities": ("has_comorbidities", 10), "risk_assessment": ("has_risk_assessment", 20),
                 "symptom_inquiry": ("has_symptom_inquiry", 20), "management_recommendations": ("has_management_recs", 20),
                 "education_guidance": ("has_education", 10), "triage_recommendation": ("has_triage", 20)}.items())
             + " FROM pairs"),
)
def _(spark, sf):
    return q.coverage_check(pairs(spark, sf, "diabetes"))


@register(
    "q11_label_consistency",
    pair_sql("hypertension", "SELECT ground_truth_urgency, count(*) AS total, "
             "count(*) FILTER (contains(assistant_response, 'EMERGENCY')) AS contains_emergency_keyword, "
             "count(*) FILTER (contains(assistant_response, 'URGENT')) AS contains_urgent_keyword, "
             "count(*) FILTER (contains(assistant_response, 'ROUTINE')) AS contains_routine_keyword, "
             + pct("count(*) FILTER (ground_truth_urgency IN ('emergency', 'urgent', 'routine') "
                   "AND contains(assistant_response, upper(ground_truth_urgency)))", "count(*)")
             + " AS consistency_percentage FROM pairs GROUP BY 1"),
)
def _(spark, sf):
    return q.label_consistency(pairs(spark, sf, "hypertension"))


@register("q12_quality_report", pair_sql("diabetes", _REPORT))
def _(spark, sf):
    return q.quality_report(pairs(spark, sf, "diabetes"))


def _dataset_sql(name, source):
    return (
        f"SELECT '{name}' AS dataset, count(*) AS total_rows, count(completion) AS has_completion, "
        "count(*) FILTER (completion IS NULL) AS null_count, count(*) FILTER (coalesce(completion, '') = '') AS empty_count, "
        f"min(length(completion)) AS min_length, avg(length(completion)) AS avg_length FROM {source}"
    )


@register("q13_dataset_check", rows_sql("mental_health", _dataset_sql("Training", "train") + " UNION ALL " + _dataset_sql("Validation", "valid")))
def _(spark, sf):
    train, valid = rows(spark, sf, "mental_health")
    return q.dataset_check([("Training", train), ("Validation", valid)])


@register(
    "q14_key_integrity",
    over("users user_medical_profiles conversation_history",
         _check_sql("unique", "user_id", "count(*) FILTER (n > 1)", "(SELECT user_id, count(*) AS n FROM users GROUP BY 1)") + " UNION ALL "
         + _check_sql("foreign_key", "user_id", "count(*)", "user_medical_profiles WHERE user_id NOT IN (SELECT user_id FROM users)") + " UNION ALL "
         + _check_sql("foreign_key", "user_id", "count(*)", "conversation_history WHERE user_id NOT IN (SELECT user_id FROM users)")),
)
def _(spark, sf):
    users = load(spark, sf, "users")
    checks = [
        q.expect_unique(users, "user_id"),
        q.expect_fk(load(spark, sf, "user_medical_profiles"), users, "user_id"),
        q.expect_fk(load(spark, sf, "conversation_history"), users, "user_id"),
    ]
    return checks[0].unionAll(checks[1]).unionAll(checks[2])

