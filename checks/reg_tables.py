"""Sources, sinks, table maintenance, cleaning and rule primitives."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.gold_sql import RAW_VIEW, SILVER_SQL, gold_sql
from checks.inputs import load, over
from checks.pair_sql import pair_sql
from checks.registry import register
from checks.sqltext import bands, half_up, listed, lit, one, pick, total, words, yes
from vitalframe.functions import rules as r
from vitalframe.functions.text import like_any
from vitalframe.operators import cleaning as cl
from vitalframe.operators import learning, silver
from vitalframe.operators.aggregates import value_counts
from vitalframe.operators.conversation import saved_readings, searchable
from vitalframe.plans import diabetes as dm
from vitalframe.plans import hypertension as htn
from vitalframe.plans import mental as mh
from vitalframe.plans.pipeline import run_pipeline
from vitalframe.plans.prompt_texts import TRAIN_SYSTEM
from vitalframe.plans.training_text import to_training_rows, training_pairs
from vitalframe.sources import tables
from vitalframe.sources.schemas import APP, APP_DEFAULTS, BRONZE

DAY = dt.date(2024, 2, 1)
RAW_MATERNAL = "SELECT * FROM raw_maternalhealth"


@register("a01_read_source", over("raw_maternalhealth", RAW_MATERNAL))
def _(spark, sf):
    base = tables.work_path(spark, "bronze")
    load(spark, sf, "raw_maternalhealth").write.parquet(f"{base}/raw_maternalhealth.parquet")
    return tables.read_source(spark, "raw_maternalhealth", base)


@register(
    "a02_read_labeled_csv",
    over("raw_diabetes", "SELECT smoking_history AS SMOKING_HISTORY, count(*) AS count FROM raw_diabetes "
         "WHERE smoking_history IS NOT NULL GROUP BY 1"),
)
def _(spark, sf):
    path = tables.work_path(spark, "csv")
    load(spark, sf, "raw_diabetes").write.option("header", True).csv(path)
    return value_counts(tables.read_labeled_csv(spark, path, "SMOKING_HISTORY", BRONZE["raw_diabetes"]), ["SMOKING_HISTORY"])


@register("a03_materialize", gold_sql("pcos", "silver"))
def _(spark, sf):
    return tables.materialize(run_pipeline(spark, sf, "pcos", "silver"), tables.work_path(spark, "stg_pcos"))


@register(
    "a04_register_view",
    over("conversation_history", "SELECT routed_to_domain, conversation_date, count(*) AS n FROM (SELECT *, "
         "message_timestamp::date AS conversation_date FROM conversation_history) GROUP BY 1, 2"),
)
def _(spark, sf):
    view = tables.register_view(searchable(load(spark, sf, "conversation_history")), "searchable_conversations")
    return view.groupBy("routed_to_domain", "conversation_date").agg(F.count("*").alias("n"))


@register(
    "a05_with_defaults",
    over("users", "SELECT user_id, email, full_name, date_of_birth, gender, account_status, NULL::varchar AS phone_number, "
         "0 AS failed_login_attempts, false AS email_verified, false AS terms_accepted, false AS privacy_consent FROM users"),
)
def _(spark, sf):
    typed = tables.with_defaults(load(spark, sf, "users"), APP["users"], APP_DEFAULTS["users"])
    return typed.select(
        "user_id", "email", "full_name", "date_of_birth", "gender", "account_status", "phone_number",
        "failed_login_attempts", "email_verified", "terms_accepted", "privacy_consent",
    )


READINGS_SQL = r"""SELECT conversation_id, user_id, metric_type, metric_value, metric_unit FROM (
 SELECT DISTINCT conversation_id, user_id, metric_type, metric_value, metric_unit FROM (
  SELECT conversation_id, user_id, unnest([struct_pack(k := 'blood_pressure_systolic', v := s, u := 'mmHg'),
    struct_pack(k := 'blood_pressure_diastolic', v := d, u := 'mmHg')], recursive := true) FROM (
   SELECT conversation_id, user_id, unnest(regexp_extract_all(txt, '(\d{2,3})\s*/\s*(\d{2,3})', 1))::double AS s,
    unnest(regexp_extract_all(txt, '(\d{2,3})\s*/\s*(\d{2,3})', 2))::double AS d FROM msg) WHERE s BETWEEN 70 AND 250 AND d BETWEEN 40 AND 150
  UNION ALL
  SELECT conversation_id, user_id, 'blood_sugar', v, 'mg/dL' FROM (
   SELECT conversation_id, user_id, unnest(list_concat(list_concat(regexp_extract_all(low, 'blood\s+sugar[:\s]+(\d{2,3})', 1),
     regexp_extract_all(low, 'glucose[:\s]+(\d{2,3})', 1)), list_concat(regexp_extract_all(low, '\bbs[:\s]+(\d{2,3})', 1),
     regexp_extract_all(low, 'sugar\s+level[:\s]+(\d{2,3})', 1))))::double AS v FROM msg) WHERE v BETWEEN 40 AND 600
  UNION ALL
  SELECT conversation_id, user_id, 'hba1c', v, '%' FROM (
   SELECT conversation_id, user_id, unnest(regexp_extract_all(low, '(?:hba1c|a1c)[:\s]+(\d+\.?\d*)', 1))::double AS v FROM msg) WHERE v BETWEEN 3 AND 20
 ) x(conversation_id, user_id, metric_type, metric_value, metric_unit))"""
MESSAGES_CTE = (
    "msg",
    "SELECT *, txt_ AS txt, lower(txt_) AS low FROM (SELECT *, user_message || ' ' || assistant_response AS txt_ "
    "FROM conversation_history WHERE routed_to_domain IN ('LIFESTYLE_DISEASES', 'WOMEN_WELLNESS'))",
)


@register(
    "a06_append_rows",
    over("conversation_history health_metrics",
         "SELECT metric_id, user_id, metric_type, metric_value, measurement_date, NULL AS conversation_id, NULL AS metric_unit, NULL AS reported_date, "
         "NULL AS source, NULL AS confidence_score FROM health_metrics UNION ALL "
         "SELECT md5(conversation_id || '|' || metric_type || '|' || metric_value::varchar), user_id, metric_type, metric_value, "
         "message_timestamp::date, conversation_id, metric_unit, message_timestamp, 'conversation_extracted', 0.95::double "
         "FROM readings JOIN conversation_history USING (conversation_id, user_id)", MESSAGES_CTE, ("readings", READINGS_SQL)),
)
def _(spark, sf):
    fresh = saved_readings(load(spark, sf, "conversation_history")).drop("is_abnormal", "severity")
    return tables.append_rows(load(spark, sf, "health_metrics"), fresh)


@register(
    "a07_merge_upsert",
    over("users incoming_users",
         "SELECT u.user_id, coalesce(n.full_name, u.full_name) AS full_name, coalesce(n.email, u.email) AS email, "
         "u.date_of_birth, u.gender, u.account_status FROM users u LEFT JOIN incoming_users n USING (user_id) UNION ALL "
         "SELECT user_id, full_name, email, NULL, NULL, account_status FROM incoming_users "
         "WHERE user_id NOT IN (SELECT user_id FROM users)"),
)
def _(spark, sf):
    return tables.merge_upsert(
        load(spark, sf, "users"), load(spark, sf, "incoming_users"), "user_id", ["full_name", "email"],
        ["user_id", "full_name", "email", "account_status"],
    )


@register(
    "a08_patch_rows",
    over("stamped_profiles profile_patches",
         "SELECT s.* REPLACE (coalesce(p.weight_kg, s.weight_kg) AS weight_kg, coalesce(p.has_diabetes, s.has_diabetes) AS has_diabetes, "
         "if(p.gender = 'Female' AND p.is_pregnant IS NOT NULL, p.is_pregnant, s.is_pregnant) AS is_pregnant, "
         "if(p.user_id IS NULL, s.last_updated, DATE '2024-02-01') AS last_updated) "
         "FROM stamped_profiles s LEFT JOIN profile_patches p USING (user_id)"),
)
def _(spark, sf):
    return tables.patch_rows(
        load(spark, sf, "stamped_profiles"), load(spark, sf, "profile_patches"), "user_id", F.lit(DAY), "gender"
    )


@register(
    "a09_delete_where",
    over("uploaded_documents", "SELECT * FROM uploaded_documents WHERE NOT (user_id = 'u7' AND processing_status = 'failed')"),
)
def _(spark, sf):
    docs = load(spark, sf, "uploaded_documents")
    return tables.delete_where(docs, (F.col("user_id") == "u7") & (F.col("processing_status") == "failed"))


@register(
    "a10_evolve",
    over("uploaded_documents", "SELECT * REPLACE (file_size_bytes::double AS file_size_bytes), NULL::varchar AS file_content_base64 "
         "FROM uploaded_documents"),
)
def _(spark, sf):
    return tables.evolve(
        load(spark, sf, "uploaded_documents"), {"file_content_base64": "string"}, {"file_size_bytes": "double"}
    )


@register("a11_lookup", over("users", "SELECT * FROM users WHERE user_id = 'u42' AND account_status = 'active'"))
def _(spark, sf):
    return tables.lookup_rows(load(spark, sf, "users"), user_id="u42", account_status="active")


@register(
    "a12_export_pairs",
    pair_sql("mental_health", f"SELECT {lit(TRAIN_SYSTEM['mental_health'])} || user_prompt AS prompt, "
             "assistant_response AS completion FROM pairs"),
)
def _(spark, sf):
    pairs = training_pairs(run_pipeline(spark, sf, "mental_health", as_of=DAY), "mental_health")
    path = tables.work_path(spark, "pairs_json")
    tables.export_pairs(to_training_rows(pairs, TRAIN_SYSTEM["mental_health"]), path)
    return spark.read.schema("prompt string, completion string").json(path)


INVENTORY = ("users", "user_medical_profiles", "uploaded_documents", "conversation_history", "health_metrics")


@register(
    "a13_inventory",
    over(" ".join(INVENTORY), " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in INVENTORY)),
)
def _(spark, sf):
    return tables.inventory({n: load(spark, sf, n) for n in INVENTORY})


@register("a14_save_load_model")
def _(spark, sf):
    gold = run_pipeline(spark, sf, "maternal", "core")
    features = ["age", "systolic_bp", "diastolic_bp", "heart_rate", "risk_level_clean"]
    ready, stages = learning.prepared(gold, features, "pregnancy_bp_stage")
    path = tables.work_path(spark, "model")
    learning.save_model(stages.fit(ready), path)
    scored = learning.load_model(path).transform(ready)
    return scored.groupBy("pregnancy_bp_stage", "label").agg(F.count("*").alias("n"))


# --- cleaning -----------------------------------------------------------------------------------
@register(
    "b01_norm_text",
    over("raw_bloodpressure", "SELECT trim(country) AS COUNTRY, lower(trim(gender)) AS GENDER, trim(hypertension) AS HYPERTENSION, "
         "lower(trim(smoking_status)) AS SMOKING_STATUS FROM raw_bloodpressure"),
)
def _(spark, sf):
    raw = load(spark, sf, "raw_bloodpressure")
    return cl.norm_text(raw, ["COUNTRY", "HYPERTENSION"], ["GENDER", "SMOKING_STATUS"]).select(
        "COUNTRY", "GENDER", "HYPERTENSION", "SMOKING_STATUS"
    )


@register("b02_select_as", over("raw_maternalhealth", "SELECT age AS age, systolicbp AS systolic_bp, bs AS blood_sugar FROM raw_maternalhealth"))
def _(spark, sf):
    return cl.select_as(load(spark, sf, "raw_maternalhealth"), {"AGE": "age", "SYSTOLICBP": "systolic_bp", "BS": "blood_sugar"})


@register(
    "b03_to_flag",
    over("raw_pcos_infertility raw_pcos", "SELECT 'pcos' AS source, coalesce(pcos = 1, false) AS flag FROM raw_pcos_infertility "
         "UNION ALL SELECT 'family', family_history IS TRUE FROM raw_pcos"),
)
def _(spark, sf):
    a = load(spark, sf, "raw_pcos_infertility").select(F.lit("pcos").alias("source"), cl.to_flag("PCOS", 1).alias("flag"))
    b = load(spark, sf, "raw_pcos").select(F.lit("family").alias("source"), cl.to_flag("FAMILY_HISTORY", True).alias("flag"))
    return a.unionAll(b)


@register(
    "b04_parse_ts",
    over("raw_mentalhealth", "SELECT timestamp_txt AS TIMESTAMP_TXT, try_strptime(timestamp_txt, '%m/%d/%Y %H:%M') AS survey_timestamp "
         "FROM raw_mentalhealth"),
)
def _(spark, sf):
    return load(spark, sf, "raw_mentalhealth").select("TIMESTAMP_TXT", cl.parse_ts("TIMESTAMP_TXT").alias("survey_timestamp"))


_VALID_MATERNAL = (
    "age BETWEEN 15 AND 60 AND systolicbp BETWEEN 70 AND 200 AND diastolicbp BETWEEN 40 AND 130 AND bs BETWEEN 4 AND 25 "
    "AND bodytemp BETWEEN 95 AND 105 AND heartrate BETWEEN 50 AND 120 AND risklevel IS NOT NULL"
)


@register("b05_validity", over("raw_maternalhealth", f"SELECT *, {yes(_VALID_MATERNAL)} AS is_valid_record FROM raw_maternalhealth"))
def _(spark, sf):
    return load(spark, sf, "raw_maternalhealth").withColumn("is_valid_record", cl.validity(silver.MATERNAL_RANGES))


@register("b06_filter_valid", over("raw_maternalhealth", f"SELECT * FROM raw_maternalhealth WHERE {_VALID_MATERNAL}"))
def _(spark, sf):
    return cl.filter_valid(load(spark, sf, "raw_maternalhealth"), silver.MATERNAL_RANGES)


@register("b07_dedupe", over("raw_maternalhealth", "SELECT DISTINCT * FROM raw_maternalhealth"))
def _(spark, sf):
    raw = load(spark, sf, "raw_maternalhealth")
    return cl.dedupe(raw, raw.columns)


@register("b08_stamp")
def _(spark, sf):
    return cl.stamp(run_pipeline(spark, sf, "pcos_infertility", "silver"))


@register(
    "b09_filters",
    over("conversation_history raw_diabetes",
         "SELECT urgency_level AS value, count(*) AS n FROM conversation_history WHERE routed_to_domain IN ('MENTAL_HEALTH', 'WOMEN_WELLNESS') "
         "AND urgency_level <> 'routine' GROUP BY 1 UNION ALL SELECT smoking_history, count(*) FROM raw_diabetes "
         "WHERE smoking_history NOT IN ('never', 'No Info') AND gender IS NOT NULL GROUP BY 1"),
)
def _(spark, sf):
    talk = load(spark, sf, "conversation_history")
    talk = talk.filter(F.col("routed_to_domain").isin("MENTAL_HEALTH", "WOMEN_WELLNESS") & (F.col("urgency_level") != "routine"))
    raw = load(spark, sf, "raw_diabetes")
    raw = raw.filter(~F.col("SMOKING_HISTORY").isin("never", "No Info") & F.col("GENDER").isNotNull())
    a = talk.groupBy(F.col("urgency_level").alias("value")).agg(F.count("*").alias("n"))
    return a.unionAll(raw.groupBy("SMOKING_HISTORY").agg(F.count("*").alias("n")))


@register(
    "b10_like_any",
    over("model_predictions", "SELECT patient_id, contains(model_prediction_raw, 'EMERGENCY') OR "
         "regexp_matches(model_prediction_raw, 'URGENT.*evaluation') AS matched FROM model_predictions"),
)
def _(spark, sf):
    return load(spark, sf, "model_predictions").select(
        "patient_id", like_any("model_prediction_raw", ["%EMERGENCY%", "%URGENT%evaluation%"]).alias("matched")
    )


def _silver(key: str, domain: str) -> None:
    @register(key, over(RAW_VIEW[domain], "SELECT * FROM silver", ("silver", SILVER_SQL[domain])))
    def _(spark, sf):
        return run_pipeline(spark, sf, domain, "silver")


for _key, _domain in {
    "b11_stg_diabetes": "diabetes",
    "b12_stg_blood_pressure": "hypertension",
    "b13_stg_mental_health": "mental_health",
    "b14_stg_maternal": "maternal",
    "b15_stg_pcos": "pcos",
    "b16_stg_pcos_infertility": "pcos_infertility",
}.items():
    _silver(_key, _domain)


@register(
    "b17_starter_models",
    over("starter_ids", "SELECT 'first' AS model, id::int AS id, count(*) AS n FROM starter_ids GROUP BY 2 UNION ALL "
         "SELECT 'second', id::int, count(*) FROM starter_ids WHERE id = 1 GROUP BY 2"),
)
def _(spark, sf):
    first, second = tables.starter_models(load(spark, sf, "starter_ids"))

    def counted(name, df):
        return df.groupBy(F.lit(name).alias("model"), "id").agg(F.count("*").alias("n"))

    return counted("first", first).unionAll(counted("second", second))


# --- rule primitives ----------------------------------------------------------------------------


def _column(key: str, view: str, given: dict[str, str], name: str, sql: str, column) -> None:
    shown = ", ".join(f"{v} AS {k}" for k, v in given.items())

    @register(key, over(view, f"SELECT {shown}, {sql} AS {name} FROM {view}"))
    def _(spark, sf):
        df = load(spark, sf, view)
        return df.select(*[F.col(v).alias(k) for k, v in given.items()], column().alias(name))


_column(
    "c01_band", "raw_diabetes", {"bmi": "BMI"}, "bmi_category",
    bands("bmi", ("underweight", None, 18.5), ("normal", 18.5, 24.9), ("overweight", 25, 29.9), ("obese_class1", 30, 34.9),
          ("obese_class2", 35, 39.9), ("obese_class3_severe", 40, None)),
    lambda: r.band("BMI", dm.BMI_CLASSES),
)
_column(
    "c02_band_half_open", "raw_diabetes", {"bmi": "BMI"}, "bmi_text",
    "['Underweight', 'Normal Weight', 'Overweight', 'Obese'][1 + (bmi >= 18.5)::int + (bmi >= 25)::int + (bmi >= 30)::int]",
    lambda: r.band_half_open("BMI", (18.5, 25, 30), ("Underweight", "Normal Weight", "Overweight", "Obese"), "Unknown"),
)
_column(
    "c03_rules", "raw_bloodpressure", {"s": "SYSTOLIC_BP", "d": "DIASTOLIC_BP"}, "urgency",
    pick(("crisis", "systolic_bp >= 180 OR diastolic_bp >= 120"), ("severe", "systolic_bp >= 160 OR diastolic_bp >= 100"), default="other"),
    lambda: r.first_match(
        [("crisis", (F.col("SYSTOLIC_BP") >= 180) | (F.col("DIASTOLIC_BP") >= 120)),
         ("severe", (F.col("SYSTOLIC_BP") >= 160) | (F.col("DIASTOLIC_BP") >= 100))], "other"),
)
_column(
    "c04_flag", "raw_bloodpressure", {"family": "FAMILY_HISTORY"}, "flagged", yes("family_history"),
    lambda: r.flag(F.col("FAMILY_HISTORY")),
)
_column(
    "c05_tri_flag", "raw_bloodpressure", {"status": "HYPERTENSION"}, "diagnosed",
    "MAP {'high': true, 'low': false}[lower(trim(hypertension))]",
    lambda: r.tri_flag(F.trim("HYPERTENSION"), "high", "low"),
)
_column(
    "c06_map_vocab", "raw_diabetes", {"history": "SMOKING_HISTORY"}, "status",
    words("lower(smoking_history)", "no_info", current="current, current smoker", former="former, ex-smoker, not current",
          never="never, non-smoker", ever="ever, yes"),
    lambda: r.vocab("SMOKING_HISTORY", dm.SMOKING_WORDS, "no_info"),
)
_column(
    "c07_score", "raw_diabetes", {"bmi": "BMI", "glucose": "BLOOD_GLUCOSE_LEVEL"}, "score",
    total(one("bmi >= 30", 2), one("blood_glucose_level >= 100", 2), one("hypertension = 1", 2)),
    lambda: r.score(r.points(F.col("BMI") >= 30, 2), r.points(F.col("BLOOD_GLUCOSE_LEVEL") >= 100, 2),
                    r.points(F.col("HYPERTENSION") == 1, 2)),
)
_column(
    "c08_score_band", "health_metrics", {"metric_id": "metric_id"}, "severity",
    bands("(metric_value::int % 17)", ("minimal_depression", None, 1), ("mild_depression", 1, 4), ("moderate_depression", 5, 9),
          ("moderately_severe_depression", 10, 14), ("severe_depression", 15, None), default=None),
    lambda: r.band(F.col("metric_value").cast("int") % 17, mh.DEPRESSION_BANDS, None),
)
_column(
    "c09_criteria", "raw_pcos", {"amh": "ANTI_MULLERIAN_HORMONE"}, "criteria",
    total(one("lower(trim(menstrual_cycle)) = 'irregular'"), one("total_testosterone > 70"), one("anti_mullerian_hormone > 4")),
    lambda: r.criteria_count([F.lower(F.trim("MENSTRUAL_CYCLE")) == "irregular", F.col("TOTAL_TESTOSTERONE") > 70,
                              F.col("ANTI_MULLERIAN_HORMONE") > 4]),
)
_column(
    "c10_safe_ratio", "raw_bloodpressure", {"cholesterol": "CHOLESTEROL", "hdl": "HDL"}, "ratio",
    "if(hdl = 0, NULL, ((200 * cholesterol + hdl) // (2 * nullif(hdl, 0))) / 100.0::double)",
    lambda: F.round(r.safe_ratio("CHOLESTEROL", "HDL"), 2),
)
_column(
    "c11_hemodynamics", "raw_bloodpressure", {"s": "SYSTOLIC_BP", "d": "DIASTOLIC_BP"}, "mean_arterial_pressure",
    half_up("(systolic_bp + 2 * diastolic_bp) / 3::double", 1),
    lambda: F.round(r.mean_arterial("SYSTOLIC_BP", "DIASTOLIC_BP"), 1),
)
_column(
    "c12_topics", "raw_diabetes", {"bmi": "BMI"}, "topics",
    listed(("weight", "bmi >= 30"), ("glucose", "blood_glucose_level >= 126"), ("heart", "heart_disease = 1")),
    lambda: r.topics([("weight", F.col("BMI") >= 30), ("glucose", F.col("BLOOD_GLUCOSE_LEVEL") >= 126),
                      ("heart", F.col("HEART_DISEASE") == 1)]),
)
_column(
    "c13_topics_or", "raw_pcos", {"bmi": "BODY_MASS_INDEX"}, "topics",
    listed(("weight", "body_mass_index >= 25"), ("androgen", "total_testosterone > 70"), empty="general"),
    lambda: r.topics([("weight", F.col("BODY_MASS_INDEX") >= 25), ("androgen", F.col("TOTAL_TESTOSTERONE") > 70)], "general"),
)
_column(
    "c14_map_values", "conversation_history", {"urgency": "urgency_level"}, "tone",
    "coalesce(MAP {'emergency': 'urgent_compassionate_immediate', 'urgent': 'serious_supportive_prompt', "
    "'needs_attention': 'concerned_encouraging', 'routine': 'supportive_informative'}[urgency_level], 'positive_preventive')",
    lambda: r.lookup("urgency_level", mh.TONES, "positive_preventive"),
)


@register(
    "c15_chained_columns",
    over("raw_bloodpressure", "SELECT age AS age, CASE WHEN age < 40 THEN 0 WHEN age >= 70 THEN 4 ELSE age // 10 - 3 END::int AS age_points, "
         "CASE WHEN age >= 70 THEN 'oldest' WHEN age >= 40 THEN 'middle' ELSE 'youngest' END AS age_group FROM raw_bloodpressure"),
)
def _(spark, sf):
    first = load(spark, sf, "raw_bloodpressure").select(F.col("AGE").alias("age"), r.steps("AGE", htn.AGE_POINTS).alias("age_points"))
    return first.withColumn(
        "age_group", r.first_match([("oldest", F.col("age_points") == 4), ("middle", F.col("age_points") > 0)], "youngest")
    )


_column(
    "c16_years_since", "raw_mentalhealth", {"at": "TIMESTAMP_TXT"}, "years",
    "(2024 - year(try_strptime(timestamp_txt, '%m/%d/%Y %H:%M')))::int",
    lambda: r.years_since(cl.parse_ts("TIMESTAMP_TXT"), DAY),
)
_column(
    "c17_age_years", "users", {"user_id": "user_id", "date_of_birth": "date_of_birth"}, "age",
    "date_sub('year', date_of_birth, DATE '2024-02-01')::int", lambda: r.age_years("date_of_birth", DAY),
)

