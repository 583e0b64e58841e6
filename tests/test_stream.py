"""Streams give the batch result, over several files and across restarts."""

from pyspark.sql import functions as F

from vitalframe.operators import conversation as cv
from vitalframe.sources import fixtures, tables
from vitalframe.streaming import jobs

COLUMNS = "conversation_id string, user_id string, session_id string, message_timestamp timestamp, user_message string, " \
    "assistant_response string, routed_to_domain string, urgency_level string"


def history(spark, sf):
    df = fixtures.view(spark, sf, "conversation_history")
    return df.withColumn("message_timestamp", F.col("message_timestamp").cast("timestamp"))


def drain(spark, start, folder, out, checkpoint):
    start(jobs.file_stream(spark, folder, COLUMNS, files=1), out, checkpoint, None).awaitTermination()
    return spark.read.parquet(out)


def test_searchable_table_grows_with_new_files(spark, sf, tmp_path):
    folder, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    whole = history(spark, sf)
    early, late = whole.filter("day(message_timestamp) <= 15"), whole.filter("day(message_timestamp) > 15")
    early.write.mode("append").parquet(folder)
    assert drain(spark, jobs.stream_searchable, folder, out, check).count() == early.count()
    late.write.mode("append").parquet(folder)
    table = drain(spark, jobs.stream_searchable, folder, out, check)
    assert table.count() == whole.count()
    batch = cv.searchable(whole).select(*table.columns)
    assert table.exceptAll(batch).count() == 0


def test_readings_match_batch_and_do_not_repeat(spark, sf, tmp_path):
    folder, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    whole = history(spark, sf).orderBy("message_timestamp")
    whole.coalesce(1).write.mode("append").parquet(folder)
    got = drain(spark, jobs.stream_metrics, folder, out, check)
    keys = ["conversation_id", "user_id", "message_timestamp"]
    batch = cv.grade_metric(cv.extract_metrics(whole, ["user_message", "assistant_response"], keys, "routed_to_domain"))
    same = [c for c in batch.columns]
    assert got.select(*same).exceptAll(batch).count() == 0 and got.count() == batch.count()
    # The newest message again, in a new file: recognised as a repeat.
    last = whole.orderBy(F.desc("message_timestamp")).filter("user_message like '%BP%' and routed_to_domain <> 'MENTAL_HEALTH'").limit(1)
    before = got.count()
    last.write.mode("append").parquet(folder)
    jobs.stream_metrics(jobs.file_stream(spark, folder, COLUMNS, files=1), out, check, None).awaitTermination()
    assert spark.read.parquet(out).count() == before
    # A new message from the day before the newest is kept, however late it comes.
    late = last.withColumn("conversation_id", F.lit("late").cast(last.schema["conversation_id"].dataType))
    late = late.withColumn("conversation_id", F.coalesce("conversation_id", F.lit(-1).cast(last.schema["conversation_id"].dataType)))
    late.withColumn("message_timestamp", F.col("message_timestamp") - F.expr("interval 1 day")).write.mode("append").parquet(folder)
    jobs.stream_metrics(jobs.file_stream(spark, folder, COLUMNS, files=1), out, check, None).awaitTermination()
    assert spark.read.parquet(out).count() > before


def test_triage_stream_is_stateless(spark, sf, tmp_path):
    folder, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    history(spark, sf).repartition(3).write.parquet(folder)
    got = drain(spark, jobs.stream_triage, folder, out, check)
    batch = jobs.triaged(history(spark, sf))
    assert got.exceptAll(batch).count() == 0 and got.count() == batch.count()


def partition_filters(df):
    return [line for line in df._jdf.queryExecution().toString().split("\n") if "PartitionFilters" in line]


def test_a_batch_reads_only_the_dates_it_touches(spark, sf, tmp_path):
    folder, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    history(spark, sf).write.parquet(folder)
    got = drain(spark, jobs.stream_metrics, folder, out, check)
    days = sorted(r[0] for r in got.select("measurement_date").distinct().collect())
    assert len(days) > 2
    # the folders of all other days are made unreadable: a late reading of the first day must not notice
    for other in days[1:]:
        for bucket in (tmp_path / "out" / f"measurement_date={other}").iterdir():
            for file in bucket.glob("*.parquet"):
                file.write_bytes(b"not parquet")
    late = history(spark, sf).filter(F.to_date("message_timestamp") == F.lit(days[0])).withColumn("conversation_id", F.concat(F.lit("x"), "conversation_id"))
    late.write.mode("append").parquet(folder)
    jobs.stream_metrics(jobs.file_stream(spark, folder, COLUMNS, files=1), out, check, None).awaitTermination()
    first = spark.read.parquet(f"{out}/measurement_date={days[0]}")
    assert first.count() == 2 * got_count(batch_readings(spark, sf), days[0])
    touched = [(days[0], 3), (None, 5)]
    plan = " ".join(partition_filters(tables.stored_keys(spark, out, got.schema, touched, jobs.READING, "measurement_date")))
    assert str(days[0]) in plan and "key_bucket" in plan and str(days[1]) not in plan


def batch_readings(spark, sf):
    return jobs.readings(history(spark, sf)).withColumn("measurement_date", F.to_date("message_timestamp"))


def got_count(df, day):
    return df.filter(F.col("measurement_date") == F.lit(day)).count()


def test_rows_without_ids_or_times_are_recognised_when_they_come_again(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = [(None, None, "hba1c", 7.5), ("c1", None, "hba1c", 7.5), ("c1", "2024-01-03 10:00:00", "hba1c", None), ("c1", "2024-01-03 10:00:00", "hba1c", None)]
    df = spark.createDataFrame(rows, "conversation_id string, message_timestamp string, metric_type string, metric_value double")
    df = df.withColumn("message_timestamp", F.to_timestamp("message_timestamp")).withColumn("measurement_date", F.to_date("message_timestamp"))
    for _ in range(3):
        tables.append_new(df, out, jobs.READING, "measurement_date")
        assert spark.read.parquet(out).count() == 3
    tables.append_new(df.limit(0), out, jobs.READING, "measurement_date")
    more = df.withColumn("metric_type", F.lit("weight"))
    tables.append_new(more.unionByName(df), out, jobs.READING, "measurement_date")
    assert spark.read.parquet(out).count() == 6


def test_half_an_append_is_completed(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.range(200).select(F.col("id").cast("string").alias("metric_id"), F.expr("date_add(DATE '2024-01-01', cast(id % 5 as int))").alias("day"))
    tables.append_new(df.where("id % 3 = 0"), out, ["metric_id"], "day")
    tables.append_new(df, out, ["metric_id"], "day")
    table = spark.read.parquet(out)
    assert table.count() == 200 == table.select("metric_id").distinct().count()
