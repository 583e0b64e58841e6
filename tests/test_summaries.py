"""Folded session summaries on hand-made sessions: order, levels, long texts, unreadable replies, repeated saves."""

import datetime as dt
import json

import pandas as pd
from pyspark.sql import functions as F

from vitalframe.operators import summaries as sm
from vitalframe.sources import tables

SCHEMA = (
    "conversation_id string, user_id string, session_id string, message_timestamp timestamp, user_message string, "
    "assistant_response string, routed_to_domain string"
)
START = dt.datetime(2024, 1, 30, 8)


def talk(spark, sessions):
    """``sessions`` maps a session id to its user messages; every answer is 'ok'."""
    rows = [
        (f"{s}{i:04d}", "u", s, START + dt.timedelta(seconds=i // 3), m, "ok", f"D{min(i, 1)}")
        for s, messages in sessions.items() for i, m in enumerate(messages)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def echo(prompts):
    return pd.Series([f"[{p[1:]}]" for p in prompts])


def folded(texts, fan_in):
    """Plain version of the fold."""
    while True:
        texts = [f"[{''.join(texts[i : i + fan_in])}]" for i in range(0, len(texts), fan_in)]
        if len(texts) == 1:
            return texts[0]


def test_fold_keeps_order_and_leaves_early(spark):
    sizes = {"a": 1, "b": 3, "c": 4, "d": 9, "e": 10, "f": 200}
    rows = [(k, n, i + 1, f"{k}{i};") for k, n in sizes.items() for i in range(n)]
    texts = spark.createDataFrame(rows, "k string, nodes long, pos long, text string").repartition(5)
    out = {r.k: r.reply for r in sm.fold_texts(texts, ["k"], "#", echo, fan_in=3).collect()}
    assert out == {k: folded([f"{k}{i};" for i in range(n)], 3) for k, n in sizes.items()}


def test_fold_of_nothing(spark):
    texts = spark.createDataFrame([], "k string, nodes long, pos long, text string")
    assert sm.fold_texts(texts, ["k"], "#", echo).collect() == []


def test_null_replies_count_as_empty(spark):
    texts = spark.createDataFrame([("a", 4, i, str(i)) for i in range(1, 5)], "k string, nodes long, pos long, text string")
    out = sm.fold_texts(texts, ["k"], "#", lambda p: pd.Series([None if "1" in x else f"<{x[1:]}>" for x in p], dtype=object), fan_in=2)
    assert [r.reply for r in out.collect()] == ["<<34>>"]


def test_pieces_hold_the_whole_transcript(spark):
    messages = ["x" * 95, "", None, "\N{GRINNING FACE}" * 41, *["short"] * 200]
    from vitalframe.operators.conversation import session_transcripts

    turns = session_transcripts(talk(spark, {"s": messages, "single": ["alone"]}))
    pieces = sm.transcript_pieces(turns, 10).orderBy("session_id", "pos").collect()
    assert [r.pos for r in pieces] == list(range(1, len(pieces) + 1)) and {r.nodes for r in pieces} == {len(pieces)}
    assert max(len(r.text) for r in pieces) == 10 and {r.session_id for r in pieces} == {"s"}
    whole = "".join(f"\nTurn {i + 1}:\nUser: {m or ''}\nAssistant: ok\n" for i, m in enumerate(messages))
    assert "".join(r.text for r in pieces) == whole


def model(prompts):
    def answer(prompt):
        text = prompt[len(sm.SUMMARY_HEAD) :]
        if "list" in text:
            return "[1, 2]"
        if "silence" in text:
            return None if "none" in text else "  "
        if "broken" in text:
            return '{"main_topic": '
        if "bare" in text:
            return "{}"
        concerns = sorted({w for w in ("cough", "fever") if w in text})
        return "```json\n" + json.dumps({"main_topic": "m", "key_concerns": concerns, "recommendations": ["r"], "metrics_mentioned": {"bp": 150}, "summary_text": "O'K"}) + "\n```"

    return pd.Series([answer(p) for p in prompts], dtype=object)


def test_outcomes_and_repeated_saves(spark):
    sessions = {
        "good": ["fever"] + ["hm"] * 40 + ["cough"], "calm": ["hm", "hm"], "one": ["fever"], "list": ["list", "x"],
        "mute": ["silence none", "x"], "blank": ["silence", "x"], "broken": ["broken", "x"], "bare": ["bare", "x"],
    }
    history = talk(spark, sessions)
    stray = history.where("session_id = 'calm'").withColumn("session_id", F.lit(None).cast("string"))
    out = {r.session_id: r for r in sm.summarize_sessions(history.unionByName(stray), model, fan_in=4, chars=60).collect()}
    assert set(out) == set(sessions)
    assert {s: r.reason for s, r in out.items() if not r.summary_created} == {
        "one": "Not enough messages", "list": "Unreadable reply", "mute": "Unreadable reply", "blank": "Unreadable reply", "broken": "Unreadable reply"
    }
    good = out["good"]
    assert (good.key_topics, good.mentioned_metrics, good.summary_text, good.domain, good.turns) == (["cough", "fever"], '{"bp":150}', "O'K", "D0", 42)
    assert (good.time_period_start, good.time_period_end) == (START, START + dt.timedelta(seconds=13))
    assert out["calm"].key_topics is None and out["calm"].recommendations == ["r"]
    assert (out["bare"].summary_text, out["bare"].mentioned_metrics, out["bare"].key_topics, out["bare"].main_topic) == ("", "{}", None, None)

    path = tables.work_path(spark, "summaries")
    sm.save_summaries(sm.summarize_sessions(history.where("message_timestamp <= '2024-01-30 08:00:05'"), model), path)
    for _ in range(2):
        sm.save_summaries(sm.summarize_sessions(history, model), path)
    saved = spark.read.parquet(path)
    assert saved.groupBy("time_period_end").count().count() == 3  # the long session was saved while short and again when grown
    assert saved.count() == 4 and saved.where("created_at is null or summary_date <> '2024-01-30'").count() == 0


def test_no_sessions(spark):
    assert sm.summarize_sessions(talk(spark, {"s": ["x", "y"]}).limit(0), model).count() == 0
