import json

import pytest
from pyspark.sql import functions as F

from stagewise.functions import text
from stagewise.streaming.dedup import dedup_stream


def test_messages_are_cleaned(spark):
    df = spark.createDataFrame(
        [(1, "text", "@_user_1 查 @_user_22  数\n"), (2, "text", " @_user_3 "), (3, "image", "x"), (4, "text", None), (5, "text", "a@_user_x")],
        "id int, kind string, body string",
    )
    got = text.clean_messages(df, "body", "kind")
    assert [(r.id, r.body) for r in got.orderBy("id").collect()] == [(1, "查 数"), (5, "a@_user_x")]


@pytest.mark.parametrize(
    "message, intent, requirement",
    [
        (" 重置 ", "reset", None), ("help", "help", None), ("快速模式", "fast_mode_on", None), ("看sql", "fast_mode_off", None),
        ("OK", "confirm", None), ("Ok", "query", None), ("算了", "cancel", None), ("修改 日期", "modify", None),
        ("直接出数：： 昨天的点击", "fast_query", "昨天的点击"), ("直接跑", "fast_query", ""), ("直接出数模式", "fast_mode_on", None),
        ("昨天有多少点击", "query", None),
    ],
)
def test_intents(spark, message, intent, requirement):
    df = spark.createDataFrame([(message,)], "m string")
    row = text.tag_intent(df, "m").first()
    assert (row.intent, row.requirement) == (intent, requirement)


def test_tolerant_json(spark):
    good = json.dumps({"understanding": "u", "sql": "select 1", "output_fields": ["a"], "filename": "f"})
    cases = {
        good: "select 1",
        f"  {good}\n": "select 1",
        f"text\n```json\n{good}\n```\nmore": "select 1",
        f"```\n{good}\n``` {{": "select 1",
        f"so: {good} .": "select 1",
        "```json\nnot json\n``` {\"sql\": \"x\"}": "x",
        "{broken": "",
        "nothing": "",
        "": "",
        "{\"understanding\": \"only\"}": None,
        f"{good} {good}": "",
        f"{good}],[{good}": "",
        f"{good}, \"w\": {good}": "",
        '{"sql": "a", "sql": "b"}': "b",
        '{"sql": NaN, "understanding": -Infinity}': "NaN",
        '{"sql": "x"} trailing': "x",
        '{"sql": "x" "y"}': "",
        "{'sql': 'x'}": "",
        f"[{good}": "select 1",
        f'{good}], "x": [{good}': "",
        f'{good}], "v": [{good}': "",
        f"{good}]}} {{": "",
        "null": None,
        "[]": None,
        '{"sql": "]}, \\" {["}': ']}, " {[',
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, t string")
    got = df.select("i", text.parse_tolerant("t").alias("a")).select("i", "a.sql", "a.output_fields", "a.understanding").orderBy("i").collect()
    assert [r.sql for r in got] == list(cases.values())
    assert got[0].output_fields == ["a"] and got[7].understanding == text.UNREADABLE["understanding"]


def test_event_types(spark):
    df = spark.createDataFrame([("click_x_y",), ("get",), ("purchase_x",), ("other_z",), (None,)], "k string")
    kinds = [r[0] for r in df.select(text.event_type_of("k")).collect()]
    assert kinds == ["click", "get", "other", "other", "other"]


def test_redelivered_events_are_dropped_across_batches(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "event_id string, ts timestamp, body string"

    def arrive(*ids):
        data = [(i, f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00", i) for i, m in ids]
        spark.createDataFrame(data, "event_id string, ts string, body string").selectExpr(
            "event_id", "cast(ts as timestamp) ts", "body"
        ).coalesce(1).write.mode("append").parquet(source)

    def run():
        events = spark.readStream.schema(schema).parquet(source)
        query = (
            dedup_stream(events, "event_id", "30 minutes")
            .writeStream.format("parquet").option("path", target)
            .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        )
        query.awaitTermination()

    arrive(("a", 1), ("b", 2), ("a", 1))
    run()
    arrive(("b", 2), ("c", 300), ("a", 1), ("c", 300))
    run()
    # A first delivery whose own time is hours behind is kept, its repeat and other repeats are not.
    arrive(("late", 0), ("late", 0), ("c", 300), ("a", 1))
    run()
    assert sorted(r.event_id for r in spark.read.parquet(target).collect()) == ["a", "b", "c", "late"]
    batch = spark.read.schema(schema).parquet(source)
    assert dedup_stream(batch, "event_id").select(F.count("*")).first()[0] == 4
