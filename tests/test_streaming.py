import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillroll.functions.expressions import instant
from tillroll.streaming import events as E
from tillroll.streaming import landing as L

ONCE = {"availableNow": True}
AT = "2024-02-01 00:00:00"


def messages(folder, rows, name="m.json"):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"topic": t, "partition": 0, "offset": o, "key": "k", "value": v,
                         "timestamp": "2024-02-01T00:00:00"}) for t, o, v in rows]
    (folder / name).write_text("\n".join(lines))


@pytest.fixture
def inbox(tmp_path):
    messages(tmp_path / "in", [
        ("orders", 1, '{"order_id":"a","order_date":"2024-01-05T10:00:00","extra":{"x":1}}'),
        ("orders", 2, '{"order_id":"b"'),
        ("orders", 3, '{}'),
        ("orders", 4, '[1]'),
        ("orders", 5, None),
        ("clickstream", 1, '{"event_id":"e","event_ts":"2024-01-06T10:00:00"} '),
        ("other", 1, '{"x":1}'),
    ])
    return tmp_path


def landed(out):
    return sorted(
        (f.parent.parent.name, f.parent.name, json.dumps(json.loads(line), sort_keys=True))
        for f in out.rglob("*.txt") for line in f.read_text().splitlines())


def test_landing_keeps_every_message_once(spark, inbox):
    def run():
        stream = L.read_topics(spark, "json", path=str(inbox / "in"))
        L.land_stream(stream, str(inbox / "out"), str(inbox / "mark"), ONCE, instant(AT)).awaitTermination()

    run()
    got = landed(inbox / "out")
    parsed = [(t, d, json.loads(v)) for t, d, v in got]
    assert len(got) == 6 and {t for t, _, _ in got} == {"topic=orders", "topic=clickstream"}
    by = {(t, v["_kafka_offset"]): (d, v) for t, d, v in parsed}
    date, a = by[("topic=orders", 1)]
    assert date == "date=2024-01-05" and a["extra"] == {"x": 1} and a["_kafka_topic"] == "orders"
    assert by[("topic=clickstream", 1)][0] == "date=2024-01-06"
    for offset, raw in ((2, '{"order_id":"b"'), (4, "[1]"), (5, "")):
        date, bad = by[("topic=orders", offset)]
        assert (date, bad["_error"], bad["_raw"]) == ("date=2024-02-01", "parse_failed", raw)
    assert "_error" not in by[("topic=orders", 3)][1]

    run()                                   # nothing new: nothing is written again
    assert landed(inbox / "out") == got
    messages(inbox / "in", [("orders", 6, '{"order_id":"z"}')], "n.json")
    run()
    assert len(landed(inbox / "out")) == 7


def test_parse_split_and_counters(spark, inbox):
    stream = L.read_topics(spark, "json", ("orders",), path=str(inbox / "in"))
    parsed = L.parse_stream(stream, "order_id string", instant(AT))
    query = L.land_table(parsed, str(inbox / "p"), str(inbox / "mp"), ONCE)
    query.awaitTermination()
    assert tuple(L.stream_totals(spark.read.parquet(str(inbox / "p"))).first()) == (5, 3)
    good, bad = L.split_bad(spark.read.parquet(str(inbox / "p")))
    assert sorted(r.order_id or "" for r in good.collect()) == ["", "a"]
    assert sorted(r._kafka_offset for r in bad.collect()) == [2, 4, 5]
    assert set(bad.columns) == {"_error", "_raw", "_kafka_topic", "_kafka_partition", "_kafka_offset", "_consumed_at"}


def test_totals_over_many_micro_batches_and_a_restart(spark, tmp_path):
    for n in range(6):
        messages(tmp_path / "in", [("orders", n, '{"order_id":"x"}' if n % 2 else "no")], f"m{n}.json")
    for _ in range(2):
        stream = L.read_topics(spark, "json", ("orders",), path=str(tmp_path / "in"), maxFilesPerTrigger=1)
        parsed = L.parse_stream(stream, "order_id string", instant(AT))
        L.land_table(parsed, str(tmp_path / "p"), str(tmp_path / "m"), ONCE).awaitTermination()
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    assert kept and tuple(L.stream_totals(spark.read.parquet(str(tmp_path / "p"))).first()) == (6, 3)


def test_line_breaks_and_wrong_types(spark, tmp_path):
    messages(tmp_path / "in", [("orders", 1, '{"order_id":"a",\n "note":"x\\ny",\r\n "total_amount": 1.5}\n'),
                               ("orders", 2, '{"order_id":"b","total_amount":"abc"}'), ("orders", 3, "broken\nline")])
    stream = L.read_topics(spark, "json", ("orders",), path=str(tmp_path / "in"))
    L.land_stream(stream, str(tmp_path / "out"), str(tmp_path / "mark"), ONCE, instant(AT)).awaitTermination()
    lines = {v["_kafka_offset"]: v for _, _, v in ((t, d, json.loads(v)) for t, d, v in landed(tmp_path / "out"))}
    assert len(lines) == 3 and lines[1]["note"] == "x\ny" and lines[3]["_raw"] == "broken\nline"
    rows = spark.read.schema(L.MESSAGE_DDL).json(str(tmp_path / "in"))
    got = {r["_kafka_offset"]: r for r in L.parse_stream(rows, "order_id string, total_amount double", instant(AT)).collect()}
    assert (got[1]["order_id"], got[1]["total_amount"], got[1]["_error"]) == ("a", 1.5, None)
    assert (got[2]["order_id"], got[2]["_error"], got[2]["_raw"]) == (None, "parse_failed", '{"order_id":"b","total_amount":"abc"}')


@pytest.fixture
def clicks(spark, tmp_path):
    rng = random.Random(5)
    start, rows = datetime(2024, 1, 1), []
    for user in ("u1", "u2"):
        at = start
        for _ in range(60):
            at += timedelta(minutes=rng.choice([1, 29, 31, 45, 200]), microseconds=rng.randrange(10))
            rows.append((user, at))
    rows.append(("edge", start))
    rows.append(("edge", start + timedelta(minutes=30)))
    rows.append(("edge", start + timedelta(minutes=60, microseconds=1)))
    df = spark.createDataFrame(rows, "user string, at timestamp")
    path = str(tmp_path / "clicks")
    df.repartition(3).write.parquet(path)
    return path, rows


def brute(rows, gap):
    out = []
    for user in {u for u, _ in rows}:
        times = sorted(t for u, t in rows if u == user)
        cur = [times[0]]
        for t in times[1:]:
            if t - cur[-1] > gap:
                out.append((user, cur[0], cur[-1], len(cur)))
                cur = []
            cur.append(t)
        out.append((user, cur[0], cur[-1], len(cur)))
    return sorted(out)


def test_sessions_of_a_table(spark, clicks):
    path, rows = clicks
    got = sorted(tuple(r) for r in E.sessionize(spark.read.parquet(path), "user", "at").collect())
    assert got == brute(rows, timedelta(minutes=30))
    long = sorted(tuple(r) for r in E.sessionize(spark.read.parquet(path), "user", "at", 44).collect())
    assert long == brute(rows, timedelta(minutes=44))


def test_sessions_of_a_stream(spark, clicks, tmp_path):
    """A closing event a month later pushes the watermark past every session."""
    path, rows = clicks
    spark.createDataFrame([("closer", datetime(2024, 3, 1))], "user string, at timestamp").write.mode(
        "append").parquet(path)
    stream = spark.readStream.schema("user string, at timestamp").parquet(path)
    out = str(tmp_path / "s")
    L.land_table(E.sessionize_stream(stream, "user", "at"), out, str(tmp_path / "m"), ONCE).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got == brute(rows, timedelta(minutes=30))


def test_dedup_within_the_watermark(spark, tmp_path):
    rows = [("e1", datetime(2024, 1, 1, 0, i)) for i in range(3)] + [("e2", datetime(2024, 1, 1))]
    spark.createDataFrame(rows, "id string, at timestamp").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id string, at timestamp").parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    L.land_table(E.dedup_stream(stream, "id", "at"), out, str(tmp_path / "m"), ONCE).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["e1", "e2"]


def test_latest_stock_as_a_stream(spark, tmp_path):
    """Two micro-batches: the second writes only the stock it changes."""
    cols = ("warehouse_id string, product_sku string, event_ts timestamp, event_id string, "
            "quantity_change int, new_quantity int")
    first = [("w", "p", datetime(2024, 1, 1, h), f"e{h}", 5 - h, 100 - h) for h in range(5)] + [
        ("w", "q", datetime(2024, 1, 1), "f", 1, 7)]
    out = str(tmp_path / "out")
    for rows in (first, [("w", "p", datetime(2024, 1, 2), "e9", -6, 90)]):
        spark.createDataFrame(rows, cols).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(cols).parquet(str(tmp_path / "in"))
        L.land_changes(E.latest_stock(stream), out, str(tmp_path / "m"), ONCE).awaitTermination()
    landed = spark.read.parquet(out)
    assert [tuple(r) for r in landed.groupBy("batch").count().orderBy("batch").collect()] == [(0, 2), (1, 1)]
    got = {r["product_sku"]: tuple(r)[2:] for r in L.newest_changes(landed, "warehouse_id", "product_sku").collect()}
    assert got == {"p": (90, datetime(2024, 1, 2), 9, 6), "q": (7, datetime(2024, 1, 1), 1, 1)}


def test_batches_keep_late_rows_letters_and_counters(spark, tmp_path):
    at = lambda i, h: f'{{"id":"{i}","at":"2024-01-05T{h:02d}:00:00"}}'
    batches = [[at("a", 10), at("b", 12), "no"], [at("c", 9), at("b", 12), at("d", 13)], [at("c", 8), '{"id":"n"}', at("a", 10), "no"]]
    out, mark, seen = str(tmp_path / "out"), str(tmp_path / "m"), []
    for n, values in enumerate(batches):
        messages(tmp_path / "in", [("orders", 10 * n + k, v) for k, v in enumerate(values)], f"m{n}.json")
        stream = L.read_topics(spark, "json", ("orders",), path=str(tmp_path / "in"))
        parsed = L.parse_stream(stream, "id string, at timestamp", instant(AT))
        query = L.land_batches(L.observe_stream(parsed, "seen"), out, mark, ONCE, "at", "1 hour")
        query.awaitTermination()
        seen.append([p["observedMetrics"]["seen"] for p in query.recentProgress if p["numInputRows"]])
    read = lambda name: L.read_batches(spark, out, name)
    assert sorted((r.id, r.batch) for r in read("rows").collect()) == [("a", 0), ("b", 0), ("b", 1), ("d", 1), ("n", 2)]
    assert sorted((r.id, r.batch) for r in read("late").collect()) == [("a", 2), ("c", 1), ("c", 2)]
    assert sorted(r._kafka_offset for r in read("letters").collect()) == [2, 23]
    assert tuple(L.batch_totals(read("metrics")).first()) == (10, 2, 3)
    assert [tuple(s[-1]) for s in seen] == [(3, 1), (3, 0), (4, 1)]
    once = read("rows").dropDuplicates(["id"]).select("id", "at")
    got = sorted((r.id, r["at"] and r["at"].hour) for r in E.with_late(once, read("late"), "id", "at").collect())
    assert got == [("a", 10), ("b", 12), ("c", 8), ("d", 13), ("n", None)]


def test_a_batch_that_is_run_again_replaces_itself(spark, tmp_path):
    """The commit of the last batch is lost after its rows were written."""
    out, mark = str(tmp_path / "out"), tmp_path / "m"

    def run():
        stream = L.read_topics(spark, "json", ("orders",), path=str(tmp_path / "in"))
        L.land_batches(L.parse_stream(stream, "id string", instant(AT)), out, str(mark), ONCE).awaitTermination()

    for n in range(2):
        messages(tmp_path / "in", [("orders", n, '{"id":"x"}')], f"m{n}.json")
        run()
    for f in [*mark.glob("commits/1"), *mark.glob("commits/.1.crc")]:
        f.unlink()
    run()
    assert sorted(r._kafka_offset for r in L.read_batches(spark, out, "rows").collect()) == [0, 1]
    assert L.batch_totals(L.read_batches(spark, out, "metrics")).first()["consumed"] == 2


def test_event_date_falls_back_to_arrival(spark):
    df = spark.createDataFrame([("2024-01-05T10:00:00",), ("never",), (None,)], "order_date string")
    got = L.partition_by_event_date(df.withColumn("_consumed_at", instant(AT)), "order_date")
    assert [str(r.date) for r in got.collect()] == ["2024-01-05", "2024-02-01", "2024-02-01"]
    assert {str(r.arrival_date) for r in got.select(F.col("arrival_date")).collect()} == {"2024-02-01"}
