import datetime as dt
import json

from test_staging import T0, message, payload

from rankmill.plans.staging import stg_events
from rankmill.sources import lake as lakes
from rankmill.sources.schemas import EVENT_MESSAGE
from rankmill.streaming import events as streams


def drop(spark, folder, rows):
    spark.createDataFrame(rows, EVENT_MESSAGE).coalesce(1).write.mode("append").parquet(folder)


def land(spark, lake, folder):
    stream = streams.message_files(spark, folder, "parquet")
    streams.land_events(stream, lake, f"{lake.root}/checkpoint").awaitTermination()


def drain(df, out, mode="append"):
    (df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", out + "-cp")
     .trigger(availableNow=True).start(out).awaitTermination())


def test_landing_keeps_payloads_and_continues_where_it_stopped(spark, lake, tmp_path):
    folder = str(tmp_path / "in")
    drop(spark, folder, [message("잘못된 text", 0, "m1"), message(payload("a"), 1, "m2")])
    land(spark, lake, folder)
    drop(spark, folder, [message(payload("a"), 86400, "m3")])
    land(spark, lake, folder)
    land(spark, lake, folder)
    out = lakes.read_events(spark, lake).collect()
    assert sorted((r.message_id, r.data[:5], str(r.dt)) for r in out) == [
        ("m1", "잘못된 t", "2026-07-08"), ("m2", '{"eve', "2026-07-08"), ("m3", '{"eve', "2026-07-09")]
    assert lakes.read_events(spark, lake, since="2026-07-09").count() == 1


def test_messages_without_a_publication_time_are_not_lost(spark, lake, tmp_path):
    folder = str(tmp_path / "in")
    drop(spark, folder, [("s", "m", None, json.dumps(payload("a")), None), message(payload("b"))])
    land(spark, lake, folder)
    assert {r.event_id for r in stg_events(lakes.read_events(spark, lake)).collect()} == {"a", "b"}
    assert lakes.read_events(spark, lake, since="2030-01-01").count() == 1


def test_landed_stream_gives_the_batch_result(spark, lake, tmp_path):
    folder = str(tmp_path / "in")
    rows = [message(payload(f"e{i % 40}", user_id=f"u{i}"), (i * 37) % 100, f"m{i}") for i in range(120)]
    for part in (rows[:50], rows[50:90], rows[90:]):
        drop(spark, folder, part)
    land(spark, lake, folder)
    direct = stg_events(spark.createDataFrame(rows, EVENT_MESSAGE))
    landed = stg_events(lakes.read_events(spark, lake))
    assert sorted(map(tuple, landed.collect())) == sorted(map(tuple, direct.collect()))


def test_stream_dedup_keeps_one_row_per_id(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    drop(spark, folder, [message(payload("a"), 5), message(payload("a"), 6), message(payload("b"), 7), message("bad")])
    drain(streams.dedup_stream(streams.message_files(spark, folder, "parquet")), out)
    drop(spark, folder, [message(payload("a"), 1), message(payload("c"), 8)])
    drain(streams.dedup_stream(streams.message_files(spark, folder, "parquet")), out)
    kept = spark.read.parquet(out).collect()
    assert sorted(r.event_id for r in kept) == ["a", "b", "c"]
    # documented: the first arrival stays, even if a later one was published earlier
    assert {r.publish_time for r in kept if r.event_id == "a"} <= {
        T0 + dt.timedelta(seconds=5), T0 + dt.timedelta(seconds=6)}


def test_live_popularity_closes_windows(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")

    def event(i, stamp, kind="view", rating=None):
        return message(payload(f"e{i}", event_ts=stamp, event_type=kind, user_id=f"u{i}", rating=rating))

    drop(spark, folder, [event(1, "2026-07-08T23:59:59Z"), event(2, "2026-07-08T10:00:00Z"), event(2, "2026-07-08T10:00:00Z"),
                         event(3, "2026-07-08T10:00:00Z", "rating", 4), event(4, "nonsense")])
    stream = streams.live_popularity(streams.message_files(spark, folder, "parquet"))
    drain(stream, out)
    drop(spark, folder, [event(5, "2026-07-10T10:00:00Z")])
    drain(streams.live_popularity(streams.message_files(spark, folder, "parquet")), out)
    closed = spark.read.parquet(out).collect()
    assert sorted(tuple(r) for r in closed) == [
        (dt.datetime(2026, 7, 8), "rating", 1, 1, 1, 4.0), (dt.datetime(2026, 7, 8), "view", 2, 2, 1, None)]


def test_kafka_records_become_messages(spark):
    rows = [(b"k", bytearray(json.dumps(payload("a")).encode()), "events", 3, 42, T0, 0,
             [("trace", bytearray(b"x1"))])]
    schema = ("key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, "
              "timestampType int, headers array<struct<key: string, value: binary>>")
    out = streams.from_kafka(spark.createDataFrame(rows, schema), "sub")
    assert out.columns == EVENT_MESSAGE.names
    row = out.first()
    assert (row.subscription_name, row.message_id, row.publish_time) == ("sub", "events-3-42", T0)
    assert json.loads(row.data)["event_id"] == "a" and json.loads(row.attributes) == [{"key": "trace", "value": "x1"}]


def test_files_of_an_unfinished_batch_are_not_read(spark, lake, tmp_path):
    folder = str(tmp_path / "in")
    drop(spark, folder, [message(payload("a")), message(payload("b"), 86400)])
    streams.land_events(streams.message_files(spark, folder, "parquet"), lake, str(tmp_path / "c")).awaitTermination()
    lakes.write_events(lake, spark.createDataFrame([message(payload("c"), 5)], EVENT_MESSAGE))
    streamed = lake.table("events_stream", "raw")
    with open(f"{streamed}/dt=2026-07-09/part-in-flight.parquet", "wb") as out:
        out.write(b"PAR1 and no footer")
    assert lakes.read_events(spark, lake).count() == 3
    assert lakes.read_events(spark, lake, "2026-07-09").count() == 1
    # dates that retention deleted are still in the log
    lakes.drop_partitions(spark, streamed, lake.dates(spark, streamed)[:1])
    assert lakes.read_events(spark, lake).count() == 2
