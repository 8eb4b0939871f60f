"""Streams equal their batch twins, restarts lose nothing, serving is exactly-once."""

import datetime as dt
import time

from pyspark.sql import functions as F

from tidewright import contracts as C
from tidewright.operators import keyed, quality, views
from tidewright.operators.decode import decode_json, encode_json
from tidewright.sources import tables
from tidewright.sources.topics import FolderTopic, KafkaTopic, as_envelope
from tidewright.streaming import jobs, pipelines
from tidewright.streaming.counters import CounterLog, read_counters
from tidewright.streaming.serving import MERGE, ServingTable

ROW = "k int, ts long, a string, b string"


def ticks(spark, numbers, day="2024-01-01"):
    rows = [(n, day, f"g{n % 3}", n, n + 1, "s") for n in numbers]
    return spark.createDataFrame(rows, C.TICK.schema)


def publish(spark, topic, numbers, day="2024-01-01"):
    topic.publish(encode_json(ticks(spark, numbers, day), F.col("gold_type")))


def stamps(df):
    return sorted(r.crawl_timestamp for r in df.collect())


def test_stream_equals_batch(spark, scratch):
    topic = FolderTopic(f"{scratch}/topic")
    publish(spark, topic, range(20))
    publish(spark, topic, range(20, 30), "bad")
    jobs.land(views.tick_speed(decode_json(topic.read_stream(spark, max_per_trigger=1), C.TICK)),
              f"{scratch}/out", f"{scratch}/cp")
    batch = views.tick_speed(decode_json(spark.read.parquet(topic.path), C.TICK))
    landed = tables.scan(spark, f"{scratch}/out")
    assert landed.count() == 30 and landed.exceptAll(batch).isEmpty() and batch.exceptAll(landed).isEmpty()


def test_restart_neither_loses_nor_repeats(spark, scratch):
    topic = FolderTopic(f"{scratch}/topic")
    seen = 0
    for start in (0, 10, 20):
        publish(spark, topic, range(start, start + 10))
        jobs.land(decode_json(topic.read_stream(spark), C.TICK), f"{scratch}/out", f"{scratch}/cp")
        seen += 10
        assert stamps(tables.scan(spark, f"{scratch}/out")) == list(range(seen))


def test_latest_skips_what_was_there_but_not_what_comes_while_down(spark, scratch):
    topic, checkpoint = FolderTopic(f"{scratch}/topic"), f"{scratch}/cp"
    publish(spark, topic, range(5))
    time.sleep(0.05)
    for start in (5, 10):
        messages = jobs.new_messages(spark, topic, checkpoint)
        if start == 5:
            time.sleep(0.05)
            publish(spark, topic, range(5, 10))
        jobs.land(decode_json(messages, C.TICK), f"{scratch}/out", checkpoint)
        publish(spark, topic, range(10, 15)) if start == 5 else None
    assert stamps(tables.scan(spark, f"{scratch}/out")) == list(range(5, 15))
    assert jobs.first_start(spark, checkpoint) == jobs.first_start(spark, checkpoint)


def test_messages_sent_again_arrive_once(spark, scratch):
    topic = FolderTopic(f"{scratch}/topic")
    for numbers in (range(6), range(4, 10), range(6)):
        publish(spark, topic, numbers)
    messages = pipelines.messages_once(topic.read_stream(spark, max_per_trigger=1), "10 minutes")
    jobs.land(decode_json(messages, C.TICK), f"{scratch}/out", f"{scratch}/cp")
    assert stamps(tables.scan(spark, f"{scratch}/out")) == list(range(10))
    publish(spark, topic, range(8, 12))  # and after a restart
    messages = pipelines.messages_once(topic.read_stream(spark), "10 minutes")
    jobs.land(decode_json(messages, C.TICK), f"{scratch}/out", f"{scratch}/cp")
    assert stamps(tables.scan(spark, f"{scratch}/out")) == list(range(12))


def test_relay_leaves_out_what_was_sent_again(spark, scratch):
    topic = FolderTopic(f"{scratch}/topic")
    for _ in range(2):
        publish(spark, topic, range(5))
    contract = C.Contract("ticks", C.TICK.schema, key=("crawl_timestamp",), order=("crawl_timestamp",))
    pipelines.run_relay(spark, topic, f"{scratch}/served", f"{scratch}/cp", contract, every=None, starting="earliest")
    assert stamps(ServingTable(f"{scratch}/served", ["crawl_timestamp"], ["crawl_timestamp"]).read(spark)) == list(range(5))


def test_large_topic_files_are_read_by_many_tasks(spark, scratch, monkeypatch):
    """Both ways to publish cut a file into row groups."""
    import glob

    import pyarrow.parquet as pq
    from tidewright.sources import topics
    monkeypatch.setattr(topics, "ROW_GROUP", 50_000)
    # The writer looks at its size after some hundred rows.
    rows = spark.range(4000).coalesce(1).selectExpr("CAST(id AS STRING) AS key", "repeat(sha2(CAST(id AS STRING), 512), 2) AS value")
    FolderTopic(f"{scratch}/topic/plain").publish(rows)
    jobs.publish(FolderTopic(f"{scratch}/topic/plain").read_stream(spark), FolderTopic(f"{scratch}/topic/streamed"), f"{scratch}/cp")
    for kind in ("plain", "streamed"):
        files = glob.glob(f"{scratch}/topic/{kind}/**/*.parquet", recursive=True)
        assert sum(pq.ParquetFile(f).num_row_groups for f in files) > 2 * len(files)
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{scratch}/topic").groupBy("key").count().filter("count = 2").count() == 4000


def test_state_parts_follow_the_cores(spark, scratch):
    """Not the shuffle's number, which every micro-batch would open and commit."""
    import os
    topic, usual = FolderTopic(f"{scratch}/topic"), spark.conf.get("spark.sql.shuffle.partitions")
    for _ in range(2):
        publish(spark, topic, range(5))
    try:
        for parts, want in (("70", 32), ("3", 3)):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            contract = C.Contract("ticks", C.TICK.schema, key=("crawl_timestamp",), order=("crawl_timestamp",))
            pipelines.run_relay(spark, topic, f"{scratch}/served{parts}", f"{scratch}/cp{parts}", contract, every=None, starting="earliest")
            assert len(os.listdir(f"{scratch}/cp{parts}/state/0")) in (want, want + 1)  # beside the schema there
            assert spark.conf.get("spark.sql.shuffle.partitions") == parts
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)


def test_latest_rows_keep_state_per_window(spark, scratch):
    topic = FolderTopic(f"{scratch}/topic")
    hour = 3_600_000
    served = ServingTable(f"{scratch}/served", ["gold_type"], ["crawl_timestamp"])
    for numbers in ([0, 5 * hour], [2 * hour, 30 * hour], [100 * hour], [31 * hour]):  # the last one is too late
        topic.publish(encode_json(spark.createDataFrame([(n, "d", "g", n // hour, 0, "s") for n in numbers], C.TICK.schema)))
        rows = decode_json(topic.read_stream(spark), C.TICK).withColumn("at", F.timestamp_millis("crawl_timestamp"))
        newest = jobs.latest_rows(rows, ["gold_type"], ["crawl_timestamp"], "at", "1 hour")
        served.follow(newest, f"{scratch}/cp", output="update")
    row = served.read(spark).first()
    assert (row.crawl_timestamp, row.buy_price) == (100 * hour, 100)
    stored = spark.read.parquet(f"{scratch}/served/changes/*")
    assert {r.crawl_timestamp // hour for r in stored.collect()} == {5, 30, 100}


def test_compaction_of_chosen_days(spark, scratch):
    topic = FolderTopic(f"{scratch}/topic")
    for day in (1, 2, 3):
        publish(spark, topic, range(day * 10, day * 10 + 4), f"2024-01-0{day}")
    rows = views.by_business_date(decode_json(topic.read_stream(spark, max_per_trigger=1), C.TICK))
    jobs.land(rows, f"{scratch}/out", f"{scratch}/cp", tables.DATE_PARTITIONS)
    days = [dt.date(2024, 1, d) for d in (1, 2)]

    def files():
        found = tables.scan(spark, f"{scratch}/compact").select("day", F.input_file_name().alias("f")).distinct().collect()
        return {d: {r.f for r in found if r.day == d} for d in {r.day for r in found}}

    tables.compact_days(spark, f"{scratch}/out", f"{scratch}/compact", days)
    first = files()
    assert set(first) == {1, 2} and all(len(f) == 1 for f in first.values())
    tables.compact_days(spark, f"{scratch}/out", f"{scratch}/compact", [dt.date(2024, 1, 3), dt.date(2024, 1, 1), dt.date(2023, 5, 5)])
    second = files()
    assert second[2] == first[2] and second[1] != first[1] and set(second) == {1, 2, 3}
    assert stamps(tables.scan(spark, f"{scratch}/compact")) == [d * 10 + i for d in (1, 2, 3) for i in range(4)]
    plan = tables.scan(spark, f"{scratch}/out").filter(tables.on_days(days))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "make_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_counters_of_each_batch(spark, scratch):
    topic = FolderTopic(f"{scratch}/topic")
    publish(spark, topic, range(7))
    publish(spark, topic, range(7, 10))
    log = CounterLog(spark, f"{scratch}/counters")
    spark.streams.addListener(log)
    try:
        rows = quality.observed(decode_json(topic.read_stream(spark, max_per_trigger=1), C.TICK), "ticks", {"even": F.col("buy_price") % 2 == 0})
        log.wait_for(jobs.land(rows, f"{scratch}/out", f"{scratch}/cp").runId)
    finally:
        spark.streams.removeListener(log)
    assert {(r.counter, r.amount) for r in read_counters(spark, f"{scratch}/counters").collect()} == {("row_count", 10), ("rejected_count", 5)}
    assert spark.read.parquet(f"{scratch}/counters").select("batch_id").distinct().count() >= 2


def test_partitioned_landing_with_unreadable_date(spark, scratch):
    topic = FolderTopic(f"{scratch}/topic")
    publish(spark, topic, range(3), "2024-02-29")
    publish(spark, topic, range(3, 5), "bad")
    rows = views.by_business_date(decode_json(topic.read_stream(spark), C.TICK))
    jobs.land(rows, f"{scratch}/out", f"{scratch}/cp", tables.DATE_PARTITIONS)
    stored = tables.scan(spark, f"{scratch}/out")
    assert {(r.year, r.month, r.day, r["count"]) for r in stored.groupBy("year", "month", "day").count().collect()} == {
        (2024, 2, 29, 3), (None, None, None, 2)}
    tables.compact(spark, f"{scratch}/out", f"{scratch}/compacted")
    assert stamps(tables.scan(spark, f"{scratch}/compacted")) == list(range(5))


def test_two_consumers_of_one_topic(spark, scratch):
    topic = FolderTopic(f"{scratch}/topic")
    publish(spark, topic, range(6))
    decoded = decode_json(topic.read_stream(spark), C.TICK)
    jobs.land(views.by_event_time(decoded), f"{scratch}/raw", f"{scratch}/cp-raw", tables.DATE_PARTITIONS)
    jobs.land(views.tick_speed(decoded), f"{scratch}/speed", f"{scratch}/cp-speed")
    assert stamps(tables.scan(spark, f"{scratch}/raw")) == stamps(tables.scan(spark, f"{scratch}/speed"))


def test_interval_trigger_runs_until_stopped(spark, scratch):
    topic = FolderTopic(f"{scratch}/topic")
    publish(spark, topic, range(4))
    query = jobs.land(decode_json(topic.read_stream(spark), C.TICK), f"{scratch}/out", f"{scratch}/cp", every="1 second")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert stamps(tables.scan(spark, f"{scratch}/out")) == list(range(4))


def test_envelope_contract(spark):
    shaped = as_envelope(encode_json(ticks(spark, [1])))
    assert [(f.name, f.dataType) for f in shaped.schema] == [(f.name, f.dataType) for f in C.ENVELOPE]


def test_kafka_options_are_declared():
    topic = KafkaTopic("broker:9092", "ticks", min_partitions=64, options={"kafka.security.protocol": "PLAINTEXT"})
    assert topic.min_partitions == 64 and topic.options


# --- serving ------------------------------------------------------------------------


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), ROW)


def shown(table, spark):
    return {r.k: (r.ts, r.a, r.b) for r in table.read(spark).collect()}


def test_replace_by_event_time_across_batches(spark, scratch):
    table = ServingTable(scratch, ["k"], ["ts"])
    table.apply(batch(spark, (1, 5, "new", None), (2, 1, "p", "q"), (None, 9, "no key", None)), 0)
    table.apply(batch(spark, (1, 3, "late", "x"), (2, 1, "tie", None), (3, 1, "c", None)), 1)
    expected = {1: (5, "new", None), 2: (1, "tie", None), 3: (1, "c", None)}
    assert shown(table, spark) == expected
    table.compact(spark)
    assert shown(table, spark) == expected
    table.apply(batch(spark, (3, 2, "d", None), (1, 4, "still late", None)), 2)
    assert shown(table, spark) == {**expected, 3: (2, "d", None)}


def test_repeated_batch_changes_nothing(spark, scratch):
    table = ServingTable(scratch, ["k"], ["ts"])
    table.apply(batch(spark, (1, 1, "a", "b")), 0)
    for _ in range(2):
        table.apply(batch(spark, (1, 2, "c", None), (2, 1, "x", "y")), 1)
    assert shown(table, spark) == {1: (2, "c", None), 2: (1, "x", "y")}


def test_unfinished_batch_is_not_seen(spark, scratch):
    table = ServingTable(scratch, ["k"], ["ts"])
    table.apply(batch(spark, (1, 1, "a", "b")), 0)
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        table.apply(batch(spark, (1, 9, "half written", None)), 1)
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert shown(table, spark) == {1: (1, "a", "b")}


def test_merge_across_batches(spark, scratch):
    table = ServingTable(scratch, ["k"], ["ts"], mode=MERGE, partition_by=["k"])
    table.apply(batch(spark, (1, 1, "a", "b"), (1, 2, None, "c")), 0)
    table.apply(batch(spark, (1, 3, "d", None), (2, 1, None, None)), 1)
    expected = {1: (3, "d", "c"), 2: (1, None, None)}
    assert shown(table, spark) == expected
    table.compact(spark)
    table.apply(batch(spark, (1, 4, None, "e")), 2)
    assert shown(table, spark) == {**expected, 1: (4, "d", "e")}


def test_new_field_is_null_in_older_rows(spark, scratch):
    table = ServingTable(scratch, ["k"], ["ts"])
    table.apply(batch(spark, (1, 1, "a", "b"), (2, 1, "c", "d")), 0)
    for compacted in (False, True):
        if compacted:
            table.compact(spark)
        table.apply(batch(spark, (2, 5, "e", None)).withColumn("extra", F.lit(7)), 1 + compacted)
        assert {r.k: (r.a, r.extra) for r in table.read(spark).collect()} == {1: ("a", None), 2: ("e", 7)}


def test_vacuum_keeps_what_readers_need(spark, scratch):
    table = ServingTable(scratch, ["k"], ["ts"])
    for n in range(4):
        table.apply(batch(spark, (n, 1, "a", "b"), (9, n, str(n), None)), n)
        table.compact(spark)
    before = shown(table, spark)
    table.vacuum(spark, keep=2)
    assert table._bases(spark) == [2, 3] and table._committed(spark, "changes") == ["batch.3"]
    assert shown(table, spark) == before and before[9] == (3, "3", None) and len(before) == 5


def test_stream_upsert_equals_batch_latest(spark, scratch):
    topic = FolderTopic(f"{scratch}/topic")
    for start in (20, 0, 10):  # out of order
        publish(spark, topic, range(start, start + 10))
    table = ServingTable(f"{scratch}/serving", ["gold_type"], ["crawl_timestamp"])
    table.follow(decode_json(topic.read_stream(spark, max_per_trigger=1), C.TICK), f"{scratch}/cp", compact_every=2)
    assert len(table._bases(spark)) == len(table._committed(spark, "changes")) // 2  # folded after every second
    expected = keyed.latest_per_key(ticks(spark, range(30)), ["gold_type"], ["crawl_timestamp"])
    assert sorted(table.read(spark).select(*expected.columns).collect()) == sorted(expected.collect())


def test_batch_view_upsert(spark, scratch):
    """A recomputed day overwrites its document, other days stay."""
    table = ServingTable(scratch, ["doc_id"], ["price_date"], mode=MERGE)
    table.apply(views.daily_view(ticks(spark, range(6), "2024-01-01")), 0)
    table.apply(views.daily_view(ticks(spark, range(12), "2024-01-01").unionByName(
        ticks(spark, range(3), "2024-01-02"))), 1)
    counts = {r.doc_id: r.record_count for r in table.read(spark).collect()}
    assert counts["2024-01-01_g0"] == 4 and counts["2024-01-02_g0"] == 1 and len(counts) == 6


def test_spine_and_seasons(spark):
    from tidewright.operators.expand import date_spine, expand_seasons
    spans = spark.createDataFrame([(dt.date(2025, 2, 27), dt.date(2025, 3, 1))], "a date, b date")
    assert [(r.price_date, r.day_first) for r in date_spine(spans, F.col("a"), F.col("b")).collect()] == [
        ("2025-02-27", "27/02/2025"), ("2025-02-28", "28/02/2025"), ("2025-03-01", "01/03/2025")]
    leagues = spark.createDataFrame([("https://x/?s=",)], "url string")
    assert [r.season_url for r in expand_seasons(leagues, F.col("url"), 2024, 2024).collect()] == ["https://x/?s=2024"]


def test_serving_keeps_columns_that_later_batches_lack(spark, scratch):
    table = ServingTable(scratch, ["k"], ["ts"], mode=MERGE)
    table.apply(spark.createDataFrame([(1, 1, "a", "b")], "k int, ts int, a string, b string"), 0)
    table.apply(spark.createDataFrame([(1, 2, "c")], "k int, ts int, a string"), 1)
    assert [(r.a, r.b) for r in table.read(spark).collect()] == [("c", "b")]
    table.compact(spark)
    table.apply(spark.createDataFrame([(1, 3, "d")], "k int, ts int, b string"), 2)
    table.apply(spark.createDataFrame([(1, 4, "e")], "k int, ts int, a string"), 3)
    assert [(r.a, r.b) for r in table.read(spark).collect()] == [("e", "d")]


def test_serving_two_writers_and_numbers_that_start_again(spark, scratch):
    table = ServingTable(scratch, ["k"], ["ts"])
    row = lambda k, ts: spark.createDataFrame([(k, ts)], "k int, ts int")
    table.apply(row(1, 1), 0, "first")
    table.apply(row(2, 1), 0, "second")
    table.compact(spark)
    table.apply(row(3, 1), 0, "third")
    assert sorted(r.k for r in table.read(spark).collect()) == [1, 2, 3]


def test_serving_applies_a_batch_repeated_after_compaction(spark, scratch):
    table = ServingTable(scratch, ["k"], ["ts"], mode=MERGE)
    value = lambda v: spark.createDataFrame([(1, 1, v)], "k int, ts int, v string")
    table.apply(value("old"), 0)
    table.apply(value("newer"), 1)
    table.compact(spark)
    table.apply(value("rerun"), 0)
    assert [r.v for r in table.read(spark).collect()] == ["rerun"]
    table.compact(spark)
    table.compact(spark)
    table.vacuum(spark, keep=1)
    assert [r.v for r in table.read(spark).collect()] == ["rerun"]
