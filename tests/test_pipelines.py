"""Whole jobs per domain, as the command line starts them."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidewright import contracts as C
from tidewright.__main__ import main, topic_of
from tidewright.operators import models as M
from tidewright.operators import quality
from tidewright.operators.decode import encode_json
from tidewright.operators.metrics import regression_metrics
from tidewright.operators.project import align_to
from tidewright.operators.training import TRAINERS, fit_tick_bands
from tidewright.plans import bindings as B
from tidewright.sources import tables
from tidewright.sources.topics import FolderTopic, KafkaTopic
from tidewright.streaming import pipelines as P

SF = "/root/testdata/sf0.001"


def messages(spark, domain):
    source = {"tick": lambda: B.ticks(B.table(spark, SF, "events")),
              "device": lambda: B.devices(B.table(spark, SF, "part")),
              "phone": lambda: B.devices(B.table(spark, SF, "part")),
              "player": lambda: B.players(B.table(spark, SF, "lineitem")),
              "player_csv": lambda: B.players(B.table(spark, SF, "lineitem"))
              .withColumn("player_id", F.monotonically_increasing_id())
              .withColumn("processing_timestamp", F.col("crawl_timestamp"))
              .withColumn("contract_value_time", F.col("contract_value_time").cast("float"))}[domain]()
    rows = align_to(source, P.DOMAINS[domain].contract.schema)
    if domain.startswith("player"):  # a few days of crawling, not seven years of dates
        stamp = P.DOMAINS[domain].order[0]
        rows = rows.withColumn(stamp, F.col(stamp) % (3 * 86_400_000))
    return rows


@pytest.mark.parametrize("domain", sorted(P.DOMAINS))
def test_raw_and_speed_jobs(spark, scratch, domain):
    topic = FolderTopic(f"{scratch}/topic")
    sent = messages(spark, domain)
    topic.publish(encode_json(sent))
    for job in ("raw", "speed"):
        assert main([job, "--domain", domain, "--topic", f"folder:{topic.path}", "--path", f"{scratch}/{job}",
                     "--checkpoint", f"{scratch}/cp-{job}", "--drain"]) == 0
    raw = tables.scan(spark, f"{scratch}/raw")
    whole = quality.complete_stats(sent) if domain == "player" else sent
    assert raw.count() == whole.count()
    assert set(P.DOMAINS[domain].partitions) <= set(raw.columns)
    assert main(["compact-serving", "--domain", domain, "--path", f"{scratch}/speed"]) == 0
    served = P.serving(P.DOMAINS[domain], f"{scratch}/speed").read(spark)
    keys = P.DOMAINS[domain].key
    assert served.select(*keys).distinct().count() == served.count() > 0
    assert "view_type" in served.columns


def test_daily_view_job(spark, scratch):
    topic = FolderTopic(f"{scratch}/topic")
    topic.publish(encode_json(messages(spark, "tick")))
    P.run_raw(spark, P.DOMAINS["tick"], topic, f"{scratch}/raw", f"{scratch}/cp", every=None)
    for version, days in enumerate(("10", "all")):
        main(["daily-view", days, "--raw", f"{scratch}/raw", "--path", f"{scratch}/view",
              "--as-of", "2024-01-31", "--version", str(version)])
        view = P.ServingTable(f"{scratch}/view", ["doc_id"], ["price_date"], "merge").read(spark)
        first = view.agg(F.min("price_date")).first()[0]
        assert first == ("2024-01-21" if days == "10" else "2024-01-01")
    assert view.agg(F.sum("record_count")).first()[0] == messages(spark, "tick").count()


def test_score_and_relay_jobs(spark, scratch):
    model = TRAINERS["player_forest"].fit(B.players(B.table(spark, SF, "lineitem")), numTrees=3, maxDepth=4).model
    M.save(model, f"{scratch}/model")
    requests, scored = FolderTopic(f"{scratch}/requests"), FolderTopic(f"{scratch}/scored")
    rows = B.players_to_score(B.table(spark, SF, "lineitem"))
    requests.publish(encode_json(rows.limit(5)))
    P.run_scoring(spark, model, requests, f"{scratch}/served", f"{scratch}/cp", every=None)  # first start skips these
    requests.publish(encode_json(rows))
    assert main(["score", "--model", f"{scratch}/model", "--topic", f"folder:{requests.path}",
                 "--path", f"{scratch}/served", "--checkpoint", f"{scratch}/cp", "--drain"]) == 0
    served = P.ServingTable(f"{scratch}/served", C.PLAYER_SCORED.key, C.PLAYER_SCORED.order).read(spark)
    P.run_scoring_to_topic(spark, model, requests, scored, f"{scratch}/cp-topic", every=None)
    requests.publish(encode_json(rows))
    P.run_scoring_to_topic(spark, model, requests, scored, f"{scratch}/cp-topic", every=None)
    P.run_relay(spark, scored, f"{scratch}/relayed", f"{scratch}/cp-relay", every=None, starting="earliest")
    relayed = P.ServingTable(f"{scratch}/relayed", C.PLAYER_SCORED.key, C.PLAYER_SCORED.order).read(spark)
    ids = ["player_id"]
    assert served.count() == relayed.count() > 0
    assert served.select(*ids).exceptAll(relayed.select(*ids)).isEmpty()


def test_train_export_view_and_compact_jobs(spark, scratch, capsys):
    B.ticks(B.table(spark, SF, "events")).write.parquet(f"{scratch}/ticks")
    main(["train", "tick_linear", "--raw", f"{scratch}/ticks", "--model", f"{scratch}/model"])
    assert "train" in capsys.readouterr().out and M.load(f"{scratch}/model").stages
    main(["predict-tick", "--model", f"{scratch}/model", "--date", "2024-02-01", "--type", "click", "--buy", "20000"])
    assert 15_000 < float(capsys.readouterr().out.strip().splitlines()[-1]) < 25_000
    main(["train-bands", "--raw", f"{scratch}/ticks", "--model", f"{scratch}/bands"])
    assert {M.load_bands(spark, f"{scratch}/bands/{t}").target for t in ("buy_price", "sell_price")} == {"buy_price", "sell_price"}
    main(["export-csv", "--input", f"{scratch}/ticks", "--output", f"{scratch}/csv"])
    assert spark.read.option("header", True).csv(f"{scratch}/csv").columns == C.TICK.columns
    main(["view", f"{scratch}/ticks", "--rows", "2"])
    assert "rows: " in capsys.readouterr().out


def test_csv_to_topic(spark, scratch):
    spark.createDataFrame([("A", "x"), (None, "y")], "name string, brand string").write.option(
        "header", True).csv(f"{scratch}/csv")
    contract = C.Contract("small", C.struct((C.STRING, "name brand"), (C.LONG, "sent")))
    topic = FolderTopic(f"{scratch}/topic")
    P.publish_csv(spark, f"{scratch}/csv", contract, topic, "name", "sent")
    values = [bytes(r.value).decode() for r in spark.read.parquet(topic.path).collect()]
    assert len(values) == 1 and '"name":"A","brand":"x","sent":1' in values[0]


def test_validated_csv_to_topic(spark, scratch):
    rows = [("A", 1.0), ("B", -1.0), (None, 2.0), ("C", None), ("A", 3.0)]
    spark.createDataFrame(rows, "name string, price double").coalesce(1).write.option("header", True).csv(f"{scratch}/csv")
    contract = C.Contract("small", C.struct((C.STRING, "name"), (C.DOUBLE, "price"), (C.LONG, "sent")))
    topic = FolderTopic(f"{scratch}/topic")
    rules = {"no_price": F.col("price").isNull(), "bad_price": F.col("price") < 0}
    counts = P.publish_csv_validated(spark, f"{scratch}/csv", contract, topic, "name", rules, f"{scratch}/rejects", "sent")
    assert {(r.reason, r.row_count) for r in counts.collect()} == {("accepted", 2), ("bad_price", 1), ("no_price", 1), ("no_name", 1)}
    assert sorted(bytes(r.key).decode() for r in spark.read.parquet(topic.path).collect()) == ["A", "A"]
    refused = spark.read.parquet(f"{scratch}/rejects/rows").collect()
    assert sorted((r.name or "", r.reject_reasons) for r in refused) == [("", ["no_name"]), ("B", ["bad_price"]), ("C", ["no_price"])]


@pytest.mark.parametrize("kind", ["device_forest", "device_boosted", "market_forest"])
def test_trainers(spark, kind):
    from tidewright.plans.model_queries import source
    small = {"numTrees": 3, "maxDepth": 4} if "forest" in kind else {"maxIter": 2, "maxDepth": 3}
    done = TRAINERS[kind].fit(source(spark, SF, kind), **small)
    splits = {r.split for r in done.metrics().collect()}
    assert splits == ({"train", "validation", "test"} if kind == "device_boosted" else {"train", "test"})


def test_band_models_survive_saving(spark, scratch):
    ticks = B.ticks(B.table(spark, SF, "events"))
    fitted, scored = fit_tick_bands(ticks, maxIter=5)
    assert {"predicted_buy_price", "predicted_sell_price"} <= set(scored.columns)
    M.save_bands(spark, fitted["buy_price"], scratch)
    again = M.load_bands(spark, scratch).transform(scored.drop("predicted_buy_price"))
    assert again.select("seq", "predicted_buy_price").exceptAll(scored.select("seq", "predicted_buy_price")).isEmpty()
    assert regression_metrics(scored, "buy_price", "predicted_buy_price").first().row_count == ticks.count()


def test_counters_without_an_extra_job(spark):
    seen = Observation("quality")
    df = spark.range(10).withColumn("x", F.col("id") - 2)
    rules = {"negative": F.col("x") < 0}
    quality.observed(df, seen, rules).write.format("noop").mode("overwrite").save()
    assert seen.get == {"row_count": 10, "rejected_count": 2}


def test_topic_addresses():
    assert topic_of("kafka:a:9092,b:9092/prices") == KafkaTopic("a:9092,b:9092", "prices")
    assert topic_of("folder:/x/y") == FolderTopic("/x/y")
    with pytest.raises(Exception, match="folder:PATH"):
        topic_of("prices")
