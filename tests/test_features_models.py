"""Native features against their spark.ml counterparts; fits, saving and scoring."""

import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidewright import contracts as C
from tidewright.operators import features as ft
from tidewright.operators import models as M
from tidewright.operators.metrics import regression_metrics
from tidewright.plans import bindings as B

SF = "/root/testdata/sf0.001"


# --- splits ------------------------------------------------------------------------


def test_split_shares_and_stability(spark):
    df = spark.range(0, 2_000_000, 100).withColumn("g", F.when(F.col("id") % 3 == 0, "a").otherwise("b"))
    split = ft.with_split(df, F.col("id"))
    shares = {r.split: r["count"] / 20000 for r in split.groupBy("split").count().collect()}
    assert abs(shares["train"] - 0.8) < 0.02
    other = ft.with_split(df.repartition(7), F.col("id"))
    assert other.exceptAll(split).isEmpty()
    strata = ft.with_stratified_split(df, F.col("g"), F.col("id")).groupBy("g", "split").count().collect()
    totals = {"a": 6667, "b": 13333}
    for r in strata:
        assert abs(r["count"] / totals[r.g] - ft.TRAIN_VALIDATION_TEST[r.split] / 100) < 0.02
    with pytest.raises(ValueError):
        ft.with_split(df, F.col("id"), {"a": 50, "b": 40})


def test_split_of_extreme_keys(spark):
    keys = spark.createDataFrame([(k,) for k in (0, -1, 2**63 - 1, -(2**63), 2**31 - 1)], "k long")
    got = keys.select(ft.hash_percent(F.col("k")).alias("p")).collect()
    assert all(0 <= r.p < 100 for r in got)
    assert ft.with_stratified_split(keys, F.lit("x"), F.col("k")).filter("split IS NULL").isEmpty()


# --- indexes -----------------------------------------------------------------------


@pytest.fixture
def labelled(spark):
    rng = random.Random(1)
    values = [rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(500)]
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string").repartition(5)


def test_frequency_index_equals_string_indexer(spark, labelled):
    fitted = StringIndexer(inputCol="c", outputCol="x").fit(labelled)
    ours = ft.frequency_index(labelled, "c").orderBy("label_index").collect()
    assert [r.label for r in ours] == list(fitted.labels)
    assert [r.label_index for r in ours] == [float(i) for i in range(len(ours))]


def test_frequency_index_over_many_range_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3000).select((F.col("id") % 1000).cast("string").alias("c"))
        ours = ft.frequency_index(df, "c").orderBy("label_index").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.label for r in ours] == sorted(str(i) for i in range(1000))
    assert [r.label_index for r in ours] == [float(i) for i in range(1000)]


def test_unseen_labels(spark):
    train = spark.createDataFrame([("b",), ("b",), ("a",)], "c string")
    fresh = spark.createDataFrame([("a",), ("new",), (None,)], "c string")
    labels = ft.frequency_index(train, "c")
    kept = [r.x for r in ft.apply_index(fresh, labels, "c", "x").collect()]
    assert sorted(kept) == [1.0, 2.0, 2.0]
    assert ft.apply_index(fresh, labels, "c", "x", "skip").count() == 1
    with pytest.raises(PySparkException, match="unseen label"):
        ft.apply_index(fresh, labels, "c", "x", "error").collect()


def test_one_hot_width_equals_encoder(spark):
    df = spark.createDataFrame([(float(i),) for i in range(7)], "x double")
    encoded = OneHotEncoder(inputCol="x", outputCol="v").fit(df).transform(df)
    ours = ft.one_hot(encoded.withColumn("slots", vector_to_array("v")), "x", 7, "h").collect()
    assert all(list(r.slots) == [r[f"h_{i}"] for i in range(6)] for r in ours)
    assert len(ours[0].slots) == 6


def test_one_hot_gives_every_label_its_own_slot_when_unseen_is_kept(spark):
    seen = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    fresh = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    theirs = StringIndexer(inputCol="c", outputCol="i", handleInvalid="keep").fit(seen)
    encoder = OneHotEncoder(inputCol="i", outputCol="v").fit(theirs.transform(seen))
    want = sorted((str(r.c), *r.s) for r in encoder.transform(theirs.transform(fresh)).select("c", vector_to_array("v").alias("s")).collect())
    codes = ft.frequency_index(seen, "c")
    ours = ft.one_hot(ft.apply_index(fresh, codes, "c", "x"), "x", codes.count() + 1, "h")
    assert sorted((str(r.c), r.h_0, r.h_1) for r in ours.collect()) == want
    assert ("b", 0.0, 1.0) in want


# --- scaling -------------------------------------------------------------------------


def test_standard_scale_equals_scaler(spark):
    df = spark.createDataFrame([(float(i), float(i * i), 5.0) for i in range(20)], "a double, b double, c double")
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="v").transform(df)
    theirs = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(vectors).transform(vectors)
    ours = ft.standard_scale(theirs.withColumn("s", vector_to_array("s")), ["a", "b", "c"]).collect()
    for r in ours:
        assert all(math.isclose(x, y, abs_tol=1e-9) for x, y in zip(r.s, (r.a_scaled, r.b_scaled, r.c_scaled)))


def test_scale_fitted_on_train_only(spark):
    train = spark.createDataFrame([(0.0,), (2.0,)], "a double")
    fresh = spark.createDataFrame([(3.0,)], "a double")
    assert math.isclose(ft.standard_scale(fresh, ["a"], fitted_on=train).first().a_scaled, 2 / math.sqrt(2))


def test_assemble_skips_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (float("nan"), 1.0)], "a double, b double")
    assert [tuple(r.features) for r in ft.assemble(df, ["a", "b"]).collect()] == [(1.0, 2.0)]


# --- metrics ---------------------------------------------------------------------------


def test_metrics_equal_evaluator(spark):
    rng = random.Random(3)
    rows = [("ab"[i % 2], rng.uniform(0, 10), rng.uniform(0, 10)) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, label double, prediction double")
    ours = regression_metrics(df).first()
    for metric in ("rmse", "mse", "r2"):
        evaluator = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName=metric)
        assert math.isclose(ours[metric], evaluator.evaluate(df), rel_tol=1e-9)
    assert {r.g: r.row_count for r in regression_metrics(df, by=["g"]).collect()} == {"a": 100, "b": 100}
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "label double, prediction double")
    assert regression_metrics(flat).first().r2 is None


# --- models ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def line_rows(spark):
    return B.players(B.table(spark, SF, "lineitem")).cache()


@pytest.fixture(scope="module")
def player_model(spark, line_rows):
    regressor = M.forest(numTrees=5, maxDepth=5, labelCol="market_value")
    return M.fit(M.player_pipeline(regressor), M.training_players(line_rows))


def test_linear_recovers_a_line(spark, scratch):
    df = spark.createDataFrame([(float(i), "uvw"[i % 3], 3.0 * i + 7) for i in range(200)],
                               "n double, c string, label double")
    model = M.fit(M.encoded_pipeline(M.linear(maxIter=50, regParam=0.0), ["n"], "c"), df)
    scored = model.transform(df)
    names = M.assembled_names(scored)
    assert names[0] == "n" and len(names) == 3
    weights = {r.feature: r.weight for r in M.coefficients(spark, model, names).collect()}
    assert math.isclose(weights["n"], 3.0, rel_tol=1e-4) and math.isclose(weights["intercept"], 7.0, rel_tol=1e-2)
    M.save(model, scratch)
    again = M.load(scratch).transform(df)
    assert again.select("n", "prediction").exceptAll(scored.select("n", "prediction")).isEmpty()
    with pytest.raises(Exception, match="already exists"):
        M.save(model, scratch, overwrite=False)


def test_literal_vector_is_scored(spark):
    from pyspark.ml.regression import LinearRegression
    train = spark.createDataFrame([(Vectors.dense([float(i), 1.0]), 2.0 * i) for i in range(20)],
                                  ["features", "label"])
    probe = spark.createDataFrame([(Vectors.dense([50.0, 1.0]),)], ["features"])
    assert math.isclose(LinearRegression().fit(train).transform(probe).first().prediction, 100.0, rel_tol=1e-3)


def test_scored_rows_follow_the_contract(spark, line_rows, player_model):
    requests = B.players_to_score(B.table(spark, SF, "lineitem")).withColumn(
        "kafka_ingest_timestamp", F.current_timestamp())
    scored = M.score_players(requests, player_model)
    assert scored.columns == C.PLAYER_SCORED.columns
    assert [f.dataType for f in scored.schema.fields] == [f.dataType for f in C.PLAYER_SCORED.schema.fields]
    assert scored.filter("predicted_market_value IS NULL").isEmpty() and not scored.isEmpty()
    assert scored.filter("position = 'Goalkeeper'").isEmpty()
    assert not scored.filter("position IS NULL").isEmpty()


def test_forest_beats_the_mean(line_rows, player_model):
    rows = M.training_players(line_rows)
    assert regression_metrics(player_model.transform(rows), "market_value").first().r2 > 0.5


def test_price_bands(spark):
    rng = random.Random(5)
    rows = [(float(d), "xy"[d % 2], 1000.0 * (d % 2) + rng.random(), 10.0 * d) for d in range(200)]
    df = spark.createDataFrame(rows, "day double, kind string, buy double, sell double")
    scored = df
    for target in ("buy", "sell"):
        scored = M.fit_bands(df, ["day"], "kind", target, bands=4, maxIter=60).transform(scored)
    assert scored.columns == [*df.columns, "predicted_buy", "predicted_sell"]
    assert regression_metrics(scored, "sell", "predicted_sell").first().r2 > 0.5


def test_cross_validation_picks_a_setting(spark, line_rows):
    regressor = M.forest(numTrees=3, labelCol="market_value")
    search = M.cross_validate(M.player_pipeline(regressor), {regressor.maxDepth: [1, 5]},
                              M.training_players(line_rows), label="market_value")
    assert len(search.avgMetrics) == 2 and search.avgMetrics[1] < search.avgMetrics[0]


def test_boosted_market_value_pipeline(line_rows):
    rows = line_rows.withColumn("contract_value_time", F.col("contract_value_time").try_cast("float"))
    pipeline = M.scaled_pipeline(M.boosted(maxIter=3, labelCol="market_value"), M.MARKET_NUMBERS, M.MARKET_CATEGORIES)
    scored = M.fit(pipeline, rows).transform(rows)
    assert regression_metrics(scored, "market_value").first().r2 > 0.3


def test_label_tables_score_as_the_indexer(spark, scratch):
    rows = B.customer_players(B.table(spark, SF, "customer")).withColumn("contract_value_time", F.col("contract_value_time").try_cast("float"))
    train = rows.filter(~F.col("player_id").endswith("3"))
    regressor = M.exact_line(labelCol="market_value", regParam=0.1)
    usual = M.fit(M.scaled_pipeline(regressor, M.MARKET_NUMBERS, M.MARKET_CATEGORIES), train).transform(rows)
    fitted = M.fit_labelled(regressor, train, M.MARKET_NUMBERS, M.MARKET_CATEGORIES, scratch)
    assert not any("StringIndexer" in type(s).__name__ for s in fitted.model.stages)
    M.save_labelled(fitted, scratch)
    ours = M.load_labelled(spark, scratch, M.MARKET_CATEGORIES).transform(rows)

    def table(df):
        numbers = [f"{c}_index" for c in M.MARKET_CATEGORIES]
        return {r.player_id: ([r[c] for c in numbers], round(r.prediction, 4)) for r in df.select("player_id", "prediction", *numbers).collect()}
    assert table(ours) == table(usual) and len(table(ours)) > 50


def test_folds_belong_to_rows(spark):
    rows = spark.range(3000).withColumn("label", F.col("id") * 2.0 + 1)
    first = {r.id: r.fold for r in M.with_folds(rows, F.col("id")).collect()}
    again = {r.id: r.fold for r in M.with_folds(rows.repartition(7), F.col("id")).collect()}
    assert first == again and set(first.values()) == {0, 1, 2}


def test_one_fit_serves_a_session(spark, monkeypatch):
    from tidewright.plans import model_queries as Q
    asked = []
    monkeypatch.setattr(Q, "trained", lambda spark, sf, kind: asked.append(kind) or kind)
    monkeypatch.setattr(Q, "_FITTED", {})
    assert [Q.fitted_once(spark, "a", "x"), Q.fitted_once(spark, "a", "x"), Q.fitted_once(spark, "b", "x")] == ["x"] * 3 and len(asked) == 2


def test_preview_is_ordered(spark):
    df = spark.createDataFrame([(i,) for i in (3, 1, 2)], "i int")
    assert [r.i for r in M.sample_rows(df, ["i"], 2).collect()] == [1, 2]


def test_queries_fit_with_the_full_settings(spark, monkeypatch):
    from tidewright.plans import model_queries as Q
    from tidewright.plans.catalog import QUERIES
    forest = Q.scoring_model(spark, "/root/testdata/sf0.001").stages[-1]
    assert (forest.getNumTrees, forest.getOrDefault("maxDepth"), forest.getOrDefault("maxBins")) == (100, 20, 32)
    asked = []

    def trained(spark, sf, kind, **settings):
        asked.append((kind, settings))
        raise InterruptedError

    monkeypatch.setattr(Q, "trained", trained)
    for name in ("fit_device_sales", "fit_player_forest", "fit_device_forest"):
        with pytest.raises(InterruptedError):
            QUERIES[name](spark, "unused")
    assert asked == [("device_boosted", {}), ("player_forest", {}), ("device_forest", {})]


# --- forests that do not fit the driver -----------------------------------------------------


def grown_rows(spark, n=600):
    rng = random.Random(11)
    rows = [(i, rng.uniform(0, 10), float(rng.randrange(5)), rng.uniform(-1, 1)) for i in range(n)]
    return spark.createDataFrame([(i, a, b, c, 10 * a + 7 * (b == 2) + c) for i, a, b, c in rows], "k int, a double, b double, c double, label double")


def test_branch_equals_a_whole_tree():
    """Every row alone in its leaf, equal rows in one leaf with their mean."""
    import numpy as np
    from tidewright.operators import grown as G
    rng = np.random.default_rng(4)
    bins = rng.permutation(200).astype(np.uint8)[:, None]
    bins = np.concatenate([bins, rng.integers(0, 3, (200, 1), dtype=np.uint8)], axis=1)
    y, w = rng.normal(size=200) * 100, rng.integers(1, 4, 200).astype(float)
    feature, cut, left, value = G.grow(bins, y, w, 1, 60, 1, 0, 2)
    got = value[G.walk(feature, cut, left, bins)]
    assert np.allclose(got, y)
    feature, cut, left, value = G.grow(bins[:, 1:], y, w, 1, 20, 1, 0, 1)
    got = value[G.walk(feature, cut, left, bins[:, 1:])]
    for b in range(3):
        own = bins[:, 1] == b
        assert np.allclose(got[own], np.average(y[own], weights=w[own]))
    # The first cut is the best of all.
    feature, cut, left, value = G.grow(bins, y, w, 1, 1, 1, 0, 2)
    def loss(f, c):
        sides = [bins[:, f] <= c, bins[:, f] > c]
        return sum(np.sum(w[s] * (y[s] - np.average(y[s], weights=w[s])) ** 2) for s in sides)
    every = {(f, c): loss(f, c) for f in range(2) for c in sorted(set(bins[:, f]))[:-1]}
    assert math.isclose(every[int(feature[0]), int(cut[0])], min(every.values()))


def test_summed_bins_give_the_cuts_of_sorted_rows():
    """Either way to find the best cuts of a level, nodes without a cut left out or of no gain."""
    import numpy as np
    from tidewright.operators import grown as G
    rng = np.random.default_rng(5)
    own, value = rng.integers(0, 9, 3000), rng.integers(0, 32, (3000, 3))
    own[own == 4] = 3
    value[own == 6] = 7
    w, y = rng.integers(1, 4, 3000).astype(float), rng.normal(size=3000) + value[:, 1]
    total = np.bincount(own, w, 9)
    y -= (np.bincount(own, w * y, 9) / np.maximum(total, 1))[own]
    found = [{n: (a, b, g) for n, a, b, g in zip(*find(own, value, w, w * y, total, 32), strict=True) if g > 0} for find in (G._counted, G._sorted)]
    assert [*found[0]] == [*found[1]] == [0, 1, 2, 3, 5, 7, 8]
    for n, (a, b, g) in found[0].items():
        assert found[1][n][:2] == (a, b) and math.isclose(found[1][n][2], g, rel_tol=1e-6)


def test_device_rows_are_cleaned_once(spark, scratch):
    """What fits read is a table of cleaned rows, cleaned on all cores; the rows are those of the plain steps."""
    from tidewright.operators.clean import clean_products, typed_devices
    from tidewright.plans import model_queries as Q
    part = spark.range(40).coalesce(1).selectExpr(
        "IF(id % 9 = 0, null, id div 2) AS p_partkey", "IF(id % 7 = 0, null, concat('red ', id, ' box')) AS p_name", "concat('Brand#', id % 3) AS p_brand",
        "IF(id % 5 = 0, null, 'TIN') AS p_type", "CAST(IF(id % 11 = 0, null, id % 50) AS INT) AS p_size", "IF(id % 13 = 0, null, id * 1.5D) AS p_retailprice")
    part.write.parquet(f"{scratch}/part.parquet")
    got = Q.source(spark, scratch, "device_forest")
    want = typed_devices(clean_products(B.devices(B.table(spark, scratch, "part"))))
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert all("/cleaned-" in f for f in got.inputFiles()) and len(got.inputFiles()) > 1
    spark.range(9).coalesce(1).selectExpr("id AS c_custkey", "'a' AS c_name", "1 AS c_nationkey", "id * 2D AS c_acctbal", "'b' AS c_mktsegment").write.parquet(
        f"{scratch}/customer.parquet")
    assert Q.source(spark, scratch, "player_forest").rdd.getNumPartitions() > 1


def test_forest_beyond_the_driver(spark, scratch, monkeypatch):
    """Above the limit a forest is grown in tasks, saved, loaded and scores as well as that of spark.ml."""
    from tidewright.operators import grown as G
    rows = grown_rows(spark)
    train, test = rows.filter("k % 4 > 0"), rows.filter("k % 4 = 0")

    def fitted():
        return M.fit(M.scaled_pipeline(M.forest("forest_player", numTrees=20, maxDepth=8, seed=3), ["a", "b", "c"]), train)

    def error(model):
        return regression_metrics(model.transform(test)).first().rmse
    usual = fitted()
    assert not isinstance(usual.stages[-1], G.GrownForest)
    monkeypatch.setattr(G, "WHOLE_LEAVES", 100)
    errors = [error(usual)]
    for most in (G.LOCAL_ROWS, 60):  # whole trees in a task; cut level by level first
        monkeypatch.setattr(G, "LOCAL_ROWS", most)
        model = fitted()
        assert isinstance(model.stages[-1], G.GrownForest) and model.stages[-1].getNumTrees == 20
        errors.append(error(model))
    assert max(len(t.roots()) for t in model.stages[-1].tops) > 4
    assert max(errors) < 1.25 * min(errors)
    M.save(model, f"{scratch}/model")
    scores = [{(r.k, r.prediction) for r in m.transform(rows.union(rows)).select("k", "prediction").collect()} for m in (model, M.load(f"{scratch}/model"))]
    assert scores[0] == scores[1] and len(scores[0]) == 600
    again = {(r.k, round(r.prediction, 9)) for r in fitted().transform(rows).select("k", "prediction").collect()}
    assert again == {(k, round(p, 9)) for k, p in scores[0]}


def test_search_over_forests_beyond_the_driver(spark, monkeypatch):
    from tidewright.operators import grown as G
    monkeypatch.setattr(G, "WHOLE_LEAVES", 100)
    regressor = M.forest("forest_player", numTrees=4)
    search = M.cross_validate(M.scaled_pipeline(regressor, ["a", "b", "c"]), {regressor.maxDepth: [1, 6]}, grown_rows(spark))
    assert isinstance(search.bestModel.stages[-1], G.GrownForest) and search.avgMetrics[1] < search.avgMetrics[0]


def test_stream_scored_by_a_forest_beyond_the_driver(spark, line_rows, scratch, monkeypatch):
    from tidewright.operators import grown as G
    from tidewright.operators.decode import encode_json
    from tidewright.sources.topics import FolderTopic
    from tidewright.streaming import pipelines as P
    from tidewright.streaming.serving import ServingTable
    monkeypatch.setattr(G, "WHOLE_LEAVES", 100)
    model = M.fit(M.player_pipeline(M.forest(numTrees=3, maxDepth=6, labelCol="market_value")), M.training_players(line_rows))
    requests = B.as_requests(B.customer_players(B.table(spark, SF, "customer")))
    want = M.score_players(requests.withColumn("kafka_ingest_timestamp", F.current_timestamp()), model)
    topic = FolderTopic(f"{scratch}/topic")
    monkeypatch.setattr(P.jobs, "new_messages", lambda spark, topic, checkpoint: topic.read_stream(spark))
    topic.publish(encode_json(requests, F.col("player_id")))
    P.run_scoring(spark, model, topic, f"{scratch}/served", f"{scratch}/cp", every=None)
    served = ServingTable(f"{scratch}/served", C.PLAYER_SCORED.key, C.PLAYER_SCORED.order).read(spark)
    got = {r.player_id: round(r.predicted_market_value, 6) for r in served.collect()}
    assert got == {r.player_id: round(r.predicted_market_value, 6) for r in want.collect()} and len(got) > 50


def test_boosting_beyond_the_driver(spark, monkeypatch):
    """Boosting draws nothing, so above the limit it gives the scores of spark.ml, however nodes are spread."""
    from tidewright.operators import grown as G
    rows = spark.createDataFrame([(i, float(i * 7 % 23), float(i % 5), (i * 7 % 23) ** 2 + 30.0 * (i % 5 == 2)) for i in range(300)],
                                 "k int, a double, b double, label double")

    def scores():
        model = M.fit(M.scaled_pipeline(M.boosted("boosted_device", maxIter=12, maxDepth=3), ["a", "b"]), rows)
        return model.stages[-1], {r.k: r.prediction for r in model.transform(rows).select("k", "prediction").collect()}
    usual, want = scores()
    assert not isinstance(usual, G.GrownForest)
    monkeypatch.setattr(G, "WHOLE_LEAVES", 10)
    for most in (G.LOCAL_ROWS, 100):
        monkeypatch.setattr(G, "LOCAL_ROWS", most)
        model, got = scores()
        assert isinstance(model, G.GrownForest) and len(got) == 300
        assert all(math.isclose(got[k], want[k], rel_tol=1e-6) for k in want)


def test_rounds_in_a_task_equal_rounds_of_jobs(spark, scratch, monkeypatch):
    """One task boosts all rounds, no job between two of them; more values than it may hold are boosted round by round, to the same scores."""
    from tidewright.operators import grown as G
    rows = spark.range(400).selectExpr("id AS k", "id * 7 % 23 + 0D AS a", "id % 5 + 0D AS b", "id * 31 % 401 + 0D AS label")
    monkeypatch.setattr(G, "WHOLE_LEAVES", 10)
    monkeypatch.setattr(G, "LOCAL_ROWS", 100)
    calls, jobs_of_a_round = [], G.grown
    monkeypatch.setattr(G, "grown", lambda *a: calls.append(1) or jobs_of_a_round(*a))

    def scores():
        model = M.fit(M.scaled_pipeline(M.boosted("boosted_device", maxIter=11, maxDepth=6), ["a", "b"]), rows)
        return model, {r.k: r.prediction for r in model.transform(rows).select("k", "prediction").collect()}
    model, got = scores()
    assert not calls and model.stages[-1].getNumTrees == 11 and len(got) == 400
    # Whole trees are summed in bundles; branch by branch gives the same scores, and no row is none.
    trees, keys = model.stages[-1], spark.createDataFrame([(bytearray([i % 9, i % 5]),) for i in range(45)], "_bins binary")
    bundled = {bytes(r["_bins"]): r.prediction for r in trees._scored(keys).collect()}
    with monkeypatch.context() as m:
        m.setattr(G, "all", lambda some: False, raising=False)
        single = {bytes(r["_bins"]): r.prediction for r in trees._scored(keys).collect()}
    assert len(bundled) == 45 and all(math.isclose(bundled[k], single[k], rel_tol=1e-9, abs_tol=1e-9) for k in single) and len(single) == 45
    assert trees._scored(keys.limit(0)).count() == 0
    monkeypatch.setattr(G, "TASK_VALUES", 100)
    want = scores()[1]
    assert len(calls) == 11 and all(math.isclose(got[k], want[k], rel_tol=1e-6, abs_tol=1e-6) for k in want)
    M.save(model, f"{scratch}/model")
    again = {r.k: r.prediction for r in M.load(f"{scratch}/model").transform(rows).select("k", "prediction").collect()}
    assert again == got


@pytest.mark.parametrize("features", [3, 11])
def test_rounds_in_a_task_cut_as_a_branch(features, monkeypatch):
    """Nodes cut one by one, level by level from sums or from sorted rows: the trees of the plain branch, and every row kept."""
    import numpy as np
    from tidewright.operators import boosting as K, grown as G
    rng = np.random.default_rng(7)
    bins = rng.integers(0, 20, (3000, features), dtype=np.uint8)
    bins[:40] = bins[40:80]
    label = np.where(bins[:, 0] == 3, 500.0, 0.0) + bins[:, 1] ** 2 + rng.normal(size=3000)
    for branch_rows, sums in ((40_000, 4), (200, 4), (200, 0), (1, 4)):
        monkeypatch.setattr(K, "BRANCH_ROWS", branch_rows)
        monkeypatch.setattr(K, "SUMS_PER_VALUE", sums)
        left, total = label, np.zeros(3000)
        for number, nodes in enumerate(K.boosted(bins, label, 4, 9, 0.1)):
            plain = G.grow(bins, left, np.ones(3000), 1, 9, None, 0, features)
            found, want = nodes[3][G.walk(*nodes[:3], bins)], plain[3][G.walk(*plain[:3], bins)]
            assert len(nodes[0]) == len(plain[0]) and np.allclose(found, want, rtol=1e-6, atol=1e-6)
            total += found if number == 0 else 0.1 * found
            left = 2 * (label - total)
    # As branches: bit for bit the trees and labels of rounds whose trees are one branch each.
    left = label
    for number, nodes in enumerate(G.rounds_of_branches(bins, label, 3, 9, 0.1)):
        plain = G.grow(bins, left, np.ones(3000), 1, 9, None, 0, features)
        assert all((a == b).all() for a, b in zip(nodes, plain, strict=True))
        found = plain[3][G.walk(*plain[:3], bins)]
        left = 2 * (left - found) if number == 0 else left - 2 * 0.1 * found
    rows = K.tree(K._words(bins), label, 9, K._starts(bins))[1]
    kept = np.concatenate([K._bins(w)[:, :features] for w, _, _ in rows])
    assert sorted(map(bytes, kept)) == sorted(map(bytes, bins)) and math.isclose(sum(y.sum() for _, y, _ in rows), label.sum())


def test_bounds_of_few_and_many_values(spark):
    """Halfway between neighbours where a feature has as many values as bins or fewer, else quantiles; whatever the parts."""
    from tidewright.operators import grown as G
    rows = spark.range(1000).selectExpr("array(id % 4 + 0D, IF(id % 2 = 0, 0D, -0D), CAST(id AS DOUBLE), 5D) AS features")
    want = [[0.5, 1.5, 2.5], [], [124.5, 249.5, 374.5, 499.5, 624.5, 749.5, 874.5], []]
    for parts in (1, 7, 60):
        got = G.bounds(rows.repartition(parts), 8)
        assert got[:2] == want[:2] and got[3] == [] and all(abs(a - b) <= 1 for a, b in zip(got[2], want[2], strict=True))


def test_player_forest_of_thousands_of_rows_leaves_the_driver(spark):
    """A hundred trees of depth 20 on 2,500 rows: kept whole, ten thousand such rows no longer fit a driver of 1 GB."""
    from tidewright.operators import grown as G
    rows = spark.range(2500).selectExpr("id % 50 + 0D AS a", "id * 7 % 1009 + 0D AS b", "id * 31 % 2503 + 0D AS label")
    model = M.fit(M.scaled_pipeline(M.forest("forest_player", seed=3), ["a", "b"]), rows).stages[-1]
    assert isinstance(model, G.GrownForest) and model.getNumTrees == 100


def test_perceptron_counts_equal_rows(spark, monkeypatch):
    """Above the limit equal rows are counted and the steps are those of spark.ml; no row is left out."""
    from tidewright.operators import perceptron as P
    # One part of 50 whole blocks, over which spark.ml takes the same mean.
    raw = spark.range(6400).coalesce(1).selectExpr("id", "id % 31 / 15D - 1 AS a", "id % 5 / 2D - 1 AS b",
                                                   "cast((id % 31) div 8 + CASE WHEN id % 5 = 2 AND id % 3 > 0 THEN 1 ELSE 0 END AS double) AS label")
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(raw).persist()

    def fitted(steps):
        return P.Perceptron(layers=[2, 6, 5], maxIter=steps, blockSize=128, seed=3).fit(rows)

    def tried(model):
        return {r.id: r.prediction for r in model.transform(rows).select("id", "prediction").collect()}
    usual, later = fitted(8), tried(fitted(60))
    called = []
    monkeypatch.setattr(P, "PLAIN_ROWS", 100)
    monkeypatch.setattr(P, "TASK_ROWS", 50)
    monkeypatch.setattr(P, "least", lambda *a, f=P.least: called.append(a) or f(*a))
    assert usual.weights.toArray() == pytest.approx(fitted(8).weights.toArray(), rel=1e-5) and called
    found = tried(fitted(60))
    assert sum(found[k] == v for k, v in later.items()) > 0.9 * 6400
    monkeypatch.setattr(P, "PLAIN_ROWS", 6400)
    called.clear()
    fitted(2)
    assert not called
    rows.unpersist()
