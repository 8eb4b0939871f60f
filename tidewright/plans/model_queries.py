"""Fits over whole tables with a held-out part, and batch scoring.

What SQL can say of a model is checked against it: the least-squares line, the best cut of a
stump, folds and the line's error on each, label numbers, and the rows and columns that pass
through scoring. Forests and boosted trees are checked by the unit tests: metrics against the
evaluator of spark.ml, save and load giving the same scores. A model that several queries need is fitted once per session.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidewright.operators import features as ft
from tidewright.operators import models as M
from tidewright.operators.clean import clean_products, typed_devices
from tidewright.operators.keyed import latest_per_key
from tidewright.operators.metrics import regression_metrics
from tidewright.operators.training import TRAINERS, Trained, fit_tick_bands
from tidewright.plans import bindings as B
from tidewright.plans.registry import query
from tidewright.session import scratch_path


# Parts per core that rows read by a fit are dealt to.
PARTS_PER_CORE = 2


def on_all_cores(rows):
    """A small file of many rows comes as one or two parts; its rows are cleaned and scored on all cores."""
    return rows.repartition(PARTS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism)


def cleaned_once(spark, rows):
    """Rows kept as a table: a fit counts, deals and scores them, and would clean all of them each time."""
    path = scratch_path(spark, "cleaned")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def source(spark, sf, kind):
    """The rows each trainer reads, from the given tables."""
    if kind.startswith("tick"):
        return B.ticks(B.table(spark, sf, "events"))
    if kind.startswith("device"):
        return cleaned_once(spark, typed_devices(clean_products(B.devices(on_all_cores(B.table(spark, sf, "part"))))))
    return B.customer_players(on_all_cores(B.table(spark, sf, "customer")))


def trained(spark, sf, kind, **settings):
    return TRAINERS[kind].fit(source(spark, sf, kind), **settings)


def metrics_of(kind):
    def build(spark, sf):
        return trained(spark, sf, kind).metrics().select(F.lit(kind).alias("model"), "*")
    return build


_FITTED: dict[tuple, Trained] = {}


def fitted_once(spark, sf, kind) -> Trained:
    """The fit of this session; queries that score share it."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _FITTED:
        _FITTED[key] = trained(spark, sf, kind)
    return _FITTED[key]


def scoring_model(spark, sf):
    return fitted_once(spark, sf, "player_forest").model


query("fit_linear")(metrics_of("tick_linear"))


@query("fit_player_forest")
def fit_player_forest(spark, sf):
    return fitted_once(spark, sf, "player_forest").metrics().select(F.lit("player_forest").alias("model"), "*")


query("fit_device_forest")(metrics_of("device_forest"))
query("fit_forest")(metrics_of("market_forest"))
query("fit_gbt")(metrics_of("market_boosted"))


@query("fit_device_sales")
def fit_device_sales(spark, sf):
    """Sold counts from prices and categories, split 70/10/20 inside each category."""
    done = trained(spark, sf, "device_boosted")
    return done.metrics().select(F.lit("device_boosted").alias("model"), "*")


@query("model_coefficients")
def model_coefficients(spark, sf):
    done = trained(spark, sf, "tick_linear")
    return M.coefficients(spark, done.model, M.assembled_names(done.scored()))


@query("fit_mlp_bands")
def fit_mlp_bands(spark, sf):
    fitted, scored = fit_tick_bands(source(spark, sf, "tick"))
    parts = [regression_metrics(scored, t, f"predicted_{t}", by=["split"]).select(F.lit(f"bands_{t}").alias("model"), "*")
             for t in fitted]
    return parts[0].unionByName(parts[1])


@query("fit_cv")
def fit_cv(spark, sf):
    rows = TRAINERS["player_forest"].rows(source(spark, sf, "player"))
    regressor = M.forest("forest_player", labelCol="market_value")
    grid = {regressor.numTrees: [70], regressor.maxDepth: [20], regressor.maxBins: [32]}
    search = M.cross_validate(M.player_pipeline(regressor), grid,
                              rows.filter(F.col("split") == "train"), label="market_value")
    done = Trained(search.bestModel, rows, "market_value")
    return done.metrics().select(F.lit("cross_validated").alias("model"), "*")


@query("score_batch")
def score_batch(spark, sf):
    path = scratch_path(spark, "player-model")
    M.save(scoring_model(spark, sf), path)
    return M.score_players(requests(spark, sf), M.load(path))


def requests(spark, sf):
    return B.as_requests(source(spark, sf, "player")).withColumn("kafka_ingest_timestamp", F.timestamp_millis("ingest_timestamp_manual"))


@query("score_batch_rows", "WITH " + B.CUSTOMER_PLAYERS_SQL + """
SELECT player_id, name AS player_name, player_club AS club, CAST(age AS DOUBLE) AS age, position, strong_foot, CAST(goals AS DOUBLE) AS goals,
       contract_value_time, crawl_timestamp AS ingest_timestamp_manual, crawl_timestamp * 1000 AS "@timestamp",
       crawl_timestamp * 1000 AS kafka_ingest_timestamp, 'table' AS source_type, source AS original_source, true AS has_prediction
FROM players WHERE (position IS NULL OR position <> 'Goalkeeper') AND (strong_foot IS NULL OR strong_foot IN ('left', 'right', 'both'))
  AND appearances IS NOT NULL""")
def score_batch_rows(spark, sf):
    """Which rows are scored by the saved model, and what passes through."""
    return score_batch(spark, sf).select(
        "player_id", "player_name", "club", "age", "position", "strong_foot", "goals", "contract_value_time", "ingest_timestamp_manual",
        "@timestamp", "kafka_ingest_timestamp", "source_type", "original_source", F.col("predicted_market_value").isNotNull().alias("has_prediction"))


# --- models that SQL can work out ----------------------------------------------------------

LINE_SQL = B.TICKS_SQL + """, line AS (
  SELECT regr_slope(CAST(sell_price AS DOUBLE), CAST(buy_price AS DOUBLE)) AS slope,
         regr_intercept(CAST(sell_price AS DOUBLE), CAST(buy_price AS DOUBLE)) AS intercept FROM ticks)"""


def line_rows(spark, sf):
    ticks = B.ticks(B.table(spark, sf, "events"))
    return ticks.select("seq", F.col("buy_price").cast("double").alias("buy_price"), F.col("sell_price").cast("double").alias("label"))


def line_pipeline():
    return Pipeline(stages=[VectorAssembler(inputCols=["buy_price"], outputCol="features"), M.exact_line()])


@query("fit_line", f"WITH {LINE_SQL} SELECT 'buy_price' AS feature, round(slope, 6) AS weight FROM line UNION ALL SELECT 'intercept', round(intercept, 4) FROM line")
def fit_line(spark, sf):
    weights = M.coefficients(spark, M.fit(line_pipeline(), line_rows(spark, sf)), ["buy_price"])
    return weights.select("feature", F.when(F.col("feature") == "intercept", F.round("weight", 4)).otherwise(F.round("weight", 6)).alias("weight"))


@query("score_line", f"WITH {LINE_SQL} SELECT seq, round(intercept + slope * buy_price, 3) AS prediction FROM ticks, line")
def score_line(spark, sf):
    """Predictions of the line after it was saved and loaded."""
    rows, path = line_rows(spark, sf), scratch_path(spark, "line")
    M.save(M.fit(line_pipeline(), rows), path)
    return M.load(path).transform(rows).select("seq", F.round("prediction", 3).alias("prediction"))


@query("fit_stump", """
WITH v AS (SELECT p_size AS x, count(*) AS n, sum(p_retailprice + p_size % 7 * 50) AS s FROM part GROUP BY p_size),
run AS (SELECT x, lead(x) OVER (ORDER BY x) AS next, sum(n) OVER (ORDER BY x) AS n_left, sum(s) OVER (ORDER BY x) AS s_left,
               sum(n) OVER () AS n_all, sum(s) OVER () AS s_all FROM v),
cuts AS (SELECT *, s_left * s_left / n_left + (s_all - s_left) * (s_all - s_left) / (n_all - n_left) AS gain FROM run WHERE next IS NOT NULL)
SELECT (x + next) / 2.0::DOUBLE AS cut, round(s_left / n_left, 4) AS mean_left, round((s_all - s_left) / (n_all - n_left), 4) AS mean_right,
       CAST(n_left AS BIGINT) AS n_left, CAST(n_all - n_left AS BIGINT) AS n_right
FROM cuts ORDER BY gain DESC, x LIMIT 1""")
def fit_stump(spark, sf):
    """The best single cut of prices by size, with the mean and the rows on either side."""
    rows = B.table(spark, sf, "part").select(F.col("p_size").cast("double").alias("size"), (F.col("p_retailprice") + F.col("p_size") % 7 * 50).alias("label"))
    model = M.fit(Pipeline(stages=[VectorAssembler(inputCols=["size"], outputCol="features"), M.stump()]), rows)
    root = model.stages[-1]._call_java("rootNode")
    cut = root.split().threshold()
    left = F.col("size") <= cut
    return model.transform(rows).agg(
        F.lit(float(cut)).alias("cut"), F.round(F.max(F.when(left, F.col("prediction"))), 4).alias("mean_left"),
        F.round(F.max(F.when(~left, F.col("prediction"))), 4).alias("mean_right"), F.count_if(left).alias("n_left"), F.count_if(~left).alias("n_right"))


@query("cv_folds", "WITH " + B.TICKS_SQL + """, f AS (
  SELECT CAST(((seq % 2147483647) * 2654435761 % 4294967296 >> 16) % 100 % 3 AS INTEGER) AS fold, CAST(buy_price AS DOUBLE) AS x, CAST(sell_price AS DOUBLE) AS y FROM ticks),
line AS (SELECT k AS fold, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM f, (VALUES (0), (1), (2)) AS folds(k) WHERE fold <> k GROUP BY k)
SELECT f.fold, 0 AS setting, count(*) AS row_count, round(sqrt(avg((intercept + slope * x - y) * (intercept + slope * x - y))), 5) AS rmse
FROM f JOIN line ON f.fold = line.fold GROUP BY f.fold""")
def cv_folds(spark, sf):
    """Rows and error of each fold of a cross-validated line; the fold is a column of the row."""
    rows = M.with_folds(line_rows(spark, sf), F.col("seq"))
    regressor = M.exact_line()
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=["buy_price"], outputCol="features"), regressor])
    search = M.cross_validate(pipeline, {regressor.regParam: [0.0]}, rows, fold="fold", keep_models=True)
    return M.fold_metrics(search, rows, "label").withColumn("rmse", F.round("rmse", 5))


@query("score_label_numbers", "WITH " + B.CUSTOMER_PLAYERS_SQL + ", t AS (SELECT * FROM players WHERE player_id NOT LIKE '%7')" + "".join(f""",
{c}_n AS (SELECT {c}, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS i FROM t WHERE {c} IS NOT NULL GROUP BY {c})""" for c in M.MARKET_CATEGORIES) + """
SELECT player_id, """ + ", ".join(f"coalesce({c}_n.i, (SELECT CAST(count(*) AS DOUBLE) FROM {c}_n)) AS {c}_index" for c in M.MARKET_CATEGORIES)
       + " FROM players p " + " ".join(f"LEFT JOIN {c}_n ON p.{c} = {c}_n.{c}" for c in M.MARKET_CATEGORIES) + " WHERE appearances IS NOT NULL")
def score_label_numbers(spark, sf):
    """The label table is fitted to nine tenths of the players, saved beside the model and joined when all are scored."""
    path = scratch_path(spark, "labelled")
    rows = source(spark, sf, "player").withColumn("contract_value_time", F.col("contract_value_time").try_cast("float"))
    regressor = M.exact_line(labelCol="market_value", regParam=0.1)
    fitted = M.fit_labelled(regressor, rows.filter(~F.col("player_id").endswith("7")), M.MARKET_NUMBERS, M.MARKET_CATEGORIES, path)
    M.save_labelled(fitted, path)
    scored = M.load_labelled(spark, path, M.MARKET_CATEGORIES).transform(rows)
    return scored.filter(F.col("prediction").isNotNull()).select("player_id", *[f"{c}_index" for c in M.MARKET_CATEGORIES])


@query("score_literal")
def score_literal(spark, sf):
    """Tomorrow's sell price per type, from the newest tick of each."""
    path = scratch_path(spark, "tick-model")
    M.save(trained(spark, sf, "tick_linear").model, path)
    newest = latest_per_key(B.ticks(B.table(spark, sf, "events")), ["gold_type"], ["crawl_timestamp", "seq"])
    tomorrow = newest.withColumn("price_date", F.lit(str(B.AS_OF + dt.timedelta(days=1))))
    scored = M.load(path).transform(ft.calendar_features(tomorrow))
    return scored.select("gold_type", "price_date", "buy_price", F.col("prediction").alias("predicted_sell_price"))


@query("sample_predictions")
def sample_predictions(spark, sf):
    scored = trained(spark, sf, "tick_linear").scored().filter(F.col("split") == "test").select(
        "seq", "price_date", "gold_type", "label", "prediction")
    return M.sample_rows(scored, ["seq"], 10)
