"""Regression training, evaluation and scoring with spark.ml pipelines.

The split comes first and every stage is fitted on the training part only. The
whole pipeline, from label index to regressor, is saved as one artefact, so a
scorer needs nothing else.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, QuantileDiscretizer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from tidewright.contracts import FEATURE_COLUMNS, LOG_COLUMNS, PLAYER_SCORED
from tidewright.functions import dates as D
from tidewright.operators.features import apply_index, frequency_index, hash_percent, log_features, log_names
from tidewright.operators.grown import Boosted, Forest
from tidewright.operators.perceptron import Perceptron
from tidewright.operators.project import project_contract
from tidewright.operators.quality import all_of, outfield_lenient, outfield_strict
from tidewright.operators.views import repaired_height

SEED = 42
# Training rows per part; the number of parts follows from the rows alone, as trees draw rows per part.
PART_ROWS = 50_000

# --- fixed values: regressor settings by use ------------------------------------------
SETTINGS = {
    "linear": dict(maxIter=10, regParam=0.3, elasticNetParam=0.8),
    "forest_player": dict(numTrees=100, maxDepth=20, maxBins=32),
    "forest_device": dict(numTrees=50, maxDepth=20, seed=SEED),
    "forest_market_value": dict(numTrees=100, maxDepth=10, featureSubsetStrategy="auto", seed=SEED),
    "boosted_device": dict(maxIter=200, maxDepth=15, stepSize=0.05, seed=SEED),
    "boosted_market_value": dict(maxIter=20, maxDepth=5, stepSize=0.1, seed=SEED),
    "perceptron": dict(maxIter=150, blockSize=128, solver="l-bfgs", seed=SEED),
}
HIDDEN_LAYERS = [16, 12]
# device pipeline
DEVICE_CATEGORIES = ["brand", "category", "color", "RAM", "ROM"]
DEVICE_NUMBERS = ["price", "price_old", "percent"]
# market value pipeline
MARKET_CATEGORIES = ["player_club", "position", "nationality", "player_agent", "strong_foot"]
MARKET_NUMBERS = [
    "age", "player_height", "contract_value_time", "appearances", "PPG", "goals", "assists", "own_goals",
    "substitutions_on", "substitutions_off", "yellow_cards", "second_yellow_cards", "red_cards", "penalty_goals",
    "minutes_per_goal", "minutes_played",
]
# -----------------------------------------------------------------------------------------


@contextmanager
def kept(df: DataFrame):
    """Training rows held in memory and on disk while a fit reads them.

    They are dealt by their values to as many parts as their number asks for and sorted, so
    trees draw the same rows whatever the machine and the layout of the input.
    """
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    parts = df.repartition(max(1, -(-df.count() // PART_ROWS)), *[F.col(f"`{c}`") for c in plain])
    held = parts.sortWithinPartitions(*[F.col(f"`{c}`") for c in plain]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def linear(**overrides) -> LinearRegression:
    return LinearRegression(**{**SETTINGS["linear"], **overrides})


def forest(setting: str = "forest_market_value", **overrides) -> Forest:
    return Forest(**{**SETTINGS[setting], **overrides})


def boosted(setting: str = "boosted_market_value", **overrides) -> Boosted:
    return Boosted(**{**SETTINGS[setting], **overrides})


def exact_line(**overrides) -> LinearRegression:
    """Least squares without a penalty, by the normal equations."""
    return LinearRegression(**{"solver": "normal", "regParam": 0.0, "elasticNetParam": 0.0, **overrides})


def stump(**overrides) -> DecisionTreeRegressor:
    """A tree of one cut; a column of at most ``maxBins`` values is cut exactly."""
    return DecisionTreeRegressor(**{"maxDepth": 1, "maxBins": 64, "seed": SEED, **overrides})


# --- pipelines -------------------------------------------------------------------------


def scaled_pipeline(regressor, numbers: Sequence[str], categories: Sequence[str] = ()) -> Pipeline:
    """Index categories (unseen kept), assemble (NULL rows skipped), standardise, regress."""
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep") for c in categories]
    assembler = VectorAssembler(inputCols=[*numbers, *[f"{c}_index" for c in categories]],
                                outputCol="raw_features", handleInvalid="skip")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    return Pipeline(stages=[*indexers, assembler, scaler, regressor])


def encoded_pipeline(regressor, numbers: Sequence[str], category: str, invalid: str = "error") -> Pipeline:
    """Index and one-hot one category (last one dropped), assemble behind the numbers, regress."""
    return Pipeline(stages=[
        StringIndexer(inputCol=category, outputCol=f"{category}_index", handleInvalid=invalid),
        OneHotEncoder(inputCol=f"{category}_index", outputCol=f"{category}_encoded"),
        VectorAssembler(inputCols=[*numbers, f"{category}_encoded"], outputCol="features", handleInvalid="skip"),
        regressor,
    ])


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    with kept(train) as rows:
        return pipeline.fit(rows)


def save(model, path: str, overwrite: bool = True) -> None:
    writer = model.write().overwrite() if overwrite else model.write()
    writer.save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- label tables beside a model ----------------------------------------------------------


@dataclass(frozen=True)
class LabelledModel:
    """A pipeline over label numbers, and the table they come from: (column, label, label_count, label_index).

    The labels of a column are a table that is joined at scoring, so no column's labels are gathered
    on the driver or sent along with the model, however many there are.
    """

    model: PipelineModel
    labels: DataFrame
    categories: Sequence[str]

    def indexed(self, df: DataFrame) -> DataFrame:
        for c in self.categories:
            own = self.labels.filter(F.col("column") == c).select("label", "label_count", "label_index")
            df = apply_index(df, own, c, f"{c}_index", "keep")
        return df

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.indexed(df))


def label_table(df: DataFrame, categories: Sequence[str]) -> DataFrame:
    parts = [frequency_index(df, c).select(F.lit(c).alias("column"), "label", "label_count", "label_index") for c in categories]
    return reduce(DataFrame.unionByName, parts)


def fit_labelled(regressor, train: DataFrame, numbers: Sequence[str], categories: Sequence[str], path: str) -> LabelledModel:
    """Index categories from a table written to ``path``, assemble (NULL rows skipped), standardise, regress.

    Gives the scores of ``scaled_pipeline``, whose indexer numbers labels alike and keeps unseen ones.
    """
    label_table(train, categories).write.partitionBy("column").parquet(f"{path}/labels")
    labels = read_labels(train.sparkSession, path)
    prepared = LabelledModel(PipelineModel(stages=[]), labels, list(categories))
    pipeline = scaled_pipeline(regressor, [*numbers, *[f"{c}_index" for c in categories]])
    return LabelledModel(fit(pipeline, prepared.indexed(train)), labels, list(categories))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    schema = "label string, label_count long, label_index double, `column` string"
    return spark.read.schema(schema).parquet(f"{path}/labels")


def save_labelled(labelled: LabelledModel, path: str) -> None:
    """The fitted stages beside the label table, which ``fit_labelled`` wrote to the same path."""
    save(labelled.model, f"{path}/model", overwrite=False)


def load_labelled(spark: SparkSession, path: str, categories: Sequence[str]) -> LabelledModel:
    return LabelledModel(load(f"{path}/model"), read_labels(spark, path), list(categories))


# --- price bands with a perceptron --------------------------------------------------------


@dataclass(frozen=True)
class BandModel:
    """Classifier over quantile bands of a target; its prediction is the band's mean."""

    model: PipelineModel
    band_means: Mapping[int, float]
    target: str

    def transform(self, df: DataFrame) -> DataFrame:
        pairs = [F.lit(v) for k, m in sorted(self.band_means.items()) for v in (float(k), float(m))]
        guess = F.element_at(F.create_map(*pairs), F.col(f"{self.target}_class"))
        scored = self.model.transform(df).withColumn(f"predicted_{self.target}", guess)
        extras = [f"{self.target}_{k}" for k in ("class", "raw", "probability", "raw_features", "features", "band")]
        return scored.drop(*extras, "_category_index", "_category_encoded")


def save_bands(spark: SparkSession, bands: BandModel, path: str) -> None:
    """The fitted stages and, beside them, the mean of each band; fails if the path exists."""
    save(bands.model, f"{path}/model", overwrite=False)
    means = [(bands.target, int(k), float(v)) for k, v in bands.band_means.items()]
    spark.createDataFrame(means, "target string, band int, mean double").write.parquet(f"{path}/bands")


def load_bands(spark: SparkSession, path: str) -> BandModel:
    # As many rows as the network has classes.
    rows = spark.read.parquet(f"{path}/bands").collect()
    return BandModel(load(f"{path}/model"), {r.band: r.mean for r in rows}, rows[0].target)


def fit_bands(train: DataFrame, numbers: Sequence[str], category: str, target: str,
              bands: int = 8, **overrides) -> BandModel:
    """Network [inputs, 16, 12, bands] on quantile bands of ``target``.

    A classifier needs class labels 0..k-1, so the price is cut into bands first;
    every output column carries the target's name so two models can be chained.
    """
    with kept(train) as rows:
        prepare = Pipeline(stages=[
            StringIndexer(inputCol=category, outputCol="_category_index", handleInvalid="keep"),
            OneHotEncoder(inputCol="_category_index", outputCol="_category_encoded"),
            VectorAssembler(inputCols=[*numbers, "_category_encoded"], outputCol=f"{target}_raw_features",
                            handleInvalid="skip"),
            StandardScaler(inputCol=f"{target}_raw_features", outputCol=f"{target}_features",
                           withMean=True, withStd=True),
        ]).fit(rows)
        cutter = QuantileDiscretizer(inputCol=target, outputCol=f"{target}_band", numBuckets=bands,
                                     relativeError=0.001, handleInvalid="skip").fit(rows)
        ready = cutter.transform(prepare.transform(rows))
        # At most ``bands`` rows come back, whatever the input size.
        means = {int(r[0]): r[1] for r in
                 ready.groupBy(f"{target}_band").agg(F.avg(target)).collect()}
        width = len(prepare.stages[-1].mean)
        network = Perceptron(
            featuresCol=f"{target}_features", labelCol=f"{target}_band",
            predictionCol=f"{target}_class", rawPredictionCol=f"{target}_raw",
            probabilityCol=f"{target}_probability",
            layers=[width, *HIDDEN_LAYERS, len(cutter.getSplits()) - 1],
            **{**SETTINGS["perceptron"], **overrides},
        ).fit(ready)
    return BandModel(PipelineModel(stages=[*prepare.stages, network]), means, target)


# --- search and inspection ------------------------------------------------------------------


def with_folds(df: DataFrame, key: Column, folds: int = 3, name: str = "fold") -> DataFrame:
    """Adds a fold 0..folds-1 that belongs to the row, on any partitioning."""
    return df.withColumn(name, F.pmod(hash_percent(key), F.lit(folds)).cast("int"))


def fold_metrics(search: CrossValidatorModel, rows: DataFrame, label: str, fold: str = "fold") -> DataFrame:
    """fold, setting, row_count, rmse: each sub-model on the fold it has not seen. Needs ``keep_models``."""
    out = []
    for place, models in enumerate(search.subModels):
        held_out = rows.filter(F.col(fold) == place)
        for setting, model in enumerate(models):
            miss = (F.col("prediction") - F.col(label)) * (F.col("prediction") - F.col(label))
            out.append(model.transform(held_out).agg(F.count("*").alias("row_count"), F.sqrt(F.avg(miss)).alias("rmse")).select(
                F.lit(place).alias("fold"), F.lit(setting).alias("setting"), "row_count", "rmse"))
    return reduce(DataFrame.unionByName, out)


def cross_validate(pipeline: Pipeline, grid: Mapping, train: DataFrame, label: str = "label",
                   folds: int = 3, parallelism: int = 2, fold: str | None = None, keep_models: bool = False) -> CrossValidatorModel:
    """Grid search by k-fold RMSE; fits of one fold run side by side. ``fold`` names a column that holds each row's fold."""
    builder = ParamGridBuilder()
    for param, values in grid.items():
        builder = builder.addGrid(param, values)
    search = CrossValidator(
        estimator=pipeline, estimatorParamMaps=builder.build(), numFolds=folds, parallelism=parallelism, seed=SEED,
        evaluator=RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse"),
        collectSubModels=keep_models, **({"foldCol": fold} if fold else {}),
    )
    with kept(train) as rows:
        return search.fit(rows)


def coefficients(spark: SparkSession, model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """Weights of a linear model as rows, the intercept among them."""
    fitted = model.stages[-1]
    rows = [(n, float(w)) for n, w in zip(names, fitted.coefficients.toArray(), strict=True)]
    return spark.createDataFrame([*rows, ("intercept", float(fitted.intercept))], "feature string, weight double")


def assembled_names(scored: DataFrame, vector: str = "features") -> list[str]:
    """Slot names of an assembled vector, read from column metadata without a job."""
    attributes = scored.schema[vector].metadata["ml_attr"]["attrs"]
    slots = [a for group in attributes.values() for a in group]
    return [a["name"] for a in sorted(slots, key=lambda a: a["idx"])]


# --- player scoring -----------------------------------------------------------------------


def training_players(players: DataFrame, label: str = "market_value") -> DataFrame:
    """Rows fit for training: height in metres, outfield players, every feature and the label known."""
    ready = log_features(outfield_strict(repaired_height(players)), LOG_COLUMNS)
    needed = [*log_names(FEATURE_COLUMNS), label]
    return ready.filter(all_of([F.col(c).isNotNull() for c in needed]))


def scorable_players(players: DataFrame) -> DataFrame:
    """Rows fit for scoring: as for training, but an unknown position or foot passes."""
    ready = log_features(outfield_lenient(repaired_height(players)), LOG_COLUMNS)
    needed = [*log_names(FEATURE_COLUMNS), "player_id"]
    return ready.filter(all_of([F.col(c).isNotNull() for c in needed]))


def player_pipeline(regressor) -> Pipeline:
    return scaled_pipeline(regressor, log_names(FEATURE_COLUMNS))


def score_players(players: DataFrame, model: PipelineModel, ingest_time: str = "kafka_ingest_timestamp") -> DataFrame:
    """Messages to scored rows, for a table or a batch of a stream."""
    scored = model.transform(scorable_players(players))
    return project_contract(scored.withColumns({
        "predicted_market_value": F.col("prediction"),
        "kafka_ingest_timestamp": F.col(ingest_time),
        "spark_processing_timestamp": F.current_timestamp(),
        "@timestamp": D.from_millis(F.col("ingest_timestamp_manual")),
        "original_source": F.col("source"),
    }), PLAYER_SCORED)


def sample_rows(df: DataFrame, order: Sequence[str], rows: int = 10) -> DataFrame:
    """First rows in a total order, so a preview is the same every time."""
    return df.orderBy(*order).limit(rows)
