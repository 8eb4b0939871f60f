"""The training jobs: rows in, fitted pipeline and metrics of every split out."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators import features as ft
from tidewright.operators import models as M
from tidewright.operators.metrics import regression_metrics
from tidewright.operators.quality import nonempty, require_values

CALENDAR = ["year", "month", "day"]
TICK_NUMBERS = ["buy_price", *CALENDAR]


def row_key(*columns: str) -> Column:
    """A number that stays with a row, from the columns that tell rows apart."""
    return ft.text_number(F.concat_ws("|", *columns))


@dataclass(frozen=True)
class Trainer:
    """How one model is made: which rows, which split, which pipeline."""

    prepare: Callable[[DataFrame], DataFrame]
    key: Sequence[str]
    label: str
    pipeline: Callable[..., Estimator]
    regressor: Callable[..., Estimator]
    shares: Mapping[str, int] | None = None
    stratum: str | None = None

    def rows(self, source: DataFrame) -> DataFrame:
        ready, key = self.prepare(source), row_key(*self.key)
        shares = self.shares or ft.TRAIN_TEST
        if self.stratum:
            return ft.with_stratified_split(ready, F.col(self.stratum), key, shares)
        return ft.with_split(ready, key, shares)

    def fit(self, source: DataFrame, **settings) -> Trained:
        rows = self.rows(source)
        train = nonempty(rows.filter(F.col("split") == "train"))
        model = M.fit(self.pipeline(self.regressor(labelCol=self.label, **settings)), train)
        return Trained(model, rows, self.label)


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    rows: DataFrame
    label: str

    def scored(self) -> DataFrame:
        return self.model.transform(self.rows)

    def metrics(self) -> DataFrame:
        """Training, validation and test quality from one pass over the rows."""
        return regression_metrics(self.scored(), self.label, by=["split"])


def _with_label(label: str, cast: Sequence[str] = ()) -> Callable[[DataFrame], DataFrame]:
    def prepare(rows: DataFrame) -> DataFrame:
        known = require_values(rows, [label])
        return known.withColumns({c: F.col(c).try_cast("float") for c in cast}) if cast else known
    return prepare


def tick_rows(ticks: DataFrame) -> DataFrame:
    dated = ft.calendar_features(ticks)
    return require_values(dated, [*TICK_NUMBERS, "gold_type", "sell_price"]).withColumn(
        "label", F.col("sell_price").cast("double"))


def _market(regressor: Estimator) -> Estimator:
    return M.scaled_pipeline(regressor, M.MARKET_NUMBERS, M.MARKET_CATEGORIES)


def _device(regressor: Estimator) -> Estimator:
    return M.scaled_pipeline(regressor, M.DEVICE_NUMBERS, M.DEVICE_CATEGORIES)


def _setting(make: Callable, name: str) -> Callable:
    return lambda **settings: make(name, **settings)


_MARKET_ROWS = _with_label("market_value", ["contract_value_time"])
_DEVICE_KEY = ("product_id", "crawl_timestamp")

TRAINERS = {
    "player_forest": Trainer(M.training_players, ["player_id"], "market_value", M.player_pipeline,
                             _setting(M.forest, "forest_player")),
    "market_forest": Trainer(_MARKET_ROWS, ["player_id"], "market_value", _market,
                             _setting(M.forest, "forest_market_value")),
    "market_boosted": Trainer(_MARKET_ROWS, ["player_id"], "market_value", _market,
                              _setting(M.boosted, "boosted_market_value")),
    "device_forest": Trainer(_with_label("sold"), _DEVICE_KEY, "sold", _device,
                             _setting(M.forest, "forest_device")),
    "device_boosted": Trainer(_with_label("sold"), _DEVICE_KEY, "sold", _device,
                              _setting(M.boosted, "boosted_device"),
                              shares=ft.TRAIN_VALIDATION_TEST, stratum="category"),
    "tick_linear": Trainer(tick_rows, ["crawl_timestamp", "gold_type", "source"], "label",
                           lambda regressor: M.encoded_pipeline(regressor, TICK_NUMBERS, "gold_type"), M.linear),
}


def fit_tick_bands(ticks: DataFrame, **settings) -> tuple[dict[str, M.BandModel], DataFrame]:
    """One perceptron per price, and every row with both predictions side by side."""
    rows = ft.with_split(tick_rows(ticks), row_key("crawl_timestamp", "gold_type", "source"))
    train = nonempty(rows.filter(F.col("split") == "train"))
    fitted = {t: M.fit_bands(train, CALENDAR, "gold_type", t, **settings) for t in ("buy_price", "sell_price")}
    scored = rows
    for model in fitted.values():
        scored = model.transform(scored)
    return fitted, scored
