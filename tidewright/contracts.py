"""One declared schema per entity, plus the column views each target expects.

Every message is one flat JSON object; every field is nullable. A contract also
names the natural key and the columns that decide which of two rows is newer.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

STRING, INT, LONG, FLOAT, DOUBLE = (
    T.StringType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()
)
DATE, TIMESTAMP = T.DateType(), T.TimestampType()


def struct(*groups: tuple[T.DataType, str]) -> T.StructType:
    """Build a schema from ``(type, "name name ...")`` groups, keeping their order."""
    return T.StructType(
        [T.StructField(name, dtype, True) for dtype, names in groups for name in names.split()]
    )


@dataclass(frozen=True)
class Contract:
    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


# --- fixed values: field lists shared by several entities --------------------
STAT_COLUMNS = (
    "appearances PPG goals assists own_goals substitutions_on substitutions_off yellow_cards "
    "second_yellow_cards red_cards penalty_goals minutes_per_goal minutes_played "
    "goals_conceded clean_sheet"
).split()
FIELD_STAT_COLUMNS = STAT_COLUMNS[:13]
FEATURE_COLUMNS = ["age", *FIELD_STAT_COLUMNS, "player_height"]
LOG_COLUMNS = ["appearances", "goals", "assists", "minutes_played", "minutes_per_goal"]
VALID_FEET = ["left", "right", "both"]
EXCLUDED_POSITION = "Goalkeeper"
# -----------------------------------------------------------------------------

TICK = Contract(
    "tick",
    struct((LONG, "crawl_timestamp"), (STRING, "price_date gold_type"), (INT, "buy_price sell_price"),
           (STRING, "source")),
    key=("price_date", "gold_type", "source"),
    order=("crawl_timestamp",),
)

DEVICE = Contract(
    "device",
    struct((LONG, "crawl_timestamp"), (INT, "product_id"),
           (STRING, "name brand category color price price_old RAM ROM percent rating sold source")),
    key=("product_id", "category"),
    order=("crawl_timestamp",),
)

PHONE = Contract(
    "phone",
    struct((STRING, "name brand capacity RAM ROM model screen_size resolution new_price old_price "
                    "percent rating sold"),
           (LONG, "crawl_timestamp"), (STRING, "source")),
    key=("name",),
    order=("crawl_timestamp",),
)

PLAYER = Contract(
    "player",
    struct((STRING, "player_id name player_club"), (FLOAT, "age"), (STRING, "position goalkeeper_or_not"),
           (FLOAT, "market_value"), (STRING, "nationality"), (FLOAT, "player_height"),
           (STRING, "player_agent strong_foot contract_value_time"), (FLOAT, " ".join(STAT_COLUMNS)),
           (LONG, "crawl_timestamp"), (STRING, "source")),
    key=("player_id",),
    order=("crawl_timestamp",),
    defaults={"player_agent": "None"},
)

PLAYER_CSV = Contract(
    "player_csv",
    struct((LONG, "processing_timestamp"), (INT, "player_id"), (STRING, "name player_club"), (FLOAT, "age"),
           (STRING, "position"), (FLOAT, "market_value"), (STRING, "nationality"),
           (FLOAT, "player_height"), (STRING, "player_agent strong_foot"),
           (FLOAT, "contract_value_time"), (FLOAT, " ".join(FIELD_STAT_COLUMNS)), (STRING, "source_file")),
    key=("player_id",),
    order=("processing_timestamp",),
)

PLAYER_TO_SCORE = Contract(
    "player_to_score",
    struct((STRING, "player_id player_name club position strong_foot"),
           (FLOAT, " ".join(FEATURE_COLUMNS)),
           (STRING, "nationality contract_value_time goalkeeper_or_not"),
           (FLOAT, "goals_conceded clean_sheet market_value"),
           (LONG, "ingest_timestamp_manual"), (STRING, "source source_type")),
    key=("player_id",),
    order=("ingest_timestamp_manual",),
)

PLAYER_SCORED = Contract(
    "player_scored",
    struct((STRING, "player_id player_name club"), (FLOAT, "age"), (STRING, "position strong_foot"),
           (FLOAT, " ".join(FIELD_STAT_COLUMNS)), (FLOAT, "player_height"),
           (STRING, "nationality contract_value_time goalkeeper_or_not"),
           (FLOAT, "goals_conceded clean_sheet"), (DOUBLE, "predicted_market_value"),
           (TIMESTAMP, "kafka_ingest_timestamp"), (LONG, "ingest_timestamp_manual"),
           (TIMESTAMP, "spark_processing_timestamp @timestamp"),
           (STRING, "source_type original_source")),
    key=("player_id",),
    order=("ingest_timestamp_manual", "kafka_ingest_timestamp"),
)

# --- target views: what each table holds, in order ---------------------------
TICK_SPEED = Contract(
    "tick_speed",
    struct((LONG, "crawl_timestamp"), (STRING, "gold_type"), (INT, "buy_price sell_price"), (STRING, "source"),
           (TIMESTAMP, "@timestamp"), (DATE, "price_date_dt"), (STRING, "view_type")),
)

DAILY_VIEW = Contract(
    "daily_view",
    struct((STRING, "price_date gold_type"), (DOUBLE, "avg_buy_price avg_sell_price"),
           (INT, "min_buy_price max_buy_price min_sell_price max_sell_price"), (LONG, "record_count"),
           (STRING, "view_type doc_id")),
    key=("doc_id",),
)

DEVICE_SPEED = Contract(
    "device_speed",
    struct((LONG, "crawl_timestamp"), (INT, "product_id"), (STRING, "name brand category color"),
           (FLOAT, "price price_old"), (STRING, "RAM ROM"), (INT, "percent"), (FLOAT, "rating"),
           (INT, "sold"), (STRING, "source"), (TIMESTAMP, "@timestamp"), (STRING, "view_type")),
    key=("product_id", "category"),
    order=("crawl_timestamp",),
)

PHONE_SPEED = Contract(
    "phone_speed",
    struct((STRING, "name brand capacity RAM ROM model screen_size resolution new_price old_price "
                    "percent rating sold source"),
           (LONG, "crawl_timestamp"), (TIMESTAMP, "@timestamp"), (DATE, "crawl_date_dt"),
           (STRING, "view_type")),
    key=("name",),
    order=("crawl_timestamp",),
)

PLAYER_SPEED = Contract(
    "player_speed",
    T.StructType([*PLAYER.schema.fields, T.StructField("@timestamp", TIMESTAMP), T.StructField("view_type", STRING)]),
    key=("player_id",),
    order=("crawl_timestamp",),
)

PLAYER_CSV_SPEED = Contract(
    "player_csv_speed",
    T.StructType([*PLAYER_CSV.schema.fields, T.StructField("@timestamp", TIMESTAMP),
                  T.StructField("view_type", STRING)]),
    key=("player_id",),
    order=("processing_timestamp",),
)

PLAYER_RAW = Contract(
    "player_raw",
    T.StructType([f for f in PLAYER.schema.fields if f.name not in ("player_agent", "source")]
                 + [T.StructField(p, INT) for p in ("year", "month", "day")]),
    key=("player_id",),
    order=("crawl_timestamp",),
)

DEVICE_CSV = Contract(
    "device_csv",
    struct((STRING, "name brand category color price price_old RAM ROM percent rating sold")),
)

# Envelope of one message on a topic, as the Kafka source delivers it.
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", STRING),
    T.StructField("partition", INT),
    T.StructField("offset", LONG),
    T.StructField("timestamp", TIMESTAMP),
    T.StructField("timestampType", INT),
])
