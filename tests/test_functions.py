"""Edge values of the column helpers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewright.functions import dates as D
from tidewright.functions import numbers as N
from tidewright.functions import text as X


def values(spark, inputs, expression, dtype="string"):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, x {dtype}")
    return [r[0] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


@pytest.mark.parametrize("expression, inputs, expected", [
    (N.to_float, ["N/A", "29990000.0", "", "1.5", None], [None, 29990000.0, None, 1.5, None]),
    (N.to_int_truncating, ["4.9", "4200", "-4.9", "x", "99999999999", "1e3", " 7 ", ".5", None],
     [4, 4200, -4, None, None, None, 7, 0, None]),
    (N.money_thousands, ["€1.50m", "€800k", "€5", "-", "€2.00m Last update", "€1.5mk", None],
     [1500.0, 800.0, 5.0, None, 2000.0, None, None]),
    (N.abbreviated_count, ["1,2k", "163,1K", "42", "", "sold 3,5k", "x", None],
     [1200, 163100, 42, None, 3500, None, None]),
    (N.thousands, ["1,234,500", "42", "1.5", ",", "12a", "", None], [1234500, 42, None, None, None, None, None]),
    (N.digits_only, ["29.990.000₫", "abc", "", None], ["29990000", "N/A", "N/A", "N/A"]),
    (N.decimal_comma, ["1,85 m", "1,85", "tall", None], [1.85, 1.85, None, None]),
    (N.stat_value, ["-", "12", "90'", "x", "", None], [0.0, 12.0, 90.0, None, None, None]),
    (X.url_id, ["https://a.b/x/123", "https://a.b/x/123?q=1", "https://a.b/x/12a", "https://a.b/x/9#t", None],
     ["123", "123", None, "9", None]),
    (X.url_slug, ["https://a.b/some name/profil/spieler/1", "https://a.b/x"], ["some-name", "x"]),
    (X.last_word, ["a  b\tc ", "one", "", None], ["c", "one", None, None]),
    (X.strip_bom, ["\ufeffname", "name"], ["name", "name"]),
])
def test_text_helpers(spark, expression, inputs, expected):
    assert values(spark, inputs, expression) == expected


def test_height_units(spark):
    assert values(spark, [185.0, 1.85, 10.0, None], N.height_metres, "double") == [1.85, 1.85, 10.0, None]


def test_log1p_domain(spark):
    from tidewright.operators.features import log_features
    df = spark.createDataFrame([(1, 0.0), (2, -1.0), (3, None)], "i int, x double")
    got = [r.x_log for r in log_features(df, ["x"]).orderBy("i").collect()]
    assert got == [0.0, None, None]


def test_nan_and_infinity_to_null(spark):
    inputs = [1.0, float("nan"), float("inf"), float("-inf"), None]
    assert values(spark, inputs, N.nan_to_null, "double") == [1.0, None, None, None, None]


def test_discount(spark):
    df = spark.createDataFrame(
        [(1, 5.0, 0.0), (2, 30.0, 20.0), (3, 1.0, 3.0), (4, None, 3.0), (5, 1.0, -2.0), (6, 1.0, None)],
        "i int, new double, old double")
    got = df.select("i", N.discount_percent(F.col("new"), F.col("old")).alias("p")).orderBy("i").collect()
    assert [r.p for r in got] == [0, -50, 66, None, 0, None]


@pytest.mark.parametrize("name, ram, rom", [
    ("X 12GB/256GB", "12GB", "256GB"), ("X 256GB", None, "256GB"), ("X 4G", None, None), ("256GB", None, None),
    ("Galaxy S25 Edge 5G 8GB/1TB", "8GB", "1TB"), (None, None, None),
])
def test_storage_of_name(spark, name, ram, rom):
    df = spark.createDataFrame([(name,)], "name string")
    row = df.select(*[v.alias(k) for k, v in X.storage_of_name(F.col("name")).items()]).first()
    assert (row.RAM, row.ROM) == (ram, rom)


def test_parts_of_name(spark):
    df = spark.createDataFrame([(1, "Apple iPhone 16 Pro 128GB"), (2, "Nokia 105"), (3, "Nokia"), (4, "")],
                               "i int, name string")
    rows = df.select("i", *[v.alias(k) for k, v in X.parts_of_name(F.col("name")).items()]).orderBy("i").collect()
    assert [tuple(r)[1:] for r in rows] == [
        ("Apple", "iPhone 16 Pro", "128GB"), ("Nokia", None, "105"), ("Nokia", None, None), (None, None, None)]


def test_dates(spark):
    assert values(spark, ["2025-02-28", "2025-02-30", "bad", None], D.iso_date) == [
        dt.date(2025, 2, 28), None, None, None]
    assert values(spark, [1735689599999, None], D.date_of_millis, "long") == [dt.date(2024, 12, 31), None]
    assert values(spark, [dt.date(2025, 3, 9)], D.day_first, "date") == ["09/03/2025"]
