"""Columns of the cleaning jobs, and the extraction of records from pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.contracts import PHONE
from tidewright.functions import numbers as N
from tidewright.functions import text as X
from tidewright.operators import clean, views
from tidewright.operators.decode import decode_json, encode_json
from tidewright.operators.expand import date_spine, expand_seasons
from tidewright.plans import bindings as B
from tidewright.plans.registry import ORACLE_SQL, query
from tidewright.sources import pages as P


def _devices(spark, sf):
    return B.devices(B.table(spark, sf, "part"))


@query("tolerant_casts", "WITH " + B.DEVICES_SQL + """
SELECT product_id, CAST(TRY_CAST(price AS FLOAT) AS DOUBLE) AS price,
       CAST(TRY_CAST(price_old AS FLOAT) AS DOUBLE) AS price_old,
       CAST(trunc(TRY_CAST(rating AS DOUBLE)) AS INTEGER) AS percent,
       CAST(TRY_CAST(rating AS FLOAT) AS DOUBLE) AS rating,
       CASE WHEN regexp_matches(sold, '^[0-9]+$') THEN CAST(sold AS INTEGER) END AS sold
FROM devices""")
def tolerant_casts(spark, sf):
    raw = _devices(spark, sf).withColumn("percent", F.col("rating"))
    return clean.typed_devices(raw).select("product_id", "price", "price_old", "percent", "rating", "sold")


@query("unit_repair", """
SELECT p_partkey, CASE WHEN p_size > 10 THEN CAST(p_size AS DOUBLE) / 100 ELSE CAST(p_size AS DOUBLE) END AS height
FROM part""")
def unit_repair(spark, sf):
    return B.table(spark, sf, "part").select(
        "p_partkey", N.height_metres(F.col("p_size").cast("double")).alias("height"))


# --- texts of player pages, from part -----------------------------------------------------

MONEY = {
    "spark": "CASE p_partkey % 4 WHEN 0 THEN '-' WHEN 1 THEN concat('€', p_size, '.', p_partkey % 10, 'm Last update') "
             "WHEN 2 THEN concat('€', p_size, 'k') ELSE concat('€', p_partkey) END",
    "duckdb": "CASE p_partkey % 4 WHEN 0 THEN '-' WHEN 1 THEN '€' || p_size || '.' || (p_partkey % 10) || 'm Last update' "
              "WHEN 2 THEN '€' || p_size || 'k' ELSE '€' || p_partkey END",
}


@query("parse_money", f"""
WITH t AS (SELECT p_partkey, {MONEY['duckdb']} AS amount FROM part)
SELECT p_partkey, amount,
       CASE WHEN p_partkey % 4 = 1 THEN CAST(regexp_extract(amount, '([0-9.]+)m', 1) AS DOUBLE) * 1000
            WHEN p_partkey % 4 = 2 THEN CAST(regexp_extract(amount, '([0-9.]+)k', 1) AS DOUBLE)
            WHEN p_partkey % 4 = 3 THEN CAST(p_partkey AS DOUBLE) END AS market_value
FROM t""")
def parse_money(spark, sf):
    texts = B.table(spark, sf, "part").selectExpr("p_partkey", MONEY["spark"] + " AS amount")
    return texts.withColumn("market_value", N.money_thousands(F.col("amount")))


@query("clean_players", """
SELECT p_partkey, CAST(p_size AS DOUBLE) AS age,
       CASE WHEN p_partkey % 2 = 0 THEN (100 + p_size) / CAST(100 AS DOUBLE) ELSE (100 + p_size) / CAST(100 AS DOUBLE) END
         AS player_height,
       CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_size AS DOUBLE) ELSE 0 END AS goals,
       CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_partkey AS DOUBLE) END AS minutes_played,
       CASE WHEN p_partkey % 4 = 0 THEN 'None' ELSE p_brand END AS player_agent
FROM part""")
def clean_players(spark, sf):
    raw = B.table(spark, sf, "part").selectExpr(
        "p_partkey", "CAST(p_size AS STRING) AS age", MONEY["spark"] + " AS market_value",
        "CASE WHEN p_partkey % 2 = 0 THEN concat('1,', lpad(p_size, 2, '0'), ' m') "
        "ELSE CAST(100 + p_size AS STRING) END AS player_height",
        "CASE WHEN p_partkey % 3 = 0 THEN '-' ELSE CAST(p_size AS STRING) END AS goals",
        "CASE WHEN p_partkey % 5 = 0 THEN 'n/a' ELSE concat(p_partkey, '''') END AS minutes_played",
        "CASE WHEN p_partkey % 4 <> 0 THEN p_brand END AS player_agent",
    )
    return clean.clean_players(raw).select(
        "p_partkey", "age", "player_height", "goals", "minutes_played", "player_agent")


# --- texts of device tiles ------------------------------------------------------------------

SOLD_SQL = """CASE WHEN sold LIKE '%K' THEN CAST(trunc(CAST(replace(regexp_extract(sold, '([0-9,]+)K', 1), ',', '.')
              AS DECIMAL(18, 6)) * 1000) AS INTEGER) ELSE CAST(sold AS INTEGER) END"""
STORAGE_SQL = r"""nullif(regexp_extract(name, ' ([0-9]+(?:GB|TB))/([0-9]+(?:GB|TB))$', 1), '')"""
ROM_SQL = r"""nullif(regexp_extract(name, '[ /]([0-9]+(?:GB|TB))$', 1), '')"""


@query("parse_counts", "WITH " + B.DEVICES_SQL + f" SELECT product_id, sold, {SOLD_SQL} AS sold_count FROM devices")
def parse_counts(spark, sf):
    return _devices(spark, sf).select("product_id", "sold", N.abbreviated_count(F.col("sold")).alias("sold_count"))


@query("digits_only", "WITH " + B.DEVICES_SQL + """
SELECT product_id, coalesce(nullif(regexp_replace(price_old || ' đ', '[^0-9]', '', 'g'), ''), 'N/A') AS old_price,
       coalesce(nullif(regexp_replace(brand, '[^0-9]', '', 'g'), ''), 'N/A') AS brand_digits,
       coalesce(nullif(regexp_replace(color, '[^0-9]', '', 'g'), ''), 'N/A') AS color_digits
FROM devices""")
def digits_only(spark, sf):
    return _devices(spark, sf).select(
        "product_id", N.digits_only(F.concat("price_old", F.lit(" đ"))).alias("old_price"),
        N.digits_only(F.col("brand")).alias("brand_digits"), N.digits_only(F.col("color")).alias("color_digits"))


@query("parse_thousands", """
WITH t AS (SELECT s_suppkey, CASE WHEN s_suppkey % 9 = 0 THEN 'n/a' WHEN s_suppkey % 9 = 1 THEN ','
                  ELSE (s_suppkey + 10) || ',' || lpad(CAST(s_nationkey AS VARCHAR), 3, '0') END AS price FROM supplier)
SELECT s_suppkey, price, CASE WHEN s_suppkey % 9 > 1 THEN CAST(replace(price, ',', '') AS INTEGER) END AS amount
FROM t""")
def parse_thousands(spark, sf):
    texts = B.table(spark, sf, "supplier").selectExpr(
        "s_suppkey", "CASE WHEN s_suppkey % 9 = 0 THEN 'n/a' WHEN s_suppkey % 9 = 1 THEN ',' "
        "ELSE concat(s_suppkey + 10, ',', lpad(s_nationkey, 3, '0')) END AS price")
    return texts.withColumn("amount", N.thousands(F.col("price")))


@query("name_tokens", "WITH " + B.DEVICES_SQL + f"""
, w AS (SELECT *, string_split(name, ' ') AS words FROM devices)
SELECT product_id, words[1] AS brand, CASE WHEN len(words) >= 3 THEN array_to_string(words[2:-2], ' ') END AS model,
       CASE WHEN len(words) >= 2 THEN words[-1] END AS capacity, {STORAGE_SQL} AS "RAM", {ROM_SQL} AS "ROM"
FROM w""")
def name_tokens(spark, sf):
    name = F.col("name")
    return _devices(spark, sf).select(
        "product_id", *[v.alias(k) for k, v in {**X.parts_of_name(name), **X.storage_of_name(name)}.items()])


@query("discount_percent", "WITH " + B.DEVICES_SQL + """
, p AS (SELECT product_id, TRY_CAST(price AS DOUBLE) AS new, TRY_CAST(price_old AS DOUBLE) AS old FROM devices)
SELECT product_id, CASE WHEN old > 0 THEN CAST(trunc((old - new) / old * 100) AS INTEGER)
                        WHEN old <= 0 THEN 0 END AS percent FROM p""")
def discount_percent(spark, sf):
    new, old = N.plain_number(F.col("price")), N.plain_number(F.col("price_old"))
    return _devices(spark, sf).select("product_id", N.discount_percent(new, old).alias("percent"))


@query("default_fill", "WITH " + B.DEVICES_SQL + f"""
SELECT crawl_timestamp, product_id, name, brand, category, coalesce(color, 'N/A') AS color, price,
       coalesce(price_old, price) AS price_old, coalesce({STORAGE_SQL}, 'N/A') AS "RAM", coalesce({ROM_SQL}, 'N/A') AS "ROM",
       CAST(CAST(trunc((TRY_CAST(coalesce(price_old, price) AS DOUBLE) - TRY_CAST(price AS DOUBLE))
                 / TRY_CAST(coalesce(price_old, price) AS DOUBLE) * 100) AS INTEGER) AS VARCHAR) AS percent,
       coalesce(rating, '0') AS rating, CAST(coalesce({SOLD_SQL}, 0) AS VARCHAR) AS sold, source
FROM devices""")
def default_fill(spark, sf):
    return clean.clean_products(_devices(spark, sf))


@query("clean_phones", """
WITH t AS (SELECT p_partkey, p_name || ' Pro ' || CASE WHEN p_size % 2 = 0 THEN '8GB/' || (p_size % 5 * 64 + 64) || 'GB'
                  ELSE (p_size % 5 * 64 + 64) || 'GB' END AS name FROM part),
w AS (SELECT *, string_split(name, ' ') AS words FROM t)
SELECT w.p_partkey, name, words[1] AS brand, array_to_string(words[2:-2], ' ') AS model, words[-1] AS capacity,
       CASE WHEN p_size % 2 = 0 THEN '8GB' ELSE 'N/A' END AS "RAM",
       CASE WHEN p_size % 2 = 0 THEN split_part(words[-1], '/', 2) ELSE 'N/A' END AS "ROM",
       'N/A' AS screen_size, p_size || ' px' AS resolution, CAST(p_size * 1000 + 9990 AS VARCHAR) AS new_price,
       'N/A' AS old_price, '-' || p_size || '%' AS percent,
       CASE WHEN p_size % 3 = 0 THEN 'Chưa có đánh giá' ELSE '4.5' END AS rating,
       CASE WHEN p_size % 3 = 0 THEN 'N/A' ELSE CAST(p_size * 1000 AS VARCHAR) END AS sold
FROM w JOIN part ON w.p_partkey = part.p_partkey""")
def clean_phones(spark, sf):
    return clean.clean_phones(_phone_tiles(spark, sf))


def _phone_tiles(spark, sf):
    return B.table(spark, sf, "part").selectExpr(
        "p_partkey",
        "concat(p_name, ' Pro ', CASE WHEN p_size % 2 = 0 THEN concat('8GB/', p_size % 5 * 64 + 64, 'GB') "
        "ELSE concat(p_size % 5 * 64 + 64, 'GB') END) AS name",
        "CAST(NULL AS STRING) AS screen_size", "concat(p_size, ' px') AS resolution",
        "concat(p_size * 1000 + 9990, ' đ') AS new_price", "CAST(NULL AS STRING) AS old_price",
        "concat('-', p_size, '%') AS percent", "CASE WHEN p_size % 3 <> 0 THEN '4.5' END AS rating",
        "CASE WHEN p_size % 3 <> 0 THEN concat('sold ', p_size, ',0K') END AS sold",
    )


@query("speed_view_phone_messages", "WITH cleaned AS (" + ORACLE_SQL["clean_phones"] + """)
SELECT * EXCLUDE (p_partkey), 'https://shop.example/list' AS source, 1704067200000 + p_partkey * 1000 AS crawl_timestamp,
       (1704067200000 + p_partkey * 1000) * 1000 AS "@timestamp", strftime(epoch_ms(1704067200000 + p_partkey * 1000), '%Y-%m-%d') AS crawl_date_dt,
       'stream' AS view_type
FROM cleaned""")
def speed_view_phone_messages(spark, sf):
    """Cleaned phone tiles as messages, decoded and tagged: every field of the contract has values."""
    phones = clean.clean_phones(_phone_tiles(spark, sf)).withColumns({
        "source": F.lit("https://shop.example/list"), "crawl_timestamp": F.lit(1704067200000) + F.col("p_partkey") * 1000})
    return views.phone_speed(decode_json(encode_json(phones.drop("p_partkey")), PHONE))


# --- generated rows ------------------------------------------------------------------------------


@query("date_spine", """
WITH span AS (SELECT event_type, CAST(min(ts) AS DATE) AS first, CAST(max(ts) AS DATE) AS last FROM events GROUP BY 1),
days AS (SELECT event_type, unnest(generate_series(first::TIMESTAMP, last::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM span)
SELECT event_type, strftime(d, '%Y-%m-%d') AS price_date, strftime(d, '%d/%m/%Y') AS day_first FROM days""")
def days_of_types(spark, sf):
    spans = B.table(spark, sf, "events").groupBy("event_type").agg(
        F.to_date(F.min("ts")).alias("first"), F.to_date(F.max("ts")).alias("last"))
    return date_spine(spans, F.col("first"), F.col("last")).drop("first", "last")


@query("season_expand", """
SELECT s_suppkey, CAST(season AS INTEGER) AS season,
       'https://leagues.example/' || s_suppkey || '/plus/?saison_id=' || season AS season_url
FROM supplier, range(2022, 2025) AS r(season)""")
def season_expand(spark, sf):
    base = X.join_url("https://leagues.example/", F.col("s_suppkey").cast("string"), "/plus/?saison_id=")
    return expand_seasons(B.table(spark, sf, "supplier").select("s_suppkey"), base, 2022, 2024)


# --- pages ----------------------------------------------------------------------------------------


@query("html_records", """
WITH items AS (SELECT page_id, regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1) AS li FROM pages),
rows AS (SELECT page_id, unnest(li) AS element, generate_subscripts(li, 1) AS position FROM items)
SELECT page_id, CAST(position AS INTEGER) AS position,
       regexp_extract(element, 'href="([^"]*)"', 1) AS href,
       trim(regexp_replace(regexp_extract(element, '(?s)<a [^>]*>(.*?)</a>', 1), '(?s)<[^>]*>', '', 'g')) AS label
FROM rows
WHERE regexp_extract(element, 'href="([^"]*)"', 1) <> ''
  AND trim(regexp_replace(regexp_extract(element, '(?s)<a [^>]*>(.*?)</a>', 1), '(?s)<[^>]*>', '', 'g')) <> ''""")
def html_records(spark, sf):
    return P.list_items(B.table(spark, sf, "pages"))


@query("html_links_distinct", """
SELECT DISTINCT href FROM (SELECT unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages)
WHERE href <> ''""")
def html_links_distinct(spark, sf):
    return P.distinct_links(B.table(spark, sf, "pages"))


@query("html_slice_links", """
WITH links AS (SELECT page_id, list_slice(regexp_extract_all(html, 'href="([^"]*)"', 1), 2, 3) AS l FROM pages),
rows AS (SELECT page_id, unnest(l) AS href, generate_subscripts(l, 1) - 1 AS place FROM links)
SELECT page_id, CAST(place AS INTEGER) AS place, href FROM rows""")
def html_slice_links(spark, sf):
    return P.leading_links(B.table(spark, sf, "pages"))


@query("html_fields", """
SELECT page_id, nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang,
       nullif(trim(regexp_replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '(?s)<[^>]*>', '', 'g')), '') AS title,
       nullif(trim(regexp_replace(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '(?s)<[^>]*>', '', 'g')), '') AS heading,
       TRY_CAST(nullif(regexp_extract(html, 'track\\(([0-9]+)\\)', 1), '') AS INTEGER) AS tracker,
       trim(regexp_replace(regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1)[CASE WHEN regexp_matches(html, 'lang="en"')
            THEN 2 ELSE 1 END], '(?s)<[^>]*>', '', 'g')) AS chosen_item
FROM pages""")
def html_fields(spark, sf):
    html = F.col("html")
    place = F.when(html.rlike('lang="en"'), F.lit(2)).otherwise(F.lit(1))
    return B.table(spark, sf, "pages").select(
        "page_id", X.first_match(html, P.PAGE_LANG).alias("lang"), P.field_of(html, P.TITLE).alias("title"),
        P.field_of(html, P.HEADING).alias("heading"),
        X.first_match(html, r"track\(([0-9]+)\)").try_cast("int").alias("tracker"),
        P.plain_text(X.nth_match(html, P.LIST_ITEM, place)).alias("chosen_item"),
    )


@query("url_id_extract", """
SELECT page_id, nullif(regexp_extract(url, '/([0-9]+)([?#]|$)', 1), '') AS id,
       split_part(regexp_replace(url, '^[a-z]+://[^/]+/', ''), '?', 1) AS slug
FROM pages""")
def url_id_extract(spark, sf):
    url = F.col("url")
    return B.table(spark, sf, "pages").select("page_id", X.url_id(url).alias("id"), X.url_slug(url, "?").alias("slug"))
