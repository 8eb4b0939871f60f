"""Records and fields out of pages with nested markup.

The pages are written from columns of the given tables, with elements of the searched kind
inside each other, comments that look like records and attributes that hold a ``>``. The SQL
twins never see a page: they select the columns that went in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators import clean
from tidewright.plans import bindings as B
from tidewright.plans.registry import query
from tidewright.sources import pages as P

TASKS_PER_CORE = 4  # fixed value


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt over all cores before pages are made of them: a file of one row group would go through one task."""
    return rows.repartition(TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism)


# --- device listings, a page per part: a full tile, an advert, a tile with a price only ------------

TILES = """concat(
  '<html><!-- <li class="item"><a class="main-contain" data-price="1">old</a></li> -->',
  '<ul class="listproduct"><li class="item ajaxed" title="a > b">',
  '<ul class="specs"><li class="item-label">', product_id, '</li><li><b>x</b><ul><li>y</li></ul></li></ul>',
  '<a class="main-contain" data-brand="', brand, '" data-cate="', category, '" data-color="', coalesce(color, ''), '" data-price="', price, '"',
  CASE WHEN price_old IS NOT NULL THEN concat(' price-old="', price_old, '"') ELSE '' END, '>',
  '<h3><i>', split_part(name, ' ', 1), '</i>', substring(name, length(split_part(name, ' ', 1)) + 1, 200), ' <span class="newModel">New <span>!</span> model</span></h3>',
  '<div class="item-compare gray-bg">', CASE product_id % 3 WHEN 0 THEN concat('<span><span>RAM</span> ', product_id % 7, ' GB</span><span>SSD</span>') WHEN 1 THEN '<span>one</span>' ELSE '' END, '</div></a>',
  '<div class="rating_Compare has_compare has_quantity"><div class="stars"><b>', coalesce(rating, 'Chưa có đánh giá'), '</b></div>',
  CASE WHEN sold IS NOT NULL THEN concat('<span><span></span>', sold, '</span>') ELSE '' END, '</div></li>',
  '<li class="item"><p>advert</p><ul><li>z</li></ul></li>',
  '<li class="wide item"><a class="main-contain" data-price="', product_id, '"></a></li></ul></html>')"""

TILE_COLUMNS = "name brand category color price price_old rating sold".split()
TILE_ROWS = f"""tiles AS (
  SELECT product_id AS page, 1 AS place, {', '.join(TILE_COLUMNS)} FROM devices
  UNION ALL SELECT product_id, 3, NULL, NULL, NULL, NULL, CAST(product_id AS VARCHAR), NULL, NULL, NULL FROM devices)"""


def device_pages(spark, sf) -> DataFrame:
    return B.devices(spread(B.table(spark, sf, "part"))).selectExpr("product_id AS page", f"{TILES} AS html")


@query("html_product_tiles", f"WITH {B.DEVICES_SQL}, {TILE_ROWS} SELECT page, CAST(place AS INTEGER) AS product_id, {', '.join(TILE_COLUMNS)} FROM tiles")
def html_product_tiles(spark, sf):
    return P.product_tiles(device_pages(spark, sf), keep=["page"])


@query("html_laptop_tiles", f"""
WITH {B.DEVICES_SQL}, {TILE_ROWS}
SELECT page, CAST(place AS INTEGER) AS product_id, coalesce(name, 'N/A') AS name, coalesce(price, 'N/A') AS price, coalesce(price_old, price) AS price_old,
       CASE WHEN place = 1 AND page % 3 = 0 THEN 'RAM ' || (page % 7) || ' GB' ELSE 'N/A' END AS "RAM",
       CASE WHEN place = 1 AND page % 3 = 0 THEN 'RAM' ELSE 'N/A' END AS "ROM"
FROM tiles""")
def html_laptop_tiles(spark, sf):
    """All spans of the box count, inner ones too, so the second one is the label inside the first."""
    pages = device_pages(spark, sf).withColumn("source", F.col("page").cast("string"))
    return clean.clean_products(P.laptop_tiles(pages)).select(
        F.col("source").cast("int").alias("page"), "product_id", "name", "price", "price_old", "RAM", "ROM")


@query("html_phone_tiles", """
SELECT p_partkey AS page, 1 AS position, p_name AS name, CASE WHEN p_size % 2 = 0 THEN p_size || ' inch' END AS screen_size,
       CASE WHEN p_size % 2 = 0 THEN 'QHD' END AS resolution, p_size || '.990.000 d' AS new_price,
       CASE WHEN p_size % 3 = 0 THEN p_partkey || '.000' END AS old_price, '-' || p_size || '%' AS percent,
       CASE WHEN p_size % 5 <> 0 THEN '4.' || (p_size % 5) END AS rating, CASE WHEN p_size % 5 <> 0 THEN CASE WHEN p_size % 7 = 0 THEN '0' ELSE p_size || 'k' END END AS sold
FROM part""")
def html_phone_tiles(spark, sf):
    tile = """concat('<ul><li class="item __cate_42"><a class="main-contain"><h3>', p_name, '<span class="newModel"><span>n</span>ew</span></h3>',
      CASE WHEN p_size % 2 = 0 THEN concat('<div class="item-compare gray-bg"><span>', p_size, ' inch</span><div><span>QHD</span></div></div>') ELSE '' END,
      '<strong class="price"><strong>', p_size, '</strong>.990.000 d</strong>',
      CASE WHEN p_size % 3 = 0 THEN concat('<p class="price-old black">', p_partkey, '.000</p>') ELSE '' END,
      '<span class="percent"><span>-</span>', p_size, '%</span></a><ul><li>inner</li></ul>',
      CASE WHEN p_size % 5 <> 0 THEN concat('<div class="rating_Compare has_compare has_quantity"><div><b>4.', p_size % 5, '</b></div>',
        CASE WHEN p_size % 7 <> 0 THEN concat('<span><span></span>', p_size, 'k</span>') ELSE '' END, '</div>') ELSE '' END, '</li></ul>')"""
    return P.phone_tiles(spread(B.table(spark, sf, "part")).selectExpr("p_partkey AS page", f"{tile} AS html"), keep=["page"])


# --- price tables, a page per supplier: head, two rows, one row without numbers for some --------------


@query("html_price_rows", """
WITH r AS (
  SELECT s_suppkey, 2 AS position, s_name AS gold_type, s_suppkey + 1000 AS buy, s_suppkey + 1000 + s_nationkey AS sell FROM supplier
  UNION ALL SELECT s_suppkey, 3, 'Ring ' || s_nationkey, s_suppkey, s_nationkey FROM supplier WHERE s_suppkey % 4 <> 0)
SELECT s_suppkey AS page, CAST(position AS INTEGER) AS position, gold_type, CAST(buy AS INTEGER) AS buy_price, CAST(sell AS INTEGER) AS sell_price FROM r""")
def html_price_rows(spark, sf):
    amount = "concat('<span class=\"fixW\"><span>', floor({0} / 1000), '</span>,', lpad({0} % 1000, 3, '0'), '</span>')"
    table = f"""concat('<table><tr><th>type</th></tr><tr title="x > y"><td><div><h2>', s_name, '</h2><span>a</span></div></td><td>',
      {amount.format("(s_suppkey + 1000)")}, '</td><td>', {amount.format("(s_suppkey + 1000 + s_nationkey)")}, '</td></tr>',
      '<tr><td><h2>Ring <b>', s_nationkey, '</b></h2></td><td><span class="fixW">', CASE WHEN s_suppkey % 4 = 0 THEN 'n/a' ELSE CAST(s_suppkey AS STRING) END,
      '</span></td><td><span class="fixW">', s_nationkey, '</span></td></tr><tr><td>too</td><td>short</td></tr></table>')"""
    return P.price_rows(spread(B.table(spark, sf, "supplier")).selectExpr("s_suppkey AS page", f"{table} AS html"), keep=["page"])


# --- player pages, one per customer --------------------------------------------------------------------

PROFILE_HTML = """concat('<html><script>var s = "<span class=\\'data-header__club\\'>no</span>";</script>',
  '<h1 class="data-header__headline-wrapper"><span>', c_name, '</span> <b>Jr</b></h1>',
  '<span class="data-header__club"><span><a>Club</a></span> ', c_mktsegment, '</span>',
  '<ul><li class="data-header__label">Caps: <ul><li>none</li></ul></li><li class="data-header__label">Born: <span>1 Jan 2000</span> (', 18 + c_custkey % 20, ')</li></ul>',
  '<dd class="detail-position__position">', CASE WHEN c_custkey % 3 = 0 THEN 'Goalkeeper' ELSE 'Centre-Forward' END, '</dd>',
  '<a class="data-header__market-value-wrapper"><span>€</span>', c_custkey % 90 + 1, '<span>m</span> <p>Last update</p></a>',
  '<span itemprop="nationality"><span></span>Nation ', c_nationkey, '</span>\n',
  'Height: <span>1,', 60 + c_custkey % 40, ' m</span>\n', CASE WHEN c_custkey % 4 <> 0 THEN concat('Agent: <span>Agent ', c_nationkey, '</span>\n') ELSE '' END,
  'Contract expires: <span>Jun 30, ', 2025 + c_custkey % 5, '</span>\n',
  CASE WHEN c_custkey % 2 = 0 THEN '<span class="info-table__content info-table__content--regular">Full name:</span>' ELSE '' END,
  '<span class="info-table__content info-table__content--bold"><span>v1</span></span>', '<span class="info-table__content info-table__content--bold">v2</span>',
  '<span class="info-table__content info-table__content--bold">v3</span>', '<span class="info-table__content info-table__content--bold">v4</span>',
  '<span class="info-table__content info-table__content--bold">v5</span>', '<span class="info-table__content info-table__content--bold"><b>left</b></span>',
  '<span class="info-table__content info-table__content--bold">right</span></html>')"""
PROFILE_URL = "concat('https://site.example/', lower(c_mktsegment), '/profil/', CASE WHEN c_custkey % 11 = 0 THEN 'none' ELSE CAST(c_custkey AS STRING) END)"


@query("html_profile_fields", """
SELECT CAST(c_custkey AS VARCHAR) AS player_id, c_name || ' Jr' AS name, 'Club ' || c_mktsegment AS player_club, CAST(18 + c_custkey % 20 AS VARCHAR) AS age,
       CASE WHEN c_custkey % 3 = 0 THEN 'Goalkeeper' ELSE 'Centre-Forward' END AS position, '€' || (c_custkey % 90 + 1) || 'm Last update' AS market_value,
       'Nation ' || c_nationkey AS nationality, '1,' || (60 + c_custkey % 40) || ' m' AS player_height,
       CASE WHEN c_custkey % 4 <> 0 THEN 'Agent ' || c_nationkey ELSE 'None' END AS player_agent, CASE WHEN c_custkey % 2 = 0 THEN 'right' ELSE 'left' END AS strong_foot,
       CAST(2025 + c_custkey % 5 AS VARCHAR) AS contract_value_time, 'https://site.example/' || lower(c_mktsegment) || '/profil/' || c_custkey AS source
FROM customer WHERE c_custkey % 11 <> 0""")
def html_profile_fields(spark, sf):
    return P.profile_fields(spread(B.table(spark, sf, "customer")).selectExpr(f"{PROFILE_URL} AS url", f"{PROFILE_HTML} AS html"))


def stat_page(cells: int = 13) -> str:
    """Cells of a season table; the one at place 5 is a dash, each value is nested."""
    centred = ", ".join(f"""'<td class="zentriert"><a><b>', {"'-'" if i == 5 else f"c_custkey % {i + 2}"}, '</b></a></td>'""" for i in range(cells))
    return f"""concat('<table><tr>', {centred}, '<td class="rechts">x</td><td class="rechts"><span>', c_custkey % 300, '''</span></td><td class="rechts">', c_custkey, '''</td></tr></table>')"""


@query("html_stat_fields", "SELECT CAST(c_custkey AS VARCHAR) AS player_id, " + ", ".join(
    f"{chr(39) + '-' + chr(39) if place == 5 else f'CAST(c_custkey % {place + 2} AS VARCHAR)'} AS {name if name != 'PPG' else chr(34) + name + chr(34)}" for name, place in P.STAT_CELLS.items())
    + ", (c_custkey % 300) || '''' AS minutes_per_goal, c_custkey || '''' AS minutes_played FROM customer")
def html_stat_fields(spark, sf):
    return P.stat_fields(spread(B.table(spark, sf, "customer")).selectExpr("CAST(c_custkey AS STRING) AS player_id", f"{stat_page()} AS html"))


_STAT = {name: f"CAST({'0' if place == 5 else f'c_custkey % {place + 2}'} AS DOUBLE)" for name, place in P.STAT_CELLS.items()}


@query("html_player_records", """
SELECT CAST(c_custkey AS VARCHAR) AS player_id, c_name || ' Jr' AS name, CAST(18 + c_custkey % 20 AS DOUBLE) AS age,
       CAST(c_custkey % 90 + 1 AS DOUBLE) * 1000 AS market_value, round(1 + (60 + c_custkey % 40) / 100.0::DOUBLE, 2) AS player_height,
       'Centre-Forward' AS position, '0' AS goalkeeper_or_not, """ + ", ".join(f'{v} AS "{k}"' for k, v in _STAT.items()) + """,
       CAST(c_custkey % 300 AS DOUBLE) AS minutes_per_goal, CAST(c_custkey AS DOUBLE) AS minutes_played, CAST(0 AS DOUBLE) AS goals_conceded
FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 3 <> 0""")
def html_player_records(spark, sf):
    """Profile and statistics pages to one cleaned record per player."""
    customer = spread(B.table(spark, sf, "customer"))
    profiles = customer.selectExpr(f"{PROFILE_URL} AS url", f"{PROFILE_HTML} AS html")
    stats = customer.selectExpr("CAST(c_custkey AS STRING) AS player_id", f"{stat_page()} AS html")
    return clean.clean_players(P.player_records(profiles, stats)).select(
        "player_id", "name", "age", "market_value", F.round("player_height", 2).alias("player_height"), "position", "goalkeeper_or_not",
        *P.STAT_CELLS, "minutes_per_goal", "minutes_played", "goals_conceded")


@query("html_stat_urls", """
SELECT c_custkey, 'https://stats.example/' || lower(c_mktsegment) || '/leistungsdatendetails/spieler/' || c_custkey || '/plus/1?saison=2024' AS stat_url
FROM customer WHERE c_custkey % 11 <> 0""")
def html_stat_urls(spark, sf):
    rows = B.table(spark, sf, "customer").selectExpr("c_custkey", f"{PROFILE_URL} AS url")
    return rows.select("c_custkey", P.stat_url("https://stats.example/", F.col("url"), 2024).alias("stat_url")).filter(F.col("stat_url").isNotNull())
