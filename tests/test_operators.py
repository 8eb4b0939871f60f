"""Operators on small literal tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewright import contracts as C
from tidewright.operators import clean, keyed, project, quality, views
from tidewright.operators.decode import decode_json, encode_json
from tidewright.sources import pages as P
from tidewright.sources import tables


def messages(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")


def tick_rows(spark, rows):
    return spark.createDataFrame(rows, C.TICK.schema)


# --- decode ------------------------------------------------------------------------


def test_malformed_messages_are_null_rows(spark):
    rows = decode_json(messages(spark, "{bad", "[]", "null", "", None), C.TICK).collect()
    assert len(rows) == 5
    assert all(v is None for r in rows for v in r)


def test_extra_missing_and_mistyped_fields(spark):
    text = '{"age": "18", "PPG": 1.5, "goals": NaN, "other": 1, "name": "a"}'
    row = decode_json(messages(spark, text), C.PLAYER).first()
    assert row.age is None and row.PPG == 1.5 and row.name == "a" and row.goals != row.goals
    assert "other" not in row.asDict() and row.assists is None
    tick = decode_json(messages(spark, '{"buy_price": 3.0, "sell_price": 4, "gold_type": "x"}'), C.TICK).first()
    assert tick.buy_price is None and tick.sell_price == 4 and tick.gold_type == "x"


def test_json_is_parsed_once_under_many_filters(spark):
    df = quality.complete_stats(decode_json(messages(spark, "{}"), C.PLAYER))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_encode_decode_round_trip_keeps_nulls(spark):
    ticks = tick_rows(spark, [(1, "2024-01-01", "a", None, 5, None)])
    message = encode_json(ticks, F.col("gold_type")).first()
    assert message.key == "a" and '"buy_price":null' in message.value
    assert decode_json(encode_json(ticks), C.TICK).collect() == ticks.collect()


def test_metadata_is_kept(spark):
    df = decode_json(messages(spark, '{"gold_type": "x"}'), C.TICK, {"i": "offset"})
    assert df.columns == ["offset", *C.TICK.columns]


# --- schema ------------------------------------------------------------------------


def test_align_and_diff(spark):
    left = spark.createDataFrame([(1, "a")], "id int, name string")
    right = spark.createDataFrame([(2.0, None)], "score double, name string")
    aligned = project.align_to(right, left.schema, {"id": 0})
    assert aligned.schema == left.schema.__class__(aligned.schema.fields) and aligned.collect() == [(0, None)]
    diff = {r["column"]: (r.in_left, r.in_right, r.left_values, r.right_values)
            for r in project.schema_diff(left, right).collect()}
    assert diff == {"id": (True, False, 1, None), "name": (True, True, 1, 0), "score": (False, True, None, 1)}


def test_contract_projection(spark):
    df = spark.range(1).selectExpr("'s' source", "1L crawl_timestamp", "2 sell_price", "1 buy_price", "'g' gold_type",
                                   "'d' price_date", "9 extra")
    assert project.project_contract(df, C.TICK).columns == C.TICK.columns
    assert project.rename_and_drop(df, {"extra": "more"}, ["more", "absent"]).columns == df.columns[:-1]


# --- filters -----------------------------------------------------------------------

CATEGORIES = [("Goalkeeper", "left"), (None, "left"), ("Back", None), ("Back", "N/A"), ("Back", "both")]


def test_category_filters(spark):
    df = spark.createDataFrame(CATEGORIES, "position string, strong_foot string")
    assert [tuple(r) for r in quality.outfield_strict(df).collect()] == [("Back", "both")]
    assert [tuple(r) for r in quality.outfield_lenient(df).collect()] == [
        (None, "left"), ("Back", None), ("Back", "both")]


def test_null_filters_treat_nan_differently(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert quality.require_values(df, ["x"]).count() == 2
    assert quality.drop_any_null(df).count() == 1
    assert clean.null_out_nan(df).filter("x IS NULL").count() == 2


def player(**changes):
    base = {f.name: 1.0 if f.dataType == C.FLOAT else ("x" if f.dataType == C.STRING else 1)
            for f in C.PLAYER.schema.fields}
    return {**base, "strong_foot": "left", "position": "Back", **changes}


def test_validation_partitions_the_input(spark):
    rows = [player(), player(position="Goalkeeper"), player(strong_foot="N/A", goals=None), player(age=-1.0),
            player(PPG=float("nan")), player(position=None)]
    df = spark.createDataFrame(rows, C.PLAYER.schema)
    rules = quality.player_rules()
    kept, refused = quality.accepted(df, rules), quality.rejected(df, rules)
    assert kept.count() + refused.count() == len(rows) and kept.count() == 1
    counts = {r.reason: r.row_count for r in quality.reason_counts(quality.with_reasons(df, rules)).collect()}
    assert counts == {"accepted": 1, "goalkeeper": 1, "unknown_foot": 1, "missing_goals": 1, "bad_age": 1,
                      "bad_PPG": 1, "missing_position": 1}
    with pytest.raises(ValueError, match="goals"):
        quality.check_columns(df.drop("goals"), quality.PLAYER_REQUIRED)


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (1, "b"), (2, None)], "a int, b string")
    assert {r.column_name: (r.type, r.row_count, r.null_count, r.distinct_count)
            for r in quality.profile_table(df).collect()} == {"a": ("int", 3, 0, 2), "b": ("string", 3, 2, 1)}
    assert {r.column_name: r.null_count for r in quality.null_profile(df).collect()} == {"a": 0, "b": 2}
    with pytest.raises(ValueError):
        quality.nonempty(df.limit(0))


# --- views -------------------------------------------------------------------------


def test_daily_view_values_and_id(spark):
    rows = [(1, "2024-01-01", "g", 10, 12, "s"), (2, "2024-01-01", "g", 20, None, "s"), (3, None, "g", 1, 1, "s")]
    view = {r.price_date: r for r in views.daily_view(tick_rows(spark, rows)).collect()}
    day = view["2024-01-01"]
    assert (day.avg_buy_price, day.avg_sell_price, day.min_buy_price, day.max_buy_price, day.record_count) == (
        15.0, 12.0, 10, 20, 2)
    assert day.doc_id == "2024-01-01_g" and day.view_type == "batch" and view[None].doc_id is None


def test_empty_input_keeps_the_schema(spark):
    empty = tick_rows(spark, [])
    assert views.daily_view(empty).columns == C.DAILY_VIEW.columns and views.daily_view(empty).count() == 0
    assert views.tick_speed(empty).columns == C.TICK_SPEED.columns


@pytest.mark.parametrize("argument, days", [("30", 30), ("all", None), ("abc", None), (None, None), (7, 7)])
def test_window_argument(argument, days):
    assert views.parse_days(argument) == days


def test_default_window_is_thirty_days():
    assert views.parse_days() == 30


def test_trailing_days_is_inclusive_and_prunes_partitions(spark, scratch):
    days = ["2024-01-09", "2024-01-10", "2024-02-01", "bad", None]
    ticks = tick_rows(spark, [(i, d, "g", 1, 1, "s") for i, d in enumerate(days)])
    tables.write_partitioned(views.by_business_date(ticks), scratch)
    stored = tables.scan(spark, scratch)
    recent = views.trailing_days(stored, 10, dt.date(2024, 1, 20), partitioned=True)
    plain = views.trailing_days(ticks, 10, dt.date(2024, 1, 20))
    expected = {"2024-01-10", "2024-02-01", "bad"}
    assert {r.price_date for r in recent.collect()} == {r.price_date for r in plain.collect()} == expected
    plan = recent._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "make_date" in partition_filters
    assert views.trailing_days(ticks, None, dt.date(2024, 1, 20)).count() == 5
    assert tables.scan(spark, scratch).filter(
        tables.days_between(dt.date(2024, 1, 10), dt.date(2024, 1, 31))).count() == 1


def test_speed_views(spark):
    tick = views.tick_speed(tick_rows(spark, [(1700000000123, "2025-02-30", "g", 1, 2, "s")])).first()
    assert tick.price_date_dt is None and tick["@timestamp"].microsecond == 123000 and tick.view_type == "stream"
    frame = spark.createDataFrame([player(player_agent=None), player(goals=None)], C.PLAYER.schema)
    shown = views.player_speed(frame).collect()
    assert len(shown) == 1 and shown[0].player_agent == "None"
    assert views.player_speed(frame).columns == C.PLAYER_SPEED.columns
    assert views.player_raw(frame).columns == C.PLAYER_RAW.columns
    csv = spark.createDataFrame([(1, None, "n"), (1, 5, "m")], "processing_timestamp long, player_id int, name string")
    speed = views.player_csv_speed(project.align_to(csv, C.PLAYER_CSV.schema))
    assert [r.name for r in speed.collect()] == ["m"]
    phones = project.align_to(spark.range(1).selectExpr("'n' name", "86400000L crawl_timestamp"), C.PHONE.schema)
    assert views.phone_speed(phones).first().crawl_date_dt == dt.date(1970, 1, 2)


def test_serving_lookup_sees_its_layer_only(spark):
    ticks = tick_rows(spark, [(1, "2024-01-01", "g", 1, 2, "s"), (2, "2024-01-05", "g", 1, 2, "s")])
    serving = views.serving_union(views.daily_view(ticks), views.tick_speed(ticks))
    assert serving.count() == 4
    found = views.serving_lookup(serving, "stream", dt.date(2024, 1, 1), dt.date(2024, 1, 4)).collect()
    assert [r.crawl_timestamp for r in found] == [1]


# --- keyed -------------------------------------------------------------------------

ROW = "k int, ts long, seq int, a string, b string"


def test_latest_wins_whatever_the_arrival(spark):
    rows = [(1, 5, 1, "new", None), (1, 3, 2, "old", "x"), (2, 1, 1, "p", None), (2, 1, 2, "q", None),
            (3, None, 1, "untimed", None)]
    expected = {1: ("new", None), 2: ("q", None), 3: ("untimed", None)}
    for seed in range(3):
        shuffled = random.Random(seed).sample(rows, len(rows))
        got = keyed.latest_per_key(spark.createDataFrame(shuffled, ROW).repartition(3), ["k"], ["ts", "seq"])
        assert {r.k: (r.a, r.b) for r in got.collect()} == expected


def test_replace_keeps_newer_base(spark):
    base = spark.createDataFrame([(1, 9, 0, "base", "b"), (2, 1, 0, "base", "b")], ROW)
    updates = spark.createDataFrame([(1, 5, 0, "late", None), (2, 2, 0, "newer", None), (4, 1, 0, "added", None)], ROW)
    got = keyed.replace_by_key(base, updates, ["k"], ["ts", "seq"])
    assert {r.k: (r.a, r.b) for r in got.collect()} == {1: ("base", "b"), 2: ("newer", None), 4: ("added", None)}
    again = keyed.replace_by_key(got, updates, ["k"], ["ts", "seq"])
    assert sorted(again.collect()) == sorted(got.collect())


def test_merge_keeps_old_values_under_null(spark):
    base = spark.createDataFrame([(1, 1, 0, "a1", "b1"), (2, 1, 0, "a2", "b2")], ROW)
    updates = spark.createDataFrame([(1, 2, 0, "x", None), (1, 3, 0, None, None), (3, 2, 0, None, "n")], ROW)
    got = {r.k: (r.ts, r.a, r.b) for r in keyed.merge_by_key(base, updates, ["k"], ["ts", "seq"]).collect()}
    assert got == {1: (3, "x", "b1"), 2: (1, "a2", "b2"), 3: (2, None, "n")}


def test_latest_per_key_folds_before_the_shuffle(spark):
    df = keyed.latest_per_key(spark.createDataFrame([(1, 1, 1, "a", "b")], ROW), ["k"], ["ts", "seq"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def _upsert_inputs(spark):
    base = spark.createDataFrame([(1, 5, 5, "a", "b"), (2, 5, 5, "c", None), (3, 9, 9, "z", "z"), (None, 1, 1, "n", "n"), (None, 1, 1, "n", "n")], ROW)
    updates = spark.createDataFrame([(1, 6, 6, None, "B"), (1, 7, 7, None, None), (3, 8, 8, "late", None), (2, 5, 5, "same", None), (4, 1, 1, "new", None), (None, 9, 9, "x", "x")], ROW)
    return base, updates


@pytest.mark.parametrize("upsert", [keyed.replace_by_key, keyed.merge_by_key])
def test_upsert_plans_agree(spark, scratch, upsert):
    base, updates = _upsert_inputs(spark)
    few = sorted(upsert(base, updates, ["k"], ["ts", "seq"]).collect(), key=str)
    assert len(few) == 6
    assert sorted(upsert(base, updates, ["k"], ["ts", "seq"], keyed.MANY).collect(), key=str) == few
    name = "base_" + scratch.rsplit("-", 1)[-1]
    tables.write_bucketed(base, name, scratch, ["k"], 4)
    assert sorted(upsert(spark.table(name), updates, ["k"], ["ts", "seq"], keyed.BUCKETED).collect(), key=str) == few
    wider = updates.withColumn("more", F.lit(1))
    for plan in (keyed.FEW, keyed.MANY, keyed.BUCKETED):
        assert upsert(base, wider, ["k"], ["ts", "seq"], plan).columns == [*base.columns, "more"]


@pytest.mark.parametrize("upsert", [keyed.replace_by_key, keyed.merge_by_key])
def test_upserts_of_many_rows_shuffle_once(spark, scratch, upsert):
    base, updates = _upsert_inputs(spark)
    base.write.parquet(f"{scratch}/base")
    updates.write.parquet(f"{scratch}/updates")
    stored = spark.read.parquet(f"{scratch}/base"), spark.read.parquet(f"{scratch}/updates")
    plan = upsert(*stored, ["k"], ["ts", "seq"], keyed.MANY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 2 and "Join" not in plan and "Window" not in plan
    name = "base_" + scratch.rsplit("-", 1)[-1]
    tables.write_bucketed(base, name, f"{scratch}/bucketed", ["k"], int(spark.conf.get("spark.sql.shuffle.partitions")))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = upsert(spark.table(name), stored[1], ["k"], ["ts", "seq"], keyed.BUCKETED)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 2 and "Bucketed: true" in plan


# --- tables ------------------------------------------------------------------------


def test_csv_round_trip_quotes_and_empty_input(spark, scratch):
    df = spark.createDataFrame([(1, 'say "hi", ok'), (2, "plain"), (3, None)], "i int, t string")
    assert tables.export_csv(df, scratch, ["i", "t"])
    assert sorted(tables.scan_csv(spark, scratch, df.schema).collect()) == sorted(df.collect())
    assert not tables.export_csv(df.limit(0), scratch + "-none", ["i"])


def test_csv_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "d.csv").write_text("\ufeffname,brand\nPhone,Maker\n", encoding="utf-8")
    schema = C.struct((C.STRING, "name brand"))
    assert [tuple(r) for r in tables.scan_csv(spark, str(tmp_path), schema).collect()] == [("Phone", "Maker")]
    swapped = C.struct((C.STRING, "brand name"))
    with pytest.raises(Exception, match="header"):
        tables.scan_csv(spark, str(tmp_path), swapped).collect()
    device = tmp_path / "devices"
    device.mkdir()
    (device / "d.csv").write_text("\ufeff" + ",".join(C.DEVICE_CSV.columns) + "\nX 8GB/1TB" + ",v" * 10 + "\n", "utf-8")
    assert tables.scan_csv(spark, str(device), C.DEVICE_CSV.schema).first().name == "X 8GB/1TB"
    odd = spark.createDataFrame([(1,)], ["\ufeffname"])
    assert tables.clean_header(odd).columns == ["name"]


def test_merge_schema(spark, scratch):
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{scratch}/p=1")
    spark.createDataFrame([(2, "x")], "a int, b string").write.parquet(f"{scratch}/p=2")
    rows = tables.scan(spark, scratch, merge_schema=True).select("a", "b").collect()
    assert {(r.a, r.b) for r in rows} == {(1, None), (2, "x")}


# --- pages -------------------------------------------------------------------------

PRICES = """<table class="t"><tbody>
<tr><td><h2>Bar 1</h2></td><td><span class="fixW">8,150</span></td><td><span class="fixW">8,350</span></td></tr>
<tr><td>too</td><td>short</td></tr>
<tr><td><h2>Ring</h2></td><td><span class="fixW">n/a</span></td><td><span class="fixW">7</span></td></tr>
<tr><td><h2>Ring 9</h2></td><td><span class="fixW">600</span></td><td><span class="fixW">700</span></td></tr>
</tbody></table>"""

TILES = """<ul class="listproduct">
<li class="item ajaxed"><a class="main-contain" data-brand="Maker" data-cate="Phone" data-color="" data-price="900.0"
 price-old="1000.0"><h3>Maker Z <span class="newModel">New</span> 8GB/256GB</h3></a>
<div class="rating_Compare has_compare has_quantity"><b>4.9</b><span>sold 1,2k</span></div></li>
<li class="item"><p>advert</p></li>
<li class="item"><a class="main-contain" data-price="50.0"><h3>Plain</h3></a></li>
</ul>"""

PROFILE = """<h1 class="data-header__headline-wrapper">#9 <b>Ann Other</b></h1>
<span class="data-header__club"><a>FC Test</a></span>
<li class="data-header__label">Born: 1 Jan 2000 (24)</li>
<dd class="detail-position__position">Centre-Forward</dd>
<a class="data-header__market-value-wrapper"><span>€</span>1.50<span>m</span> <p>Last update</p></a>
<span itemprop="nationality">Utopia</span>
Height: <span>1,85 m</span>
Agent: <span>Good Agent</span>
Contract expires: <span>Jun 30, 2027</span>
<span class="info-table__content info-table__content--regular">Name in home country:</span>
""" + "".join(f'<span class="info-table__content info-table__content--bold">v{i}</span>' for i in range(8))

STATS = "".join(f'<td class="zentriert">{"-" if i == 5 else i}</td>' for i in range(13)) + \
    "".join(f"<td class=\"rechts\">{v}</td>" for v in ("x", "90'", "2070'"))


def test_price_rows(spark):
    pages = spark.createDataFrame([("2024-01-01", "s", PRICES)], "price_date string, source string, html string")
    rows = P.price_rows(pages).orderBy("position").collect()
    assert [(r.position, r.gold_type, r.buy_price, r.sell_price) for r in rows] == [
        (1, "Bar 1", 8150, 8350), (4, "Ring 9", 600, 700)]


def test_product_tiles_and_cleaning(spark):
    pages = spark.createDataFrame([("s", TILES)], "source string, html string")
    rows = {r.product_id: r for r in clean.clean_products(P.product_tiles(pages)).collect()}
    assert set(rows) == {1, 3}
    first, plain = rows[1], rows[3]
    assert (first.RAM, first.ROM, first.percent, first.sold, first.rating, first.color) == (
        "8GB", "256GB", "10", "1200", "4.9", "N/A")
    assert (plain.brand, plain.price_old, plain.percent, plain.sold, plain.rating, plain.ROM) == (
        "N/A", "50.0", "0", "0", "0", "N/A")


def test_phone_tiles_and_cleaning(spark):
    tile = """<li class="item ajaxed __cate_42"><a class="main-contain"><h3>Maker Model Pro 8GB/128GB</h3>
      <div class="item-compare gray-bg"><span>6.1"</span><span>OLED</span></div><strong class="price">9.990.000₫</strong>
      <div class="box-p"><p class="price-old black">10.990.000₫</p><span class="percent">-9%</span></div></a></li>"""
    pages = spark.createDataFrame([("s", tile)], "source string, html string")
    row = clean.clean_phones(P.phone_tiles(pages)).first()
    assert (row.brand, row.model, row.capacity, row.RAM, row.ROM) == ("Maker", "Model Pro", "8GB/128GB", "8GB", "128GB")
    assert (row.new_price, row.old_price, row.percent, row.screen_size, row.resolution) == (
        "9990000", "10990000", "-9%", '6.1"', "OLED")


def test_profile_and_stat_pages(spark):
    pages = spark.createDataFrame([("https://a.b/ann/profil/spieler/77", PROFILE), ("https://a.b/none", PROFILE)],
                                  "url string, html string")
    raw = P.profile_fields(pages)
    row = clean.clean_players(raw).collect()
    assert len(row) == 1
    got = row[0]
    assert (got.player_id, got.player_club, got.age, got.market_value, got.player_height) == (
        "77", "FC Test", 24.0, 1500.0, 1.85)
    assert (got.player_agent, got.strong_foot, got.contract_value_time, got.nationality) == (
        "Good Agent", "v6", "2027", "Utopia")
    stats = spark.createDataFrame([("77", STATS)], "player_id string, html string")
    cells = P.stat_fields(stats)
    numbers = cells.select(*[clean.N.stat_value(F.col(c)).alias(c) for c in cells.columns if c != "player_id"]).first()
    assert (numbers.appearances, numbers.own_goals, numbers.penalty_goals, numbers.minutes_per_goal,
            numbers.minutes_played) == (1.0, 0.0, 11.0, 90.0, 2070.0)


def test_nested_elements(spark):
    from tidewright.functions import markup as H

    def of(html, tag, having=None, shape=H.elements):
        return spark.createDataFrame([(html,)], "html string").select(shape(F.col("html"), tag, having)).first()[0]

    assert of("<ul><li>a<ul><li>b</li></ul>c</li><LI x='>'>d</LI ></ul>", "li") == ["a<ul><li>b</li></ul>c", "b", "d"]
    assert of("</li>x<li>a<li>b</li>c", "li") == ["a<li>b</li>c", "b"]  # one closing tag too many, one too few
    assert of("<link><lis>n</lis><li>y</li>", "li") == ["y"]
    assert of("<!-- <li>n</li> --><script>'<li>'</script><li>y</li>", "li") == ["y"]
    assert of('<li class="item">1</li><li class="item-x">2</li><li class="y item z">3</li>', "li", H.has_class("item")) == ["1", "3"]
    assert of("", "li") == [] and of(None, "li") is None and of("no tags", "li") == []
    assert of("<p>a<b>x<b>y</b></b>z</p>", "b", shape=H.outer_elements) == ["<b>x<b>y</b></b>", "<b>y</b>"]
    kept = spark.createDataFrame([("<h3>N <i>1<i>2</i></i>x</h3>",), ("<h3>N</h3>",), (None,)], "html string")
    assert [r[0] for r in kept.select(H.without_first(F.col("html"), "i")).collect()] == ["<h3>N x</h3>", "<h3>N</h3>", None]
    deep = "<li>" * 300 + "x" + "</li>" * 300
    assert len(of(deep, "li")) == 300 and of(deep, "li")[-1] == "x"
    many = "".join(f"<li>{i}</li>" for i in range(3000))
    assert of(many, "li") == [str(i) for i in range(3000)]


def test_laptop_tiles(spark):
    box = '<li class="item"><a class="main-contain"><h3>Book 8GB/1TB</h3><div class="item-compare"><span>RAM 16 GB</span><span>SSD 512 GB</span></div></a></li>'
    pages = spark.createDataFrame([("s", box), ("t", box.replace("<span>SSD 512 GB</span>", ""))], "source string, html string")
    rows = {r.source: r for r in clean.clean_products(P.laptop_tiles(pages)).collect()}
    assert (rows["s"].RAM, rows["s"].ROM, rows["t"].RAM, rows["t"].ROM) == ("RAM 16 GB", "SSD 512 GB", "N/A", "N/A")


def test_fields_of_a_page_are_cut_once(spark):
    pages = spark.createDataFrame([("s", "<li class=\"item\"></li>", "u")], "source string, html string, url string")
    cuts = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("(?=</?")
    assert cuts(P.phone_tiles(pages)) <= 10 and cuts(P.laptop_tiles(pages)) <= 8 and cuts(P.product_tiles(pages)) <= 7
    assert cuts(P.profile_fields(pages)) <= 5 and cuts(P.stat_fields(pages, ["source"])) == 1


def test_pages_are_made_on_all_cores(spark, tmp_path):
    from tidewright.plans.catalog import QUERIES
    key, name = F.col("id"), F.concat(F.lit("N "), F.col("id"))
    spark.range(40).coalesce(1).select(
        key.alias("p_partkey"), name.alias("p_name"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type"), F.lit(3).alias("p_size"), F.lit(1.5).alias("p_retailprice"),
    ).write.parquet(f"{tmp_path}/part.parquet")
    spark.range(40).coalesce(1).select(
        key.alias("c_custkey"), name.alias("c_name"), F.lit(1).alias("c_nationkey"), F.lit(1.5).alias("c_acctbal"), F.lit("S").alias("c_mktsegment"),
    ).write.parquet(f"{tmp_path}/customer.parquet")
    for query in ("html_phone_tiles", "html_laptop_tiles", "html_product_tiles", "html_profile_fields", "html_stat_fields"):
        assert QUERIES[query](spark, str(tmp_path)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism, query


def test_player_records_from_two_pages(spark):
    profiles = spark.createDataFrame([(f"https://a.b/ann/profil/spieler/{i}", PROFILE.replace("Centre-Forward", p)) for i, p in ((77, "Centre-Forward"), (78, "Goalkeeper"), (79, ""))], "url string, html string")
    stats = spark.createDataFrame([("77", STATS)], "player_id string, html string")
    rows = {r.player_id: r for r in clean.clean_players(P.player_records(profiles, stats)).collect()}
    assert set(rows) == {"77", "79"} and rows["77"].appearances == 1.0 and rows["79"].appearances is None
    assert (rows["77"].goalkeeper_or_not, rows["77"].goals_conceded, rows["77"].player_height) == ("0", 0.0, 1.85)


def test_profile_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert [tuple(r) for r in quality.profile_table(empty).orderBy("column_name").collect()] == [("a", "int", 0, 0, 0), ("b", "string", 0, 0, 0)]
    rows = spark.createDataFrame([(1, None), (1, "x"), (None, "y")], "a int, b string")
    for exact in (True, False):
        assert [tuple(r) for r in quality.profile_table(rows, exact).orderBy("column_name").collect()] == [("a", "int", 3, 1, 1), ("b", "string", 3, 1, 2)]
    assert quality.profile_table(rows)._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1


def test_links(spark):
    html = '<a href="/a"></a><a href="/b"></a><a href="/c"></a><a href="/a"></a>'
    pages = spark.createDataFrame([(1, html), (2, '<a href="/a"></a>')], "page_id int, html string")
    assert {r.href for r in P.distinct_links(pages).collect()} == {"/a", "/b", "/c"}
    assert [(r.page_id, r.place, r.href) for r in P.leading_links(pages).orderBy("place").collect()] == [
        (1, 0, "/b"), (1, 1, "/c")]
