"""Records, links and fields out of fetched HTML, with JVM expressions only.

Pages are read whole. Every page is handled on its own, so the work splits by
page rows and needs no shuffle, except where links are made distinct. Records and fields are
elements with all that is nested in them (``functions.markup``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions import markup as H
from tidewright.functions import numbers as N
from tidewright.functions import text as X
from tidewright.functions.markup import plain_text

# --- fixed values: tags, classes and patterns --------------------------------------
LIST_ITEM = r"(?s)<li\b[^>]*>(.*?)</li>"
HREF = r'<a\s(?:[^>]*?\s)?href="([^"]*)"'
TITLE = r"(?s)<title>(.*?)</title>"
HEADING = r"(?s)<h1\b[^>]*>(.*?)</h1>"
PAGE_LANG = r'<html lang="([^"]*)"'
ANCHOR_TEXT = r"(?s)<a [^>]*>(.*?)</a>"
# price table page
PRICE_VALUE = 'class="fixW"'
# product listing page
PRODUCT_TILE = H.has_class("item")
TILE_LINK = r'(?s)(<a\b[^>]*class="[^"]*\bmain-contain\b[^"]*"[^>]*>)'
NEW_MODEL_BADGE = 'class="newModel"'
RATING_BOX = 'class="rating_Compare has_compare has_quantity"'
NOT_RATED = "Chưa có đánh giá"
COMPARE_BOX = H.has_class("item-compare")
PHONE_SCREEN = 'class="item-compare gray-bg"'
PHONE_PRICE = 'class="price"'
PHONE_OLD_PRICE = r'class="price-old[^"]*"'
PHONE_PERCENT = 'class="percent"'
# profile page
PROFILE = {
    "name": ("h1", 'class="data-header__headline-wrapper"'),
    "player_club": ("span", 'class="data-header__club"'),
    "position": ("dd", H.has_class("detail-position__position")),
    "market_value": ("a", 'class="data-header__market-value-wrapper"'),
    "nationality": ("span", 'itemprop="nationality"'),
}
PROFILE_LABEL = 'class="data-header__label"'
PROFILE_AGE = r"\(([0-9]+)\)"
PROFILE_HEIGHT = r"(?s)Height:.*?([0-9].*?)\n"
PROFILE_AGENT = r"(?s)Agent:.*?([A-Za-z].*?)\n"
PROFILE_CONTRACT = r"Contract expires: (.*)"
INFO_LABEL_NAME = (
    r'(?is)<span\b[^>]*class="info-table__content info-table__content--regular"[^>]*>[^<]*name[^<]*</span>'
)
INFO_BOLD = 'class="info-table__content info-table__content--bold"'
STAT_PATH, STAT_SEASON = "/leistungsdatendetails/spieler/", "/plus/1?saison="
STAT_CENTRED = 'class="zentriert"'
STAT_RIGHT = 'class="rechts"'
# which centred cell (0-based) holds which stat
STAT_CELLS = {
    "appearances": 1, "PPG": 2, "goals": 3, "assists": 4, "own_goals": 5, "substitutions_on": 6,
    "substitutions_off": 7, "yellow_cards": 8, "second_yellow_cards": 9, "red_cards": 10, "penalty_goals": 11,
}
# ------------------------------------------------------------------------------


def field_of(html: Column, pattern: str, group: int = 1) -> Column:
    return X.blank_to_null(plain_text(X.first_match(html, pattern, group)))


def matches(html: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(group))


def opened(rows: DataFrame, keep: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Values as columns that are worked out once, however often what follows names them."""
    return rows.select(*keep, F.inline(F.array(F.struct(*[v.alias(n) for n, v in values.items()]))))


def extract_records(pages: DataFrame, records: Column, fields: Mapping[str, Column],
                    keep: Sequence[str], required: Sequence[str] = (), shared: Sequence[Mapping[str, Column]] = (),
                    texts: Sequence[str] = ()) -> DataFrame:
    """One row per repeated element of a page.

    ``records`` is the array of a page's elements, ``fields`` are expressions over the column
    ``element``. ``position`` counts from 1 over all elements of the page; incomplete elements are then dropped,
    so positions keep their gaps. ``inline`` keeps that filter above the
    extraction, so each pattern runs once per element. ``shared`` are values that several fields read, step by step,
    each over ``element`` and the steps before. Blank ones among ``texts`` become NULL.
    """
    rows = pages.select(*keep, F.posexplode(records).alias("_pos", "element"))
    rows, kept = rows.select(*keep, (F.col("_pos") + 1).alias("position"), "element"), [*keep, "position", "element"]
    for values in shared:
        rows, kept = opened(rows, kept, values), [*kept, *values]
    shaped = opened(rows, [*keep, "position"], fields)
    if texts:
        shaped = shaped.withColumns({n: X.blank_to_null(F.col(n)) for n in texts})
    return shaped.dropna(subset=list(required)) if required else shaped


def list_items(pages: DataFrame, keep: Sequence[str] = ("page_id",), html: str = "html") -> DataFrame:
    """Navigation entries: address and label of each list item that has a link."""
    element = F.col("element")
    return extract_records(
        pages, H.elements(F.col(html), "li"),
        {"href": X.first_match(element, HREF), "label": field_of(element, ANCHOR_TEXT)},
        keep, required=["href", "label"],
    )


def price_rows(pages: DataFrame, keep: Sequence[str] = ("price_date", "source"), html: str = "html") -> DataFrame:
    """Rows of a price table: type, buy and sell price; malformed rows are skipped."""
    row = pages.select(*keep, F.posexplode(H.elements(F.col(html), "tr")).alias("_pos", "row"))
    # The cells are opened by inline, so a row is cut into cells once.
    cells = row.select(*keep, (F.col("_pos") + 1).alias("position"), F.inline(F.array(F.struct(H.elements(F.col("row"), "td").alias("cells")))))
    cell = lambda i: F.try_element_at("cells", F.lit(i))
    price = lambda i: N.thousands(H.element_text(cell(i), "span", PRICE_VALUE))
    fields = {"gold_type": H.element_text(cell(1), "h2"), "buy_price": price(2), "sell_price": price(3)}
    complete = cells.where(F.size("cells") >= 3)
    return complete.select(*keep, "position", F.inline(F.array(F.struct(*[v.alias(n) for n, v in fields.items()])))).dropna(subset=list(fields))


def _attribute(tag: Column, name: str) -> Column:
    return F.trim(F.regexp_extract(tag, rf'\b{name}="([^"]*)"', 1))


def _text(at: str, tag: str, having: str | None = None) -> Column:
    """Text of the first such element of a ``cut`` column."""
    return plain_text(H.picked(F.col(at), tag, having))


def _tile_steps(boxes: Mapping[str, str]) -> list[dict[str, Column]]:
    """What the fields of a tile read: its visible markup, that cut at one kind of tag, the boxes with a class."""
    shown = F.col("_shown")
    return [
        {"_link": F.regexp_extract("element", TILE_LINK, 1), "_shown": H.visible(F.col("element"))},
        {"_div": H.cut(shown, "div"), "_head": H.element(shown, "h3")},
        {name: H.picked(F.col("_div"), "div", having) for name, having in boxes.items()},
    ]


def product_tiles(pages: DataFrame, keep: Sequence[str] = ("source",), html: str = "html",
                  more: Mapping[str, Column] | None = None) -> DataFrame:
    """Tiles of a device listing as raw text fields; ``product_id`` is the tile's place.

    ``more`` adds fields over ``element`` and the columns of ``_tile_steps``.
    """
    tag = F.col("_link")
    fields = {
        "link": tag,
        "name": plain_text(H.without_first(F.col("_head"), "span", NEW_MODEL_BADGE)),
        "brand": _attribute(tag, "data-brand"),
        "category": _attribute(tag, "data-cate"),
        "color": _attribute(tag, "data-color"),
        "price": _attribute(tag, "data-price"),
        "price_old": _attribute(tag, "price-old"),
        "rating": plain_text(H.element(F.col("_rating"), "b")),
        "sold": plain_text(H.element(F.col("_rating"), "span")),
    }
    rows = extract_records(
        pages, H.elements(F.col(html), "li", PRODUCT_TILE), {**fields, **(more or {})},
        keep, required=["link"], shared=_tile_steps({"_rating": RATING_BOX}), texts=list(fields),
    ).withColumn("rating", F.when(F.col("rating") != NOT_RATED, F.col("rating")))
    return rows.withColumnRenamed("position", "product_id").drop("link")


def laptop_tiles(pages: DataFrame, keep: Sequence[str] = ("source",), html: str = "html") -> DataFrame:
    """Tiles of a laptop listing: RAM and ROM stand in the comparison box, as its first two spans, or not at all."""
    box = H.elements(H.picked(F.col("_div"), "div", COMPARE_BOX), "span")
    rows = product_tiles(pages, keep, html, {"_box": box})
    size = lambda i: F.when(F.size("_box") >= 2, X.blank_to_null(F.try_element_at("_texts", F.lit(i))))
    texts = rows.withColumn("_texts", F.transform("_box", plain_text))
    return texts.withColumns({"RAM": size(1), "ROM": size(2)}).drop("_box", "_texts")


def phone_tiles(pages: DataFrame, keep: Sequence[str] = ("source",), html: str = "html") -> DataFrame:
    """Tiles of a phone listing with screen, price and rating text."""
    shown = F.col("_shown")
    screen = F.col("_screen")
    steps = [*_tile_steps({"_rating": RATING_BOX, "_compare": PHONE_SCREEN}), {"_screen": H.elements(F.col("_compare"), "span")}]
    fields = {
        "link": F.col("_link"),
        "name": plain_text(H.without_first(F.col("_head"), "span", NEW_MODEL_BADGE)),
        "screen_size": plain_text(F.try_element_at(screen, F.lit(1))),
        "resolution": plain_text(F.try_element_at(screen, F.lit(2))),
        "new_price": plain_text(H.element(shown, "strong", PHONE_PRICE)),
        "old_price": plain_text(H.element(shown, "p", PHONE_OLD_PRICE)),
        "percent": plain_text(H.element(shown, "span", PHONE_PERCENT)),
        "rating": plain_text(H.element(F.col("_rating"), "b")),
        "sold": plain_text(H.element(F.col("_rating"), "span")),
        "_rated": F.col("_rating").isNotNull(),
    }
    texts = [n for n in fields if n not in ("screen_size", "resolution", "_rated")]
    rows = extract_records(pages, H.elements(F.col(html), "li", PRODUCT_TILE), fields, keep, required=["link"], shared=steps, texts=texts)
    return rows.withColumn("sold", F.when(F.col("_rated"), F.coalesce("sold", F.lit("0")))).drop("link", "_rated")


def distinct_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Set of addresses over all pages; duplicates of a page fold before the shuffle."""
    links = F.array_distinct(matches(F.col(html), HREF))
    return pages.select(F.explode(links).alias("href")).filter(F.col("href") != "").distinct()


def leading_links(pages: DataFrame, start: int = 2, length: int = 2, keep: Sequence[str] = ("page_id",),
                  html: str = "html") -> DataFrame:
    """A fixed slice of each page's links, in page order."""
    chosen = F.slice(matches(F.col(html), HREF), start, length)
    return pages.select(*keep, F.posexplode(chosen).alias("place", "href"))


def profile_fields(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Player profile page to one raw record; a page without an id in its address is dropped."""
    # Each step reads columns of the steps before, so a page is cleaned once and cut once per kind of tag.
    page = F.col(html)
    rows = opened(pages, [F.col(url).alias("_url")], {
        "player_id": X.url_id(F.col(url)), "_shown": H.visible(page), "_body": F.regexp_replace(page, H.TAG, ""),
        "_foot_place": F.when(page.rlike(INFO_LABEL_NAME), F.lit(7)).otherwise(F.lit(6))})
    rows = rows.filter(F.col("player_id").isNotNull())
    tags = sorted({tag for tag, _ in PROFILE.values()} | {"li", "span"})
    rows = opened(rows, ["_url", "player_id", "_body", "_foot_place"], {f"_{tag}": H.cut(F.col("_shown"), tag) for tag in tags})
    ages = F.transform(H.all_picked(F.col("_li"), "li", PROFILE_LABEL), lambda label: F.regexp_extract(plain_text(label), PROFILE_AGE, 1))
    rows = opened(rows, ["_url", "player_id"], {
        **{name: _text(f"_{tag}", tag, having) for name, (tag, having) in PROFILE.items()},
        "age": F.try_element_at(F.filter(ages, lambda age: age != ""), F.lit(1)),
        "player_height": F.regexp_extract("_body", PROFILE_HEIGHT, 1),
        "player_agent": F.regexp_extract("_body", PROFILE_AGENT, 1),
        "strong_foot": plain_text(H.picked(F.col("_span"), "span", INFO_BOLD, F.col("_foot_place"))),
        "_contract": F.regexp_extract("_body", PROFILE_CONTRACT, 1)})
    found = lambda name: X.blank_to_null(F.col(name))
    return rows.select(
        "player_id", *[found(c).alias(c) if c in PROFILE else F.col(c) for c in ("name", "player_club", "age", "position", "market_value", "nationality")],
        F.trim(found("player_height")).alias("player_height"),
        F.coalesce(F.trim(found("player_agent")), F.lit("None")).alias("player_agent"),
        "strong_foot",
        X.last_word(found("_contract")).alias("contract_value_time"),
        F.col("_url").alias("source"),
    )


def stat_fields(pages: DataFrame, keep: Sequence[str] = ("player_id",), html: str = "html") -> DataFrame:
    """Season statistics page: cells picked by position and named."""
    cut = opened(pages, keep, {"_td": H.cut(H.visible(F.col(html)), "td")})
    cells = opened(cut, keep, {"_centred": H.all_picked(F.col("_td"), "td", STAT_CENTRED), "_right": H.all_picked(F.col("_td"), "td", STAT_RIGHT)})
    text = lambda array, place: plain_text(F.try_element_at(array, F.lit(place)))
    centred = {name: text("_centred", place + 1) for name, place in STAT_CELLS.items()}
    right = {"minutes_per_goal": text("_right", 2), "minutes_played": text("_right", 3)}
    return cells.select(*keep, *[v.alias(k) for k, v in {**centred, **right}.items()])


def stat_url(base: str, url: Column, season: int) -> Column:
    """Address of a player's season statistics, from the address of the profile."""
    return X.join_url(base, X.url_slug(url), STAT_PATH, X.url_id(url), f"{STAT_SEASON}{season}")


def player_records(profiles: DataFrame, stats: DataFrame) -> DataFrame:
    """Raw player records from a profile page and a statistics page each, joined by the player's id.

    A player without a statistics page has NULL stats. Goalkeepers are left out; what the pages don't say is 0.
    """
    field = profile_fields(profiles).filter(~F.col("position").eqNullSafe(F.lit("Goalkeeper")))
    return field.join(stat_fields(stats), "player_id", "left").withColumns(
        {"goalkeeper_or_not": F.lit("0"), "goals_conceded": F.lit("0"), "clean_sheet": F.lit("0")})
