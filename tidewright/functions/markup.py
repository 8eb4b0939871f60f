"""Elements of HTML with their nested markup whole, in DataFrame functions only.

A page is cut in front of every opening and closing tag of one kind. Folding over the pieces,
an opening tag is one level down and a closing tag one level up; an element ends where its
level returns. So an inner element of the same kind does not end the outer one, as it would
with a pattern up to the next closing tag. Each page is a fold of its own: no shuffle.

Inner elements are elements, too, and come after the one that holds them, in page order. An
element that is never closed lasts to the end of the page; a closing tag too many is passed
over. Comments, scripts and styles hold no elements. A ``>`` inside a quoted attribute does
not end a tag. A NULL page has a NULL list.

Who needs several elements of one kind cuts once (``cut``) and picks from that (``picked``). Spark
works out an expression as often as it is written, so callers open shared values as columns first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewright.functions.text import blank_to_null

HIDDEN = r"(?is)<(?:!--.*?-->|script\b.*?</script\s*>|style\b.*?</style\s*>)"
TAG = r"""(?s)<(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""


def has_class(name: str) -> str:
    """Pattern of an opening tag that carries a class among others."""
    return rf'(?i)\bclass\s*=\s*"[^"]*(?<![\w-]){name}(?![\w-])[^"]*"'


def plain_text(html: Column) -> Column:
    """Markup removed, ends trimmed; NULL stays NULL."""
    return F.trim(F.regexp_replace(html, TAG, ""))


def _opening(tag: str) -> str:
    return rf"""(?is)^<{tag}\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""


def _spans(pieces: Column, tag: str) -> Column:
    """(first piece, piece of the closing tag) of every element, by first piece."""
    def step(seen: Column, piece: Column) -> Column:
        at, levels, done = seen["at"], seen["levels"], seen["done"]
        opens, closes = piece.rlike(rf"(?i)^<{tag}\b"), piece.rlike(rf"(?i)^</{tag}\b") & (F.size(levels) > 0)
        ended = F.struct(F.try_element_at(levels, F.lit(-1)).alias("first"), at.alias("past"))
        return F.struct(
            (at + 1).alias("at"),
            F.when(opens, F.array_append(levels, at)).when(closes, F.slice(levels, F.lit(1), F.size(levels) - 1)).otherwise(levels).alias("levels"),
            F.when(closes, F.array_append(done, ended)).otherwise(done).alias("done"))

    def finish(seen: Column) -> Column:
        unclosed = F.transform(seen["levels"], lambda at: F.struct(at.alias("first"), seen["at"].alias("past")))
        return F.array_sort(F.concat(seen["done"], unclosed))

    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("levels"),
                       F.array().cast("array<struct<first:int,past:int>>").alias("done"))
    return F.aggregate(pieces, nothing, step, finish)


def visible(html: Column) -> Column:
    """Markup without comments, scripts and styles."""
    return F.regexp_replace(html, HIDDEN, "")


def cut(shown: Column, tag: str) -> Column:
    """``visible`` markup as its pieces at one kind of tag, with the spans of that kind's elements."""
    pieces = F.split(shown, rf"(?i)(?=</?{tag}\b)")
    # The pieces are bound by a lambda, so a page is cut once.
    return F.transform(F.array(pieces), lambda p: F.struct(p.alias("pieces"), _spans(p, tag).alias("spans")))[0]


def _each(at: Column, tag: str, having: str | None, shape, place: int | Column | None = None) -> Column:
    pieces, spans = at["pieces"], at["spans"]
    if having:
        spans = F.filter(spans, lambda s: F.regexp_extract(pieces[s["first"]], _opening(tag), 0).rlike(having))
    if place is not None:
        spans = F.slice(spans, place, 1)  # the others are not written out
    return F.transform(spans, lambda s: shape(pieces, s))


def _bound(html: Column, tag: str, pick) -> Column:
    return F.transform(F.array(cut(visible(html), tag)), pick)[0]


def _body(pieces: Column, span: Column) -> Column:
    return F.array_join(F.slice(pieces, span["first"] + 1, span["past"] - span["first"]), "")


def _inner(tag: str):
    return lambda pieces, s: F.regexp_replace(_body(pieces, s), _opening(tag), "")


def _outer(tag: str):
    def shape(pieces: Column, s: Column) -> Column:
        close = F.coalesce(F.regexp_extract(F.get(pieces, s["past"]), rf"(?i)^</{tag}[^>]*>", 0), F.lit(""))
        return F.concat(_body(pieces, s), close)
    return shape


def elements(html: Column, tag: str, having: str | None = None) -> Column:
    """Array of the inner markup of each ``tag`` element whose opening tag matches ``having``."""
    return _bound(html, tag, lambda at: _each(at, tag, having, _inner(tag)))


def outer_elements(html: Column, tag: str, having: str | None = None) -> Column:
    """As ``elements``, with the opening and the closing tag of each."""
    return _bound(html, tag, lambda at: _each(at, tag, having, _outer(tag)))


def picked(at: Column, tag: str, having: str | None = None, place: int | Column = 1) -> Column:
    """Inner markup of the ``place``-th such element (from 1) of a ``cut``, NULL when there are fewer."""
    return F.try_element_at(_each(at, tag, having, _inner(tag), place), F.lit(1))


def all_picked(at: Column, tag: str, having: str | None = None) -> Column:
    """``elements`` of a ``cut``."""
    return _each(at, tag, having, _inner(tag))


def element(html: Column, tag: str, having: str | None = None, place: int | Column = 1) -> Column:
    """Inner markup of the ``place``-th such element (from 1), NULL when there are fewer."""
    return _bound(html, tag, lambda at: picked(at, tag, having, place))


def element_text(html: Column, tag: str, having: str | None = None, place: int | Column = 1) -> Column:
    """Text of that element; NULL when it is blank or missing."""
    return blank_to_null(plain_text(element(html, tag, having, place)))


def without_first(html: Column, tag: str, having: str | None = None) -> Column:
    """The markup without its first such element."""
    def pick(whole: Column) -> Column:
        found = _bound(whole, tag, lambda at: F.try_element_at(_each(at, tag, having, _outer(tag), 1), F.lit(1)))
        return F.coalesce(F.replace(whole, found, F.lit("")), whole)  # nothing found: NULL, and whole as it is
    return F.transform(F.array(html), pick)[0]
