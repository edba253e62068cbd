"""Elements, attributes and texts of HTML as Column expressions.

A page is split at its tags; nothing is parsed into a tree. That is enough for layouts whose items, and the elements sought in
them, do not contain others of their own kind. Patterns never repeat a group: Java matches those recursively, and a hostile
page would exhaust the stack of the executor. No lambda refers to an expression outside of it, as Spark would evaluate that
once per element.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.entities import decode_references
from gleanery.functions.text import strip
from gleanery.sources.selectors import CLOSES_P, VOID

INVISIBLE = r"(?is)<!--.*?(?:-->|\z)|<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)"
# Pieces of a tag: "= value", a stray quoted text, the end, or a name; the second form also takes what lies between them.
_PIECE = r"""=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)|"[^"]*+"|'[^']*+'|>|[^\s=>"']++"""
_ANY_PIECE = _PIECE + r"""|\s++|["']"""
_QUOTED = """"[^"]*"|'[^']*'"""
_ENDS_P = "|".join(sorted(CLOSES_P))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used: Columns are trees, so repeats would multiply."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def visible(html: Column) -> Column:
    """The page without comments, scripts and styles; a mark keeps the texts beside them apart."""
    return F.regexp_replace(html, INVISIBLE, "<!>")


def _head(after_name: Column) -> Column:
    """A tag's text from behind its name up to its ``>``; NULL if it has none. A ``>`` within quotes does not end it."""

    def whole(pieces: Column) -> Column:
        before = F.slice(pieces, F.lit(1), F.greatest(F.array_position(pieces, ">").cast("int") - 1, F.lit(0)))
        return F.when(F.array_contains(pieces, ">"), F.array_join(before, ""))

    def found(text: Column) -> Column:
        cut_short = lambda simple: F.regexp_replace(simple, _QUOTED, "").rlike("[\"']")
        by_pieces = once(F.regexp_extract_all(text, F.lit(_ANY_PIECE), F.lit(0)), whole)
        head = once(F.substring_index(text, ">", 1), lambda simple: F.when(cut_short(simple), by_pieces).otherwise(simple))
        return F.when(F.contains(text, F.lit(">")), head)

    return once(after_name, found)


def _after_head(after_name: Column) -> Column:
    return once(after_name, lambda text: F.substring(text, F.char_length(_head(text)) + 2, F.char_length(text)))


def attribute(after_name: Column, name: str) -> Column:
    """Value of a tag's first attribute of that name, as written; NULL if there is none."""

    def values(pieces: Column) -> Column:
        following = F.slice(pieces, F.lit(2), F.size(pieces))
        return F.zip_with(
            pieces, following, lambda piece, then: F.when((F.lower(piece) == name) & F.startswith(then, F.lit("=")), then)
        )

    pieces = F.regexp_extract_all(_head(after_name), F.lit(_PIECE), F.lit(0))
    bare = F.regexp_replace(F.get(F.array_compact(once(pieces, values)), F.lit(0)), r"^=\s*", "")
    return F.regexp_replace(bare, r"""^(["'])(?s:(.*))\1$""", "$2")


def value_of(after_name: Column, name: str) -> Column:
    """An attribute's value with its references decoded; '' if there is none."""
    return F.coalesce(once(attribute(after_name, name), decode_references), F.lit(""))


def has_class(after_name: Column, name: str) -> Column:
    listed = once(attribute(after_name, "class"), lambda classes: classes.rlike(rf"(?:^|\s){name}(?:\s|\z)"))
    return F.when(F.contains(after_name, F.lit(name)), F.coalesce(listed, F.lit(False))).otherwise(False)


def _up_to_end(after_name: Column, tag: str) -> Column:
    """The text up to the end tag that belongs to the tag it starts in; all of it if there is none. A paragraph also ends where a block begins."""
    if tag == "p":
        return F.regexp_replace(after_name, rf"(?is)<(?:/p|{_ENDS_P})(?:[\s/>]|\z).*", "")

    def step(piece: Column, place: Column) -> Column:
        change = F.when(place == 0, 0).when(F.startswith(piece, F.lit("/")), -1).otherwise(1)
        return F.struct(change.alias("change"), (F.char_length(piece) + F.when(place == 0, 0).otherwise(1)).alias("length"))

    def take(state: Column, step: Column) -> Column:
        depth = F.when(state["depth"] < 0, state["depth"]).otherwise(state["depth"] + step["change"])
        return F.struct(depth.alias("depth"), (state["length"] + F.when(depth < 0, 0).otherwise(step["length"])).alias("length"))

    def cut(text: Column) -> Column:
        if_alone = F.regexp_replace(text, rf"(?is)</{tag}(?:[\s/>]|\z).*", "")
        steps = F.transform(F.split(text, rf"(?i)<(?=/?{tag}(?:[\s/>]|\z))", -1), step)
        start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("length"))
        matched = F.substring(text, F.lit(1), F.aggregate(steps, start, take, lambda state: state["length"]))
        return F.when(text.rlike(rf"(?i)<{tag}[\s/>]"), matched).otherwise(if_alone)

    return once(after_name, cut)


def elements(markup: Column, tag: str, css_class: str | None = None) -> Column:
    """The elements of a tag (and class) in document order, each from behind its tag's name up to its end tag."""
    # Every tag is written anew with one blank behind its name, the wanted ones with a tab instead.
    marked = F.transform(
        F.split(markup, rf"(?i)<{tag}(?=[\s/>])", -1),
        lambda piece, i: F.when(i == 0, piece)
        .when(F.lit(True) if css_class is None else has_class(piece, css_class), F.concat(F.lit(f"<{tag}\t"), piece))
        .otherwise(F.concat(F.lit(f"<{tag} "), piece)),
    )
    found = once(F.split(F.array_join(marked, ""), f"<{tag}\t", -1), lambda pieces: F.slice(pieces, F.lit(2), F.size(pieces)))
    return F.transform(found, lambda piece: _up_to_end(piece, tag))


def first_element(markup: Column, tag: str, css_class: str | None = None) -> Column:
    """The first such element; NULL if there is none."""
    return F.get(elements(markup, tag, css_class), F.lit(0))


def _directly_inside(inside: Column, wanted: Callable[[Column], Column]) -> Column:
    """What ``wanted`` gives (if not NULL) for the pieces of an element's inner markup that lie in no element below it.

    A piece is a struct: the ``name`` of an opening tag, the ``tag`` behind its name with the text that follows, and the ``text``
    alone, NULL where that already belongs to the element opened.
    """

    def parts(piece: Column, place: Column) -> Column:
        name = F.when(place == 0, "").otherwise(F.lower(F.regexp_extract(piece, r"^([A-Za-z][^\s/>]*)", 1)))
        tag = F.when(place == 0, "").otherwise(F.regexp_replace(piece, r"^[A-Za-z][^\s/>]*", ""))
        text = F.when(place == 0, piece).otherwise(_after_head(piece))
        closes = (place > 0) & piece.rlike("^/[A-Za-z]")
        return F.struct(name.alias("name"), tag.alias("tag"), text.alias("text"), closes.alias("closes"))

    def with_change(piece: Column) -> Column:
        never_closed = piece["name"].isin("", *sorted(VOID)) | F.coalesce(F.endswith(_head(piece["tag"]), F.lit("/")), F.lit(False))
        change = F.when(piece["closes"], -1).when(never_closed, 0).otherwise(1)
        return F.struct(piece["name"], piece["tag"], piece["text"], change.alias("change"))

    def step(state: Column, piece: Column) -> Column:
        after = F.when(state["depth"] < 0, state["depth"]).otherwise(state["depth"] + piece["change"])
        seen = F.struct(
            F.when(state["depth"] == 0, piece["name"]).alias("name"), piece["tag"], F.when(after == 0, piece["text"]).alias("text")
        )
        found = lambda value: F.when(value.isNull(), state["found"]).otherwise(F.concat(state["found"], F.array(value)))
        return F.struct(after.alias("depth"), once(wanted(seen), found).alias("found"))

    pieces = F.transform(F.transform(F.split(inside, "<(?=[A-Za-z/!?])", -1), parts), with_change)
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("found"))
    return F.aggregate(pieces, start, step, lambda state: state["found"])


def own_texts(element: Column) -> Column:
    """The element's own texts, without those of elements in it and without empty ones."""

    def texts(inside: Column) -> Column:
        alone = F.when(inside == "", F.array().cast("array<string>")).otherwise(F.array(inside))
        between = _directly_inside(inside, lambda piece: F.nullif(piece["text"], F.lit("")))
        return F.when(F.contains(inside, F.lit("<")), between).otherwise(alone)

    return F.transform(once(_after_head(element), texts), decode_references)


def first_text(element: Column) -> Column:
    """The first of the element's own texts, stripped; '' if there is none."""
    return F.coalesce(strip(F.get(own_texts(element), F.lit(0))), F.lit(""))


def first_child(element: Column, tag: str) -> Column:
    """The first element of a tag directly in this one, up to its first inner tag; NULL if there is none."""
    wanted = lambda piece: F.when(piece["name"] == tag, piece["tag"])
    return F.get(_directly_inside(_after_head(element), wanted), F.lit(0))
