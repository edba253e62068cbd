"""HTML pages to records and texts.

Links, headings and the items of the two fixed layouts are Column expressions (``markup``). A source's own selectors may be
compound and need the tag tree of a page, so those items are extracted in ``mapInPandas`` (one Arrow hop, no shuffle);
everything after the extraction, URL resolution included, is Column expressions again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.entities import decode_references
from gleanery.functions.numeric import rating_value
from gleanery.functions.text import strip
from gleanery.functions.url import with_item_url, with_joined_url
from gleanery.operators.lookup import lookup_join
from gleanery.schemas import UNREADABLE
from gleanery.sources.markup import INVISIBLE, attribute, elements, first_child, first_element, first_text, own_texts, value_of, visible
from gleanery.sources.selectors import Node, parse_page, parse_selector, select, select_one

TEXT_FIELDS = ("title", "description", "author", "score", "price", "rating", "stars")
# Elements that never contain themselves, so a pattern finds their end.
_FLAT_TAGS = frozenset("title h1 h2 h3 h4 h5 h6 option caption".split())

_ITEM_COLUMNS = ("item_pos bigint, href string, tags array<string>, "
                 + ", ".join(f"{name} string" for name in TEXT_FIELDS) + ", unreadable string")
ITEMS_PER_FRAME = 2_000


def _items(html: str, selectors: dict[str, str]) -> Iterator[dict]:
    """Items of one page; an item without a title is skipped."""
    if not selectors.get("items"):
        return

    def text(item: Node, name: str) -> str:
        found = select_one(item, selectors[name]) if selectors.get(name) else None
        return found.text() if found else ""

    for position, item in enumerate(select(parse_page(html), selectors["items"])):
        record = {name: text(item, name) for name in TEXT_FIELDS}
        if not record["title"]:
            continue
        link = select_one(item, selectors["url"]) if selectors.get("url") else None
        tags = [t.text() for t in select(item, selectors["tags"])] if selectors.get("tags") else []
        yield record | {"item_pos": position, "href": link.attrs.get("href", "") if link else "", "tags": tags}


def _read_page(page: dict) -> list[dict]:
    """The items of a page, or one row with the reason if the page cannot be read: one bad page must not end a job."""
    try:
        return list(_items(page["html"], dict(page["selectors"] or {})))
    except Exception as failure:  # noqa: BLE001 - the parser raises what it likes on hostile markup
        reason = f"{type(failure).__name__}: {failure}"[:200]
        return [{"item_pos": 0, "href": "", "tags": [], "unreadable": reason}]


def _explode_items(pages: DataFrame, keep: list[str]) -> DataFrame:
    """Items by the selectors of each page, over ``html`` and ``selectors``; ``keep`` columns go along with every item."""
    kept = ", ".join(f"{pages.schema[name].name} {pages.schema[name].dataType.simpleString()}" for name in keep)

    def frame_of(rows: list[dict]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=[*keep, "item_pos", "href", "tags", *TEXT_FIELDS, "unreadable"])
        for name in TEXT_FIELDS:
            frame[name] = frame[name].fillna("")
        frame["unreadable"] = frame["unreadable"].astype(object).where(frame["unreadable"].notna(), None)
        return frame

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page in batch.to_dict("records"):
                head = {name: page[name] for name in keep}
                rows.extend(head | item for item in _read_page(page))
                if len(rows) >= ITEMS_PER_FRAME:
                    yield frame_of(rows)
                    rows = []
            yield frame_of(rows)

    return pages.select(*keep, "html", "selectors").mapInPandas(read, schema=f"{kept}, {_ITEM_COLUMNS}")


_PAGE_KEYS = ["source_name", "category", "page_url", "scraped_at", "batch_id", "source_ord", "page_no"]


def attach_sources(pages: DataFrame, sources: DataFrame) -> DataFrame:
    """Give every landed page (``source_key``, ``page_no``, ``url``, ``html``, ...) its source's settings."""
    settings = sources.select(
        F.col("key").alias("source_key"), F.col("name").alias("source_name"), "category", "selectors", "source_ord"
    )
    return lookup_join(pages.withColumnRenamed("url", "page_url"), settings, ["source_key"], how="inner")


def _with_extra(items: DataFrame, score: Column, **extra: Column) -> DataFrame:
    pairs = [part for name, value in extra.items() for part in (F.lit(name), value)]
    reason = F.create_map(F.lit(UNREADABLE), F.col("unreadable"))
    return with_item_url(items, F.col("page_url"), F.col("href"), "url").select(
        "source_name",
        "url",
        "title",
        "description",
        "author",
        "tags",
        score.alias("score"),
        F.when(F.col("unreadable").isNull(), F.create_map(*pairs)).otherwise(reason).alias("extra"),
        "scraped_at",
        "batch_id",
        "source_ord",
        F.coalesce(F.col("page_no").cast("bigint"), F.lit(0)).alias("page_no"),
        "item_pos",
    )


def extract_items(pages: DataFrame) -> DataFrame:
    """Raw records from pages with attached sources, by each source's own selectors."""
    items = _explode_items(pages, _PAGE_KEYS)
    extra = {name: F.col(name) for name in ("category", "price", "rating", "stars")}
    return _with_extra(items, F.col("score"), **extra)


def _layout_items(pages: DataFrame, tag: str, css_class: str, link: Column | None = None, **fields: Column) -> DataFrame:
    """One row per element of a tag and class; ``fields`` are found in ``item`` and in its ``link``. Pages without HTML have none."""
    found = pages.select(*_PAGE_KEYS, F.posexplode(elements(visible(F.col("html")), tag, css_class)).alias("item_pos", "item"))
    found = found if link is None else found.withColumn("link", link)
    none = {name: F.lit("") for name in ("title", "href", "description", "author")} | {"tags": F.array().cast("array<string>")}
    columns = none | fields | {"item_pos": F.col("item_pos").cast("bigint"), "unreadable": F.lit(None).cast("string")}
    return found.select(*_PAGE_KEYS, *[column.alias(name) for name, column in columns.items()])


def extract_catalogue(pages: DataFrame) -> DataFrame:
    """Raw records of product pages: ``article.product_pod`` with title and link from ``h3 > a``, the price of
    ``p.price_color`` and the rating word of ``p.star-rating`` as score 1..5 (else 0)."""
    link = F.get(F.array_compact(F.transform(elements(F.col("item"), "h3"), lambda heading: first_child(heading, "a"))), F.lit(0))
    items = _layout_items(
        pages, "article", "product_pod", link,
        title=strip(value_of(F.col("link"), "title")),
        href=value_of(F.col("link"), "href"),
        price=first_text(first_element(F.col("item"), "p", "price_color")),
        rating=value_of(first_element(F.col("item"), "p", "star-rating"), "class"),
    )
    rating = rating_value(F.col("rating")).cast("string")
    return _with_extra(items, rating, price=F.col("price"), rating=rating)


def extract_quotes(pages: DataFrame) -> DataFrame:
    """Raw records of quote pages: ``div.quote`` with ``span.text``, ``small.author`` and ``div.tags a.tag``; every quote carries
    the page's own URL."""
    lists = F.array_join(elements(F.col("item"), "div", "tags"), " ")
    items = _layout_items(
        pages, "div", "quote",
        title=first_text(first_element(F.col("item"), "span", "text")),
        author=first_text(first_element(F.col("item"), "small", "author")),
        tags=F.flatten(F.transform(elements(lists, "a", "tag"), own_texts)),
    )
    records = _with_extra(items, F.lit(""), none=F.lit(None).cast("string"))
    return records.withColumn("extra", F.map_filter("extra", lambda key, value: value.isNotNull()))


def extract_text(html: Column, selector: str) -> Column:
    """Text of the first match, its text pieces stripped and joined without a gap; '' if none."""
    (_, tag, conditions), *others = parse_selector(selector)
    if tag in _FLAT_TAGS and not conditions and not others:
        visible = F.regexp_replace(html, INVISIBLE, "<>")
        inner = F.regexp_extract(visible, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)(?:</{tag}\s*>|\z)", 1)
        pieces = F.transform(F.split(inner, "<[^>]*>"), lambda piece: strip(decode_references(piece)))
        return F.coalesce(F.array_join(pieces, ""), F.lit(""))

    @F.pandas_udf("string")
    def first_text(pages: pd.Series) -> pd.Series:
        def text(page: str | None) -> str:
            try:
                node = select_one(parse_page(page), selector)
            except Exception:  # noqa: BLE001 - a page that cannot be read has no match
                return ""
            return node.text() if node else ""

        return pd.Series([text(page) for page in pages], dtype=object)

    return first_text(html)


def extract_links(pages: DataFrame, html: str = "html", base: str | None = "url") -> DataFrame:
    """One row per ``<a href>``: the page's columns (without ``html``), ``link_pos``, ``link``.

    Script links and bare ``#`` are dropped, the rest keeps document order and repeats; links that are
    not absolute are resolved against ``base`` where one is given.
    """
    visible = F.regexp_replace(html, INVISIBLE, "")
    anchors = F.split(visible, r"(?i)<a(?=\s)", -1)
    values = F.array_compact(F.transform(F.slice(anchors, F.lit(2), F.size(anchors)), lambda anchor: attribute(anchor, "href")))
    hrefs = F.transform(values, lambda value: strip(decode_references(value)))
    wanted = F.filter(hrefs, lambda h: ~F.startswith(h, F.lit("javascript:")) & (h != "#"))
    others = [name for name in pages.columns if name != html]
    links = pages.select(*others, F.posexplode(wanted).alias("link_pos", "href"))
    if base is None:
        return links.withColumnRenamed("href", "link")
    absolute = F.startswith("href", F.lit("http://")) | F.startswith("href", F.lit("https://"))
    joined = with_joined_url(links, F.col(base), F.col("href"), "link")
    return joined.withColumn("link", F.when(absolute, F.col("href")).otherwise(F.col("link"))).drop("href")
