"""JSON documents (API answers) to raw records, with VARIANT expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.schemas import UNREADABLE

# Field -> paths in order of preference. ``truthy`` fields take the first usable value, the others
# the first path that is present at all (so a null there hides the later paths).
MAPPING: dict[str, tuple[str, ...]] = {
    "title": ("name.common", "name.official", "title", "subject", "value", "id"),
    "url": ("url", "wikipedia"),
    "description": ("description", "note"),
    "author": ("authors", "country"),
    "tags": ("region", "category"),
    "score": ("population", "value"),
}


#: JSON values that do not count as usable; as texts, ``"0"`` and ``"false"`` do.
_EMPTY = ("", "0", "0.0", "-0.0", "false", "[]", "{}")


def _at(item: Column, path: str) -> Column:
    return F.try_variant_get(item, f"$.{path}", "variant")


def _text_at(item: Column, path: str) -> Column:
    """The value at a path as text; NULL if it is absent or null."""
    return F.try_variant_get(item, f"$.{path}", "string")


def _as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def first_usable(item: Column, paths: tuple[str, ...], texts: dict[str, Column]) -> Column:
    """Text of the first path with a value that is not empty, zero, false or null; else ''.

    The last path is taken as text, so there a zero counts. ``texts`` holds the values as text by path.
    """

    def usable(path: str) -> Column:
        text = texts[path]
        spelled = (text != "") & F.startswith(F.to_json(_at(item, path)), F.lit('"'))
        return F.when(~text.isin(*_EMPTY) | spelled, text)

    *front, last = paths
    return F.coalesce(*[usable(path) for path in front], texts[last], F.lit(""))


def first_present(item: Column, paths: tuple[str, ...], default: Column, texts: dict[str, Column]) -> Column:
    """Text of the first path that exists, '' if that holds null; ``default`` if no path exists."""
    chosen = default
    for path in reversed(paths):
        chosen = F.when(texts[path].isNotNull(), texts[path]).when(_at(item, path).isNotNull(), "").otherwise(chosen)
    return chosen


def _head(text: Column) -> Column:
    """The first sign of a JSON text."""
    return F.regexp_extract(text, r"^[\x20\t\r\n]*+(.)", 1)


def _listed(text: Column) -> Column:
    """The elements of a JSON list as JSON texts, NULL if it is no list. Nothing is parsed deeper than that."""
    return F.when(_head(text) == "[", F.from_json(text, "array<string>"))


def _split_texts(text: Column, max_items: int | None) -> Column:
    """The items of a document that is not parsed as a whole: elements and members as JSON texts, each parsed alone."""
    listed = _listed(text)
    members = F.when(_head(text) == "{", F.from_json(text, "map<string,string>"))
    second = F.when(F.size(members) == 2, F.get(F.map_values(members), F.lit(1)))
    by_key = (
        F.when(F.map_contains_key(members, "works"), _listed(members["works"]))
        .when(F.map_contains_key(members, "docs"), _listed(members["docs"]))
        .otherwise(F.array(text))
    )
    items = F.coalesce(listed, _listed(second), F.when(members.isNotNull(), by_key))
    return items if max_items is None else F.slice(items, 1, max_items)


def _split_parsed(parsed: Column, text: Column, max_items: int | None) -> Column:
    """The items of a parsed document."""

    def listed(value: Column) -> Column:
        return F.try_variant_get(value, "$", "array<variant>")

    # a parsed object no longer knows the order of its members
    second = F.get(F.array_distinct(F.json_object_keys(text)), F.lit(1))
    members = F.try_variant_get(parsed, "$", "map<string,variant>")
    two = F.when(F.size(members) == 2, listed(F.try_element_at(members, second)))
    works, docs = _at(parsed, "works"), _at(parsed, "docs")
    by_key = F.when(works.isNotNull(), listed(works)).when(docs.isNotNull(), listed(docs)).otherwise(F.array(parsed))
    items = F.when(_head(text) == "[", listed(parsed)).when(_head(text) == "{", F.coalesce(two, by_key))
    return items if max_items is None else F.slice(items, 1, max_items)


def with_items(documents: DataFrame, max_items: int | None = None) -> DataFrame:
    """Add ``items``, a list of (item VARIANT, readable BOOLEAN), and ``broken``, true if ``document`` is no JSON.

    A list gives its elements; an object of two keys whose second value is a list gives that list;
    any other object gives ``works``, else ``docs``, else itself. With ``max_items`` only the first ones count. A document
    is parsed once; only one that cannot be parsed as a whole is split as text and parsed by item. A broken
    document has one item, NULL, so that it is not lost.
    """
    text = F.col("document")
    parsed = documents.withColumn("_parsed", F.try_parse_json(text))
    whole = F.col("_parsed").isNotNull()
    found = F.transform(_split_parsed(F.col("_parsed"), text, max_items), lambda item: F.struct(item.alias("item"), F.lit(True).alias("readable")))

    def alone(one: Column) -> Column:
        item = F.try_parse_json(one)
        return F.struct(item.alias("item"), (item.isNotNull() | (_head(one) != "{")).alias("readable"))

    split = parsed.withColumn("_split", F.when(~whole, F.transform(_split_texts(text, max_items), alone)))
    # a text with no sign in it is neither
    broken = ~whole & F.col("_split").isNull() & (F.trim(text) != "")
    none = F.array(F.struct(F.lit(None).cast("variant").alias("item"), F.lit(True).alias("readable")))
    marked = split.withColumn("broken", F.coalesce(broken, F.lit(False)))
    return marked.withColumn("items", F.when(F.col("broken"), none).when(whole, found).otherwise(F.col("_split"))).drop("_parsed", "_split")


def map_item(
    item: Column, source_url: Column, mapping: dict[str, tuple[str, ...]] = MAPPING, texts: dict[str, Column] | None = None
) -> list[Column]:
    """The record fields of one JSON item. Other layouts pass a mapping of their own.

    ``texts`` are columns with the mapped paths' values as text, where these are at hand.
    """
    empty = F.lit("")
    members = F.try_variant_get(item, "$", "map<string,string>")
    category = _at(item, "category")
    # The category has to be text; any other type is kept as NULL and fails validation later.
    extra = F.map_concat(
        F.map_filter(members, lambda key, value: key != "category"),
        F.when(category.isNull(), F.create_map().cast("map<string,string>")).otherwise(
            F.create_map(F.lit("category"), F.when(F.startswith(F.to_json(category), F.lit('"')), _as_text(category)))
        ),
    )
    texts = texts or {path: _text_at(item, path) for paths in mapping.values() for path in paths}
    return [
        first_usable(item, mapping["title"], texts).alias("title"),
        first_present(item, mapping["url"], source_url, texts).alias("url"),
        first_present(item, mapping["description"], empty, texts).alias("description"),
        first_present(item, mapping["author"], empty, texts).alias("author"),
        F.array(first_present(item, mapping["tags"], empty, texts)).alias("tags"),
        first_present(item, mapping["score"], empty, texts).alias("score"),
        extra.alias("extra"),
    ]


def extract_documents(
    documents: DataFrame, mapping: dict[str, tuple[str, ...]] = MAPPING, max_items: int | None = None
) -> DataFrame:
    """Raw records from landed documents (``source_name, source_url, document, scraped_at, batch_id,
    source_ord, page_no``). Elements that are no objects, and items without a title, are skipped.

    A document that is no JSON, and an item that cannot be parsed, become a row of their own with the reason in
    ``extra``: cleaning leaves it out and the audit counts it as an error. Of a repeated key the last value counts.
    """
    documents.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    keep = ["source_name", "source_url", "scraped_at", "batch_id", "source_ord", "page_no"]
    opened = with_items(documents, max_items).select(*keep, "broken", F.posexplode("items").alias("item_pos", "one"))
    # An element that is no object has no fields, hence no title.
    reason = F.when(F.col("broken"), "the document is no JSON").when(~F.col("one.readable"), "the item cannot be parsed")
    paths = list(dict.fromkeys(path for some in mapping.values() for path in some))
    texts = {path: F.col(f"_at{i}") for i, path in enumerate(paths)}
    found = opened.select(
        *keep, F.col("item_pos").cast("bigint").alias("item_pos"), reason.alias("reason"), F.col("one.item").alias("item"),
        *[_text_at(F.col("one.item"), path).alias(f"_at{i}") for i, path in enumerate(paths)],
    )
    records = found.select(*keep, "item_pos", "reason", *map_item(F.col("item"), F.col("source_url"), mapping, texts))
    marked = F.when(F.col("reason").isNull(), F.col("extra")).otherwise(F.create_map(F.lit(UNREADABLE), F.col("reason")))
    kept = records.filter((F.col("title") != "") | F.col("reason").isNotNull())
    return kept.withColumn("extra", marked).drop("source_url", "reason")
