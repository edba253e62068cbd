"""Producers: items, links and texts of pages, JSON documents, source definitions."""

import json
import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gleanery.operators import stats
from gleanery.plans import dispatch
from gleanery.schemas import UNREADABLE
from gleanery.sources import registry
from gleanery.sources.documents import extract_documents
from gleanery.sources.pages import attach_sources, extract_catalogue, extract_items, extract_links, extract_quotes, extract_text
from gleanery.sources.registry import SOURCES, Source, page_plan, runnable_sources, select_source, source_frame
from gleanery.sources.selectors import parse_page, parse_selector, select

LINK_TABLE = """
<html><body><table>
  <tr class="athing x"><td>1.</td><td><span class="titleline"><a href="https://gazette.example/rain">Rain in May</a></span></td></tr>
  <tr class="spacer"><td></td></tr>
  <tr class="athing"><td><span class="titleline"><a href="https://gazette.example/snow">Snow <i>in June</i></a></span>
</table></body></html>"""
PRODUCTS = """
<article class="product_pod"><p class="star-rating Three"></p>
  <h3><a href="/catalogue/kite.html" title="A Kite for Two">A Kite ...</a></h3><p class="price_color">£31.40</p></article>
<article class="product_pod"><h3><a href="../yarn.html">Yarn</a></h3><p class="price_color">£2.05</p></article>
<article class="product_pod"><h3>Sold out</h3></article>"""


def landed(spark, rows):
    moment = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(key, page, url, html, moment, "b") for key, page, url, html in rows],
        "source_key string, page_no int, url string, html string, scraped_at timestamp, batch_id string",
    )


def test_link_table_and_product_pages(spark):
    pages = landed(
        spark,
        [
            ("hacker_news", None, "https://news.ycombinator.com/", LINK_TABLE),
            ("books_to_scrape", 1, "https://books.toscrape.com/catalogue/page-1.html", PRODUCTS),
            ("books_to_scrape", 2, "https://books.toscrape.com/catalogue/page-2.html", PRODUCTS),
            ("toscrape_jobs", None, "https://quotes.toscrape.com/", PRODUCTS),
            ("hacker_news", None, "https://news.ycombinator.com/x", None),
        ],
    )
    rows = extract_items(attach_sources(pages, source_frame(spark))).orderBy("source_ord", "page_no", "item_pos").collect()
    assert [r.title for r in rows] == ["Rain in May", "Snowin June"] + ["A Kite ...", "Yarn"] * 2
    assert rows[0].url == "https://gazette.example/rain" and rows[0].source_name == "Hacker News"
    assert rows[2].url == "https://books.toscrape.com/catalogue/kite.html" and rows[2].extra["price"] == "£31.40"
    assert rows[3].url == "https://books.toscrape.com/yarn.html" and rows[3].extra["category"] == "ecommerce"


def test_catalogue_and_quotes(spark):
    quote = "<div class=quote><span class=text> “Hi” <b>x</b></span><small class=author>A</small><div class=tags><a class=tag>t</a><a class=tag>u</a></div></div>"
    pages = landed(spark, [("books_to_scrape", 1, "https://h/c/p-1.html", PRODUCTS), ("quotes_to_scrape", 1, "https://h/q", quote)])
    attached = attach_sources(pages, source_frame(spark))
    books = extract_catalogue(attached.filter("source_key = 'books_to_scrape'")).orderBy("item_pos").collect()
    assert [(b.title, b.score, b.url) for b in books] == [
        ("A Kite for Two", "3", "https://h/catalogue/kite.html"), ("", "0", "https://h/yarn.html"), ("", "0", "https://h/c/p-1.html"),
    ]
    (found,) = extract_quotes(attached.filter("source_key = 'quotes_to_scrape'")).collect()
    assert (found.title, found.author, found.tags, found.url, found.extra) == ("“Hi”", "A", ["t", "u"], "https://h/q", {})


def test_layouts_agree_with_the_tag_tree(spark):
    """Pages put together from awkward pieces, against a plain reading of the tag tree."""
    pick = random.Random(5)
    inner = ["", "text", " a &lt; b ", "<b>bold</b>", "<br>", "<br/>", "<!-- <div class='quote'> -->", "x < y", "<div><div>deep</div>in</div>",
             "<script>'</div>'</script>", "<span>s</span>"]
    some = lambda: "".join(pick.choices(inner, k=3))

    def quote():
        tags = "".join(f"<a data-x='a > b' class='{pick.choice(['tag', 'tag on', 'tags', ''])}'>{some()}</a>" for _ in range(3))
        listed = pick.choice([f"<div class=tags>{some()}{tags}</div>", f"<DIV CLASS='x tags'>{tags}</DIV>", tags])
        return f"<div class='{pick.choice(['quote', 'quote x', 'quotes'])}'>{some()}<span class='text'>{some()}</span><small class=author>{some()}</small>{listed}</div>"

    def product():
        link = pick.choice(["<a href='/k?a=1&amp;b=2' title='A > B'>x</a>", "<i><a href='/no'>n</a></i><a href=/y.html>y</a>", "none"])
        return f"<article class='product_pod {pick.choice(['', 'x'])}'><p class='star-rating Two'></p><h3>{pick.choice(inner)}{link}</h3><p class=price_color>{some()}</p></article>{some()}"

    htmls = ["<body>" + some() + "".join(pick.choice([quote, product])() for _ in range(4)) for _ in range(60)] + ["", None, "<div class='quote'", "</div>"]
    pages = attach_sources(landed(spark, [("quotes_to_scrape", i, "https://h/q", html) for i, html in enumerate(htmls)]), source_frame(spark))

    def first(node, selector):
        found = next(select(node, selector), None)
        texts = [text for text in found.own_texts() if text] if found else []  # the tree marks a comment by an empty text
        return texts[0].strip() if texts else ""

    quotes, products = set(), set()
    for page, html in enumerate(htmls):
        for place, node in enumerate(select(parse_page(html), "div.quote")):
            tags = [text for tag in select(node, "div.tags a.tag") for text in tag.own_texts() if text]
            quotes.add((page, place, first(node, "span.text"), first(node, "small.author"), tuple(tags)))
        for place, node in enumerate(select(parse_page(html), "article.product_pod")):
            link = next(select(node, "h3 > a"), None)
            title = link.attrs.get("title", "") if link else ""
            products.add((page, place, title, first(node, "p.price_color")))
    assert {(r.page_no, r.item_pos, r.title, r.author, tuple(r.tags)) for r in extract_quotes(pages).collect()} == quotes
    found = extract_catalogue(pages)
    assert {(r.page_no, r.item_pos, r.title, r.extra["price"]) for r in found.collect()} == products
    assert not re.search("MapInPandas|MapInArrow|PythonUDF|EvalPython", found._jdf.queryExecution().executedPlan().toString())


def test_hostile_layout_pages(spark):
    htmls = ["<div class=quote>" * 3_000, "<div class=quote><span class=text>" + "<b>x" * 20_000, "<article class='product_pod'><h3><a " + "x='1' " * 20_000]
    pages = attach_sources(landed(spark, [("quotes_to_scrape", i, "https://h/q", html) for i, html in enumerate(htmls)]), source_frame(spark))
    assert extract_quotes(pages).count() == 3_001 and extract_catalogue(pages).count() == 1


def test_links(spark):
    html = """<!-- <a href="/no"> --><script>'<a href="/no">'</script><A class=x HREF='/a?x=1&amp;y=2'>1</A>
      <a title="a > b" href=b.html>2</a><a href="javascript:void(0)">3</a><a href="#">4</a><a name=x>5</a>
      <a data-x=" href='/no' " href=" https://e.com ">6</a><abbr href="/no"></abbr><a href="/a?x=1&amp;y=2">7</a>"""
    frame = spark.createDataFrame([(1, "https://site.com/d/p", html)], "page_id int, url string, html string")
    got = [r.link for r in extract_links(frame).orderBy("link_pos").collect()]
    assert got == ["https://site.com/a?x=1&y=2", "https://site.com/d/b.html", "https://e.com", "https://site.com/a?x=1&y=2"]
    bare = [r.link for r in extract_links(frame, base=None).orderBy("link_pos").collect()]
    assert bare == ["/a?x=1&y=2", "b.html", "https://e.com", "/a?x=1&y=2"]


def test_link_pattern_survives_long_input(spark):
    long = "<a " + " ".join(f"d{i}='{i}'" for i in range(1500)) + " href='/x'>" + "<b>" * 50_000
    frame = spark.createDataFrame([(1, "https://s.com", long)], "page_id int, url string, html string")
    assert [r.link for r in extract_links(frame).collect()] == ["https://s.com/x"]


def test_text_by_selector(evaluate):
    page = "<title>A &amp; B</title><h1 class=x> One <b> Two</b><!-- no -->Three</h1><ul><li>a<li class='k'>b</ul>"
    cases = {"title": "A & B", "h1": "OneTwoThree", "li.k": "b", "ul > li": "a", "h2": "", "p.none": ""}
    for selector, want in cases.items():
        assert evaluate(lambda c: extract_text(c, selector), [page, ""]) == [want, ""], selector  # noqa: B023


def test_selectors():
    root = parse_page(
        "<div id=m class='a b'><p>1<p>2<div><p>3</p></div></div><table><tr><td>x<td><a href='/u/stargazers'>y</a><tr><td>z</table>"
    )
    texts = lambda s: [n.text() for n in select(root, s)]
    assert texts("div p") == ["1", "2", "3"] and texts("div.a > p") == ["1", "2"]
    assert texts("td:nth-of-type(2) a") == ["y"] and texts("a[href$='/stargazers']") == ["y"]
    assert texts("#m.b p:nth-of-type(2)") == ["2"] and texts("tr") == ["xy", "z"] and texts("[href^='/u']") == ["y"]
    for bad in ("~ + tr .score", "a:hover", "", "> a", "a >", "a, b", "a + b"):
        with pytest.raises(ValueError):
            parse_selector(bad)


def test_unsupported_selector_is_refused_with_the_source():
    with pytest.raises(ValueError):
        Source("k", "n", "u", selectors={"items": "~ + tr"})


def documents(spark, texts):
    rows = [("S", "https://api/", text, datetime(2024, 1, 1), "b", 0, i) for i, text in enumerate(texts)]
    return spark.createDataFrame(
        rows,
        "source_name string, source_url string, document string, scraped_at timestamp, batch_id string, source_ord bigint, page_no bigint",
    )


def test_json_layouts(spark):
    item = {"title": "t"}
    texts = [
        json.dumps([{"name": {"common": "Atlantis"}, "region": "Sea", "population": 4100}, {"name": {"official": "Utopia"}}]),
        json.dumps({"works": [item, 5, {"x": 1}], "a": 1, "b": 2}),
        json.dumps({"docs": [item], "a": 1, "b": 2}),
        json.dumps({"count": 1, "rows": [item, item]}),
        json.dumps({"rows": [item], "count": 1}),
        json.dumps({"title": "single", "category": ["x"], "url": None}),
        json.dumps([[{"title": "inner"}], {"page": 1}]),
        json.dumps([item] * 150),
        json.dumps({"works": "text", "a": 1, "b": 2}),
        '"text"', "5", "{broken", None,
    ]
    rows = extract_documents(documents(spark, texts)).collect()
    by_page = {}
    for r in sorted(rows, key=lambda r: (r.page_no, r.item_pos)):
        by_page.setdefault(r.page_no, []).append(r)
    assert {k: len(v) for k, v in by_page.items()} == {0: 2, 1: 1, 2: 1, 3: 2, 5: 1, 7: 150, 11: 1}
    assert [(r.title, r.tags, r.score) for r in by_page[0]] == [("Atlantis", ["Sea"], "4100"), ("Utopia", [""], "")]
    (single,) = by_page[5]
    assert (single.url, single.tags, single.extra["category"]) == ("", ['["x"]'], None)
    assert by_page[1][0].url == "https://api/"


def test_json_that_cannot_be_read_is_kept_as_error(spark):
    big = '[{"title":"x"},' + ",".join(['{"title":"y"}'] * 500) + "]"
    texts = ['[{"title":"a","title":"b"},{"title":"c"}]', "{broken", "[1, 2", big, "", "nonsense"]
    rows = extract_documents(documents(spark, texts)).collect()
    titles = {}
    for r in sorted(rows, key=lambda r: (r.page_no, r.item_pos)):
        titles.setdefault(r.page_no, []).append(r.extra.get(UNREADABLE) or r.title)
    assert titles.pop(3) == ["x"] + ["y"] * 500
    broken = ["the document is no JSON"]
    assert titles == {0: ["b", "c"], 1: broken, 2: broken, 5: broken}
    assert extract_documents(documents(spark, [big]), max_items=100).count() == 100
    counts = stats.raw_counts(extract_documents(documents(spark, texts))).first()
    assert (counts.records_raw, counts.records_error) == (506, 3)


def test_hostile_pages_do_not_end_the_job(spark):
    pages = landed(spark, [("hacker_news", i, "https://h/", html) for i, html in enumerate(["<![foo[x]]>", "<![ ", LINK_TABLE])])
    rows = extract_items(attach_sources(pages, source_frame(spark))).collect()
    assert sorted(r.title for r in rows) == ["", "", "Rain in May", "Snowin June"]
    assert sum(UNREADABLE in r.extra for r in rows) == 2
    assert stats.raw_counts(extract_items(attach_sources(pages, source_frame(spark)))).first().records_error == 2
    assert [r.t for r in pages.select(extract_text(F.col("html"), "td > span").alias("t")).collect()] == ["", "", "Rain in May"]


def test_many_siblings():
    root = parse_page("<ul>" + "<li>x" * 20_000 + "</ul>")
    assert len(list(select(root, "li:nth-of-type(19999)"))) == 1


def test_custom_mapping(spark):
    texts = ['[{"indicator":{"value":"GDP"},"countryiso3code":"DEU","value":12}]']
    mapping = {"title": ("indicator.value", "id"), "url": ("url",), "description": ("countryiso3code",), "author": ("a",),
               "tags": ("unit",), "score": ("value",)}
    (row,) = extract_documents(documents(spark, texts), mapping).collect()
    assert (row.title, row.description, row.score) == ("GDP", "DEU", "12")


def test_source_selection(spark):
    frame = source_frame(spark)
    assert frame.count() == len(SOURCES) == 11
    assert runnable_sources(frame).count() == 10
    assert select_source(frame, "hacker_news").first().scraper_type == "bs4"
    assert select_source(frame, "toscrape_jobs").count() == select_source(frame, "no_such_key").count() == 0
    odd = [Source("a", "a", "u", None), Source("b", "b", "u", "ftp")]
    assert [r.key for r in runnable_sources(source_frame(spark, tuple(odd))).collect()] == ["a"]


def test_page_plan(spark):
    plan = page_plan(source_frame(spark)).filter(F.col("key").isin("books_to_scrape", "openlibrary"))
    got = [(r.page_no, r.page_url) for r in plan.orderBy("page_no").collect()]
    assert got[0] == (None, "https://openlibrary.org/subjects/science.json?limit=20")
    assert got[1:] == [(i, f"https://books.toscrape.com/catalogue/page-{i}.html") for i in range(1, 6)]


def test_producer_registry():
    registry.register_producer("same", lambda frame: frame)
    assert registry.get_producer("same")("x") == "x"
    with pytest.raises(ValueError):
        registry.get_producer("unknown")


def test_sources_from_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"key":"k","name":"N","url":"https://h/","selectors":{"items":"li","title":"a"}}\n{"key":"api","name":"A","url":"u","scraper_type":"api"}')
    rows = {r.key: r for r in registry.load_sources(spark, str(tmp_path)).collect()}
    assert (rows["k"].scraper_type, rows["k"].category, rows["k"].max_pages, rows["k"].source_ord) == ("bs4", "general", 1, 1)
    landed = spark.createDataFrame(
        [("k", None, "https://h/", "<ul><li><a>x</a></ul>"), ("api", None, "u", '[{"title":"y"}]'), ("other", None, "u", "<li>")],
        "source_key string, page_no int, url string, body string",
    ).withColumns({"scraped_at": F.current_timestamp(), "batch_id": F.lit(None).cast("string")})
    found = dispatch.raw_records(landed, registry.load_sources(spark, str(tmp_path)))
    assert sorted((r.source_name, r.title) for r in found.collect()) == [("A", "y"), ("N", "x")]
    assert len({r.batch_id for r in found.collect()}) == 1
    assert [r.title for r in dispatch.raw_records(landed, registry.load_sources(spark, str(tmp_path)), "api").collect()] == ["y"]
    (tmp_path / "b.json").write_text('{"key":"bad","name":"B","url":"u","selectors":{"items":"~ + tr"}}')
    with pytest.raises(ValueError):
        registry.load_sources(spark, str(tmp_path))


def test_spiders_run_by_name(spark):
    pages = landed(spark, [("toscrape_jobs", None, "https://h/q", "<div class=quote><span class=text>Hi</span></div>")])
    rows = dispatch.raw_records(pages.withColumnRenamed("html", "body"), source_frame(spark), crawled=True).collect()
    assert [(r.source_name, r.title) for r in rows] == [("Toscrape Jobs (Scrapy)", "Hi")]
