"""Scalar functions: fixed examples, then random inputs against small independent Python models."""

import re
from datetime import datetime, timezone
from urllib.parse import urljoin, urlparse, urlunparse

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanery.functions import dates, entities, numeric, tags, text, url
from gleanery.operators import clean
from gleanery.schemas import RAW

RANDOM = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def batches(alphabet, max_size=24):
    return st.lists(st.text(alphabet=alphabet, max_size=max_size), min_size=40, max_size=60)


def test_strip_tags(evaluate):
    got = evaluate(text.strip_tags, ["<b>Hello</b> <i>World</i>", "No tags here", "", "a<br\n/>b"])
    assert got == ["Hello World", "No tags here", "", "a b"]


def test_clean_text(evaluate):
    cases = {
        "<p>Hello &amp; World</p>": "Hello & World",
        "": "",
        None: "",
        "&amp;lt;": "<",
        "&lt;b&gt;": "<b>",
        "a​b\xa0c": "ab c",
        " \x1c x 　 y ": "x y",
        "&quot;it&#x27;s&quot;": "\"it's\"",
    }
    assert evaluate(text.clean_text, list(cases)) == list(cases.values())


def test_clean_field_is_clean_text(spark):
    """Also where markup, references, the zero-width space or other blanks stand alone or arise from each other."""
    rows = ["<p>Hello &amp; World</p>", "", None, "&amp;lt;", "a<b", "a > b", "&", "a\u200bb", "<i>&quot;</i>\u200b", "a\xa0\n b", "  x  ",
            "&lt;b&gt;", "a<br>&amp;\t<br>b", "&<x>amp;", "plain words, one blank each"]
    frame = spark.createDataFrame([(row,) for row in rows], "description string")
    both = frame.select(text.clean_text(F.col("description")).alias("a"), text.clean_field("description").alias("b")).collect()
    assert [row.b for row in both] == [row.a for row in both]


def test_cleaning_looks_for_markup_only_where_it_can_stand(spark):
    """Replacing tags and references in a long plain text is skipped: its plan asks for their signs first."""
    raw = spark.createDataFrame([], RAW)
    plan = clean.clean_records(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert all("Contains(coalesce(description" in plan and sign in plan for sign in (", <)", ", &)"))


def model_clean_text(value):
    value = re.sub("<[^>]+>", " ", value)
    for old, new in [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("​", "")]:
        value = value.replace(old, new)
    return " ".join(value.split())


@RANDOM
@given(batches("ab<>/& ;\t\n\xa0\x1c ​lgtamp#27x\"'"))
def test_clean_text_random(evaluate, values):
    assert evaluate(text.clean_text, values) == [model_clean_text(v) for v in values]


def test_junk_titles(evaluate):
    junk = ["", "N/A", "n/a", "NA", "none", "NULL", "undefined", "Untitled", "—", "-", "–—-", "...", "."]
    fine = ["nan", "n.a.", "a-", "null and void", "-.", "no"]
    assert evaluate(text.is_junk_title, junk + fine) == [True] * len(junk) + [False] * len(fine)


def test_truncate_counts_code_points(evaluate):
    assert evaluate(lambda c: text.truncate(c, 3), ["ab", "abcd", "😀😀😀😀"]) == ["ab", "abc", "😀😀😀"]


def test_normalise_url(evaluate):
    cases = {
        "example.com/page": "https://example.com/page",
        "https://example.com/page/": "https://example.com/page",
        "": "",
        None: "",
        "HTTP://Example.COM": "http://Example.COM/",
        "https://e.com/a?b=1#c": "https://e.com/a?b=1",
        "https://e.com/a/;p=1?q": "https://e.com/a;p=1?q",
        "mailto:me@e.com": "",
        "//e.com/x": "",
        "https://[bad": "",
        "https://[::1]:80/x/": "https://[::1]:80/x",
        "a b.com/c d": "https://a b.com/c d",
        "https://e／vil.com/": "",
    }
    assert evaluate(url.normalise_url, list(cases)) == list(cases.values())


def model_normalise_url(value):
    if not value:
        return ""
    try:
        parsed = urlparse(value)
        parsed = parsed if parsed.scheme else urlparse("https://" + value)
    except ValueError:
        return ""
    if not parsed.netloc:
        return ""
    return urlunparse(parsed._replace(path=parsed.path.rstrip("/") or "/", fragment=""))


@RANDOM
@given(batches("htps:/.?#;ab=&%A -\t"))
def test_normalise_url_random(evaluate, values):
    values += ["https://" + v for v in values] + ["http://h/" + v for v in values]
    assert evaluate(url.normalise_url, values) == [model_normalise_url(v) for v in values]


def test_extract_domain(evaluate):
    cases = {
        "https://www.github.com/trending": "github.com",
        "https://arxiv.org/abs/123": "arxiv.org",
        "": "",
        "https://wikipedia.org": "ikipedia.org",
        "github.com/x": "",
        "https://[bad/": "",
    }
    assert evaluate(url.extract_domain, list(cases)) == list(cases.values())


def joined(spark, pairs):
    frame = spark.createDataFrame([(i, *pair) for i, pair in enumerate(pairs)], "i int, b string, r string")
    out = url.with_joined_url(frame, frame.b, frame.r, "joined").orderBy("i").collect()
    return [row.joined for row in out]


BASES = ["https://site.com/a/b/c.html?q=1#f", "http://h", "https://h/d/", "https://h/a;p/b;q", "", "mailto:x", "https://h/x/../y/z"]


def test_join_url_examples(spark):
    refs = ["/page1", "https://example.com", "x", "../x", "./", "..", "?z=1", "#top", "//other/x", "", "g;x=1/../y",
            "/a/./b/../c", "../../../../g", "g/", ";p", "mailto:me", "a//b", "/.", "http:x", "javascript:void(0)"]
    pairs = [(b, r) for b in BASES for r in refs]
    got = joined(spark, pairs)
    want = [urljoin(b, r) for b, r in pairs]
    assert [p for p in zip(pairs, got, want) if p[1] != p[2]] == []


@RANDOM
@given(batches("./.ab;?#=:/h", 14))
def test_join_url_random(spark, refs):
    pairs = [(b, r) for b in BASES[:4] for r in refs]
    want = [urljoin(b, r) for b, r in pairs]
    got = joined(spark, pairs)
    assert [p for p in zip(pairs, got, want) if p[1] != p[2]] == []


def test_item_url(spark):
    frame = spark.createDataFrame([("https://h/p/1", ""), ("https://h/p/1", "/x"), ("https://h/p/1", None)], "p string, h string")
    rows = url.with_item_url(frame, frame.p, frame.h, "u").collect()
    assert [row.u for row in rows] == ["https://h/p/1", "https://h/x", "https://h/p/1"]


def test_parse_score(evaluate):
    cases = {
        "42": 42.0, "1,234 points": 1234.0, "3.5k": 3500.0, "": None, None: None, "2.5M views": 2500000.0,
        "5 comments": 5000000.0, "42 likes": 42000.0, "-5": 5.0, "none": None, "1.2.3": None, ".": None, "1.": 1.0,
    }
    assert evaluate(numeric.parse_score, list(cases)) == list(cases.values())
    assert evaluate(numeric.has_bad_number, list(cases)) == [c in ("1.2.3", ".") for c in cases]


def model_parse_score(raw):
    raw = raw.lower().replace(",", "").strip()
    found = re.search(r"[0-9.]+", raw)
    if not found:
        return None
    try:
        value = float(found.group())
    except ValueError:
        return None
    return value * (1000 if "k" in raw else 1_000_000 if "m" in raw else 1)


@RANDOM
@given(batches("0123456789., kKmMpts-", 10))
def test_parse_score_random(evaluate, values):
    for got, value in zip(evaluate(numeric.parse_score, values), values):
        want = model_parse_score(value)
        assert (got is None) == (want is None)
        assert want is None or abs(got - want) <= 0.0050001 + abs(want) * 1e-12


def test_parse_price(evaluate):
    cases = {"£12.99": 12.99, "1,012.50 EUR": 1012.5, "": None, None: None, "free": None}
    assert evaluate(numeric.parse_price, list(cases)) == list(cases.values())


def test_coerce_number(evaluate):
    cases = {"7.5": 7.5, "-1": None, None: None, "abc": None, "1_000": 1000.0, "5d": None, "nan": None, "inf": None,
             " 3 ": 3.0, "1e3": 1000.0, "1__0": None, "_1": None, "1_": None, "1_.5": None, "9" * 20_000: None, ".5": 0.5, "5.": 5.0, "+2": 2.0}
    assert evaluate(numeric.coerce_number, list(cases)) == list(cases.values())


def test_rating_value(evaluate):
    cases = {"star-rating Three": 3, "star-rating One": 1, "star-rating": 0, "star-rating Ten": 0, None: 0}
    assert evaluate(numeric.rating_value, list(cases)) == list(cases.values())


def test_parse_tags(evaluate):
    got = evaluate(tags.parse_tags, [["Python", "python", "  Machine Learning  ", "AI"], [], [None, " "], None], "array<string>")
    assert got == [["python", "machine-learning", "ai"], [], [], []]


@RANDOM
@given(st.lists(st.lists(st.text(alphabet="aAbB \t\xa0", max_size=5), max_size=8), min_size=20, max_size=30))
def test_parse_tags_random(evaluate, lists):
    def model(values):
        return [s for s in dict.fromkeys(v.strip().lower().replace(" ", "-") for v in values) if s]

    assert evaluate(tags.parse_tags, lists, "array<string>") == [model(v) for v in lists]


def test_coerce_tags(evaluate):
    many = [f"tag{i}" for i in range(50)]
    got = evaluate(tags.coerce_tags, [many, ["x" * 120, "", None], None], "array<string>")
    assert got == [many[:20], ["x" * 100], []]


def test_datetimes(spark):
    cases = {
        "2024-06-15T10:30:00": (2024, 6, 15, 10, 30, 0),
        "June 15, 2024": (2024, 6, 15, 0, 0, 0),
        "Posted on 3 Mar 2021 at 5:07 PM": (2021, 3, 3, 17, 7, 0),
        "2024-06-15T10:30:00+02:00": (2024, 6, 15, 8, 30, 0),
        "2024-06-15 10:30:00Z": (2024, 6, 15, 10, 30, 0),
        "06/15/2024": (2024, 6, 15, 0, 0, 0),
        "15/06/2024": (2024, 6, 15, 0, 0, 0),
        "SEPT 1st, 2020": (2020, 9, 1, 0, 0, 0),
        "not a date": None,
        "": None,
        None: None,
        "2024-13-45": None,
    }
    frame = spark.createDataFrame(list(enumerate(cases)), "i int, raw string")
    rows = dates.with_datetime(frame, frame.raw, "at").orderBy("i").select(F.col("at").cast("double").alias("at")).collect()
    want = [None if v is None else datetime(*v, tzinfo=timezone.utc).timestamp() for v in cases.values()]
    assert [row.at for row in rows] == want


def test_decode_references(evaluate):
    cases = {
        "a &amp; b": "a & b", "&eacute;t&#233; &#xe9;": "été é", "&amp;lt; &lt;": "&lt; <", "plain": "plain",
        "&unknown; &": "&unknown; &", "&#x1F600;": "😀", "": "",
    }
    assert evaluate(entities.decode_references, list(cases)) == list(cases.values())


REFERENCES = [
    "a &#150; b &copy 1 &#00000065; &copy; &notit; &notin; &eacute;&Eacute &amp;lt; &ampx &#x41 &#X1F600; &#0; &#xD800; &#1114112;",
    "&#129; &#159; &#128; &#11; &#9; &#13; &#64976; &#xFFFE; &#99999999999999; &unknown; & &; &# &#x; && &a",
    "plain", "", "100% &quot;x&quot; &lt;b&gt; &nbsp;",
]


def test_references_are_decoded_like_a_parser(evaluate):
    import html

    from gleanery.functions.entities import decode_references

    assert evaluate(decode_references, REFERENCES) == [html.unescape(text) for text in REFERENCES]
