"""URL handling as Column expressions.

Splitting follows RFC 3986 the way Python's ``urllib.parse`` applies it. Spark's ``parse_url`` is
not used: it rejects URLs (for example with blanks) that have to be accepted here.
"""

from __future__ import annotations

import unicodedata
from functools import cache
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:"
# Schemes whose last path segment may carry ";parameters", and schemes with relative references.
_PARAMETER_SCHEMES = ("", "http", "https", "ftp", "sftp", "shttp", "rtsp", "rtsps", "rtspu", "sip",
                      "sips", "mms", "tel", "hdl", "prospero")
_RELATIVE_SCHEMES = ("", "http", "https", "ftp", "sftp", "shttp", "file", "gopher", "nntp", "imap",
                     "wais", "rtsp", "rtsps", "rtspu", "svn", "svn+ssh", "mms", "prospero", "ws",
                     "wss")


class Parts(NamedTuple):
    """The pieces of one URL; every piece is '' where it is absent."""

    scheme: Column
    netloc: Column
    path: Column
    params: Column
    query: Column
    fragment: Column


@cache
def _hostile_letters() -> str:
    """Letters whose compatibility form contains a URL delimiter (such hosts are refused)."""
    found = [
        chr(point)
        for point in range(0x80, 0x10000)
        if set(unicodedata.normalize("NFKC", chr(point))) & set("/?#@:")
    ]
    # Only letters beyond ASCII are tested one by one.
    return r"(?=[^\x00-\x7f])[" + "".join(f"\\x{{{ord(char):x}}}" for char in found) + "]"


def _tidy(url: Column) -> Column:
    """Drop control characters and blanks in front, and tabs and line breaks anywhere."""
    return F.translate(F.regexp_replace(url, r"^[\x00-\x20]+", ""), "\t\r\n", "")


# scheme, host, path without the parameters of its last segment, parameters, query, fragment
_URL = (
    r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?((?:[^?#]*/)?[^;/?#]*)(;[^/?#]*)?"
    r"(?:\?([^#]*))?(?:#(.*))?\z"
)
_MARK = "\uffff"  # a noncharacter, so it cannot be part of a URL


def url_groups(url: Column) -> Column:
    """The pieces of a URL as an array, found in one pass of one pattern.

    Everything else here works on this array, so callers compute it once, in a projection of its own.
    """
    return F.split(F.regexp_replace(_tidy(url), _URL, _MARK.join(f"${i}" for i in range(1, 7))), _MARK, -1)


def absolute_groups(url: Column) -> Column:
    """``url_groups`` with https assumed where the scheme is missing."""
    return url_groups(F.when(_tidy(url).rlike(SCHEME), url).otherwise(F.concat(F.lit("https://"), url)))


def _parts(groups: Column) -> Parts:
    scheme, netloc, path, tail, query, fragment = (F.get(groups, F.lit(i)) for i in range(6))
    scheme = F.lower(scheme)
    takes_params = scheme.isin(*_PARAMETER_SCHEMES)
    return Parts(
        scheme,
        netloc,
        F.when(takes_params, path).otherwise(F.concat(path, tail)),
        F.when(takes_params, F.substr(tail, F.lit(2))).otherwise(""),
        query,
        fragment,
    )


def _unsplit(parts: Parts) -> Column:
    """Put the parts together again; empty parameters, query and fragment leave no delimiter."""
    slash = F.when(parts.path.rlike("^[^/]"), F.lit("/")).otherwise("")
    return F.concat(
        F.when(parts.scheme != "", F.concat(parts.scheme, F.lit(":"))).otherwise(""),
        F.when(parts.netloc != "", F.concat(F.lit("//"), parts.netloc, slash)).otherwise(""),
        parts.path,
        F.when(parts.params != "", F.concat(F.lit(";"), parts.params)).otherwise(""),
        F.when(parts.query != "", F.concat(F.lit("?"), parts.query)).otherwise(""),
        F.when(parts.fragment != "", F.concat(F.lit("#"), parts.fragment)).otherwise(""),
    )


def is_bad_netloc(netloc: Column) -> Column:
    """Hosts that do not parse: unbalanced or non-IP brackets, or look-alike delimiters."""
    bracketed = netloc.rlike(r"[\[\]]")
    ip_literal = netloc.rlike(
        r"^(?:[^@\[\]]*@)?\[(?:[0-9A-Fa-f]*:[0-9A-Fa-f:.]*(?:%[^\]\[]+)?|v[0-9A-Fa-f]+\.[^\]\[]+)\](?::[^\[\]]*)?$"
    )
    return (bracketed & ~ip_literal) | netloc.rlike(_hostile_letters())


def canonical_url(url: Column, groups: Column) -> Column:
    """``normalise_url`` of ``url``, from its ``absolute_groups``."""
    scheme, netloc, path, tail, query = (F.get(groups, F.lit(i)) for i in range(5))

    def rooted(text: Column) -> Column:
        return F.concat(F.lit("/"), F.substr(F.rtrim(text, F.lit("/")), F.lit(2)))

    with_tail = F.when(
        F.lower(scheme).isin(*_PARAMETER_SCHEMES), F.concat(rooted(path), F.when(tail != ";", tail).otherwise(""))
    ).otherwise(rooted(F.concat(path, tail)))
    query = F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")
    usable = url.isNotNull() & (url != "") & (netloc != "") & ~is_bad_netloc(netloc)
    return F.when(usable, F.concat(F.lower(scheme), F.lit("://"), netloc, with_tail, query)).otherwise("")


def normalise_url(url: Column) -> Column:
    """Canonical absolute URL, '' for NULL, empty or unusable input.

    A missing scheme becomes https, trailing slashes and the fragment go, the scheme is lower-cased;
    host case, parameters and query stay.
    """
    return canonical_url(url, absolute_groups(url))


def with_normalised_url(frame: DataFrame, url: Column, into: str) -> DataFrame:
    """Add the canonical URL, splitting each URL once."""
    staged = frame.withColumn("_url", url).withColumn("_groups", absolute_groups(F.col("_url")))
    return staged.withColumn(into, canonical_url(F.col("_url"), F.col("_groups"))).drop("_url", "_groups")


def extract_domain(url: Column) -> Column:
    """Host part without any leading 'w' and '.' characters; '' if there is none."""
    netloc = F.get(url_groups(url), F.lit(1))
    return F.when(url.isNull() | is_bad_netloc(netloc), "").otherwise(F.ltrim(netloc, F.lit("w.")))


def _resolve_dots(path: Column) -> Column:
    """Apply the '.' and '..' segments of a path."""
    segments = F.split(path, "/", -1)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, segment: F.when(segment == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(segment == ".", done)
        .otherwise(F.concat(done, F.array(segment))),
    )
    ends_open = F.when(path.rlike(r"(?:^|/)\.{1,2}\z"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(kept, ends_open), "/")


def with_joined_url(frame: DataFrame, base: Column, reference: Column, into: str) -> DataFrame:
    """Add ``reference`` resolved against the page ``base`` it was found on (RFC 3986, section 5).

    One projection per step, so that every piece is computed once.
    """
    split = frame.withColumns({"_base": base, "_ref": reference}).withColumns(
        {"_b": url_groups(F.col("_base")), "_r": url_groups(F.col("_ref"))}
    )
    b, r = _parts(F.col("_b")), _parts(F.col("_r"))
    directory = F.when(b.path == "", "/").otherwise(F.regexp_replace(b.path, r"[^/]*\z", ""))
    merged = F.regexp_replace(F.concat(directory, r.path), "/+", "/")
    path = F.when(F.startswith(r.path, F.lit("/")), r.path).otherwise(merged)
    scheme = F.when(r.scheme == "", b.scheme).otherwise(r.scheme)
    merging = split.withColumns({"_path": path, "_scheme": scheme})
    dotted = F.col("_path").rlike(r"(?:^|/)\.{1,2}(?:/|\z)")
    resolved = merging.withColumn("_path", F.when(dotted, _resolve_dots(F.col("_path"))).otherwise(F.col("_path")))

    own_host = r.netloc != ""
    same_page = (r.path == "") & (r.params == "") & ~own_host
    chosen = resolved.withColumns(
        {
            "_netloc": F.when(own_host, r.netloc).otherwise(b.netloc),
            "_path": F.when(own_host, r.path).when(same_page, b.path).when(F.col("_path") == "", "/").otherwise(F.col("_path")),
            "_params": F.when(same_page, b.params).otherwise(r.params),
            "_query": F.when(same_page & (r.query == ""), b.query).otherwise(r.query),
            # A reference with a scheme of its own needs no base.
            "_alone": (F.col("_base") == "") | F.col("_base").isNull()
            | ((F.col("_scheme") != b.scheme) | ~F.col("_scheme").isin(*_RELATIVE_SCHEMES)) & (F.col("_ref") != ""),
        }
    )
    parts = Parts(*[F.col(name) for name in ("_scheme", "_netloc", "_path", "_params", "_query")], r.fragment)
    result = F.when(F.col("_alone"), F.col("_ref")).when(F.col("_ref") == "", F.col("_base")).otherwise(_unsplit(parts))
    helpers = ("_base", "_ref", "_b", "_r", "_path", "_scheme", "_netloc", "_params", "_query", "_alone")
    return chosen.withColumn(into, result).drop(*helpers)


def with_item_url(frame: DataFrame, page_url: Column, href: Column, into: str) -> DataFrame:
    """Add the URL of an extracted item: its link resolved against the page, or the page itself."""
    return with_joined_url(frame, page_url, F.coalesce(href, F.lit("")), into)
