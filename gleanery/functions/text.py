"""Text normalisation as Column expressions (all JVM-side, no Python worker)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python's str methods see it; Java's \s is ASCII only and trim() strips blanks only.
# The Unicode flag costs one property test per letter; a class listing the blanks is five times slower.
UNUSUAL_BLANKS = r"(?U)[\s\x1c-\x1f&&[^ ]]+"
BLANKS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B))
)

TAG = "<[^>]+>"

# Character references decoded in text, in this order, then the zero-width space dropped.
REFERENCES = (
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#x27;", "'"),
    ("\u200b", ""),
)
# Fixed value: titles that carry no information (placeholder words, runs of dashes or dots, nothing).
JUNK_TITLE = r"(?i)^(?:n/a|na|none|null|undefined|untitled|[–—-]+|[.]+|)\z"


def strip(text: Column) -> Column:
    """Remove white space at both ends."""
    return F.btrim(text, F.lit(BLANKS))


def _open_up(text: Column) -> Column:
    """Blanks in place of tags and of every other white space.

    The lone blanks of running text are no match, so few pieces of it are rebuilt.
    """
    return F.regexp_replace(F.regexp_replace(text, TAG, " "), UNUSUAL_BLANKS, " ")


def _even_out(text: Column) -> Column:
    """One blank where several meet, none at the ends."""
    return F.trim(F.regexp_replace(text, "  +", " "))


def strip_tags(text: Column) -> Column:
    """Drop markup, keep the text between tags with single blanks."""
    return _even_out(_open_up(text))


def clean_text(text: Column) -> Column:
    """Plain text of a scraped field; NULL becomes the empty string.

    References are decoded after the tags are gone, so decoded angle brackets stay.
    """
    out = _open_up(F.coalesce(text, F.lit("")))
    for reference, char in REFERENCES:
        out = F.replace(out, F.lit(reference), F.lit(char))
    return _even_out(out)


def clean_field(name: str) -> Column:
    """``clean_text`` of a column that may hold long texts: markup and references are looked for only where the sign that they begin
    with stands in it. The signs are sought in the column itself, so that no step is computed twice."""
    text = F.coalesce(F.col(name), F.lit(""))
    has = lambda sign: F.contains(text, F.lit(sign))
    plain = F.when(has("<"), F.regexp_replace(text, TAG, " ")).otherwise(text)
    blank = F.regexp_replace(plain, UNUSUAL_BLANKS, " ")
    out = blank
    for reference, char in REFERENCES:
        out = F.replace(out, F.lit(reference), F.lit(char))
    return _even_out(F.when(has("&") | has("\u200b"), out).otherwise(blank))


def truncate(text: Column, length: int) -> Column:
    """First ``length`` code points."""
    return F.left(text, F.lit(length))


def is_junk_title(title: Column) -> Column:
    """True for a cleaned title that is empty, a placeholder word, or a run of dashes or dots."""
    return title.rlike(JUNK_TITLE)
