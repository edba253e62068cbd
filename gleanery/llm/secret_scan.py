"""Secrets in text: patterns propose candidates, a random forest removes the false ones.

Features of a candidate: length; character classes and the transitions between them; how likely its letter pairs are in the corpus' own
words; how much of it the corpus' dictionary covers; the path it was found under (the document's source: how many candidates a
document there holds, and whether the candidate is part of a path); the words before and after it, taken from the text itself.

Candidates are runs of at least 16 of A-Z a-z 0-9 + / _ -, and whatever is assigned to a secret's name by = or : (`ASSIGNED`): the
quoted value, or all up to the next blank, of at least 6 characters. An unquoted value is proposed up to its first bracket, comma or
the like as well, and an assignment within a value (`INNER`) on its own as well. Candidates may therefore overlap.

Dictionary and letter pairs are counted over all documents. The forest is trained on labelled findings: `findings` with doc_id,
begin, label, or, where none are given, candidates whose label follows from a rule (`ruled`): formats of providers and values
assigned to a secret's name are secrets, plain words, numbers, UUIDs and digests are not, all others stay unlabelled and are only scored.
At most `SAMPLE` findings of either label, chosen by a hash, go into the training.

Defined results: null and empty texts have no candidates; a span found in several ways is one candidate; a finding counts for every
candidate that begins there; positions are code points, end exclusive; repeated rows give
repeated findings; documents without source share one path. If the findings have one label only, the forest cannot be trained
and every candidate gets that label's share (0 or 1), or 0 without any. Everything runs on DataFrames and Spark's own forest.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.texts import stored
from gleanery.operators.lookup import lookup_join

CANDIDATE = r"(?<![\p{L}\p{N}+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}+(?![\p{L}\p{N}])"
PROVIDERS = r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[opsur]_[A-Za-z0-9]{30,}$|^sk_live_[A-Za-z0-9]{16,}$|^AIza[A-Za-z0-9_-]{35}$|^xox[abp]-[A-Za-z0-9-]{10,}$"
NAMED = r"(?i)(password|passwd|pwd|secret|token|api_?key|access_?key|auth|credential)[a-z_]{0,12}[\"']?\s{0,3}[=:]\s{0,3}[\"']?$"
NAMES = r"(?i)(password|passwd|pwd|secret|token|key|auth|bearer|credential|login)"
HARMLESS = r"(?i)(sha-?1|sha-?256|md5|commit|digest|checksum|uuid|guid|build|example|sample|test|dummy|version)"
UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
VALUE_CHARS = 6
#: A secret's name and the sign of assignment. All repetitions are bounded or possessive, so Java neither recurses nor backtracks far.
GIVEN = r"(?:password|passwd|pwd|secret|token|key|auth|bearer|credential|login)[A-Za-z0-9_.-]{0,64}+(?:\\?[\"'`]\]?)?\s{0,3}+[=:]{1,2}+>?+"


def value_after(start: str, step: str) -> str:
    """The value after a name is group 1 and ends the match; `start` and `step` are look-aheads at its begin and at each sign."""
    quoted = "|".join(f"(?<={q})(?:{step}[^{q}\\n]){{{VALUE_CHARS},}}+(?={q})" for q in "\"'`")
    escaped = rf"(?<=\\[\"'])(?:{step}[^\"'\\\n]){{{VALUE_CHARS},}}+(?=\\[\"'])"
    plain = rf"(?![\"'`]){step}\S(?:{step}\S){{{VALUE_CHARS - 1},}}+"
    return rf"(?i){GIVEN}\s{{0,3}}+(?:\\?[\"'`])?{start}({escaped}|{quoted}|{plain})"


ASSIGNED = value_after("", "")
INNER = value_after(f"(?!{GIVEN})", rf"(?![;&?,{{(|\s]\s?{GIVEN})")
#: The part of an unquoted value before what may belong to the text around it.
SHORTER = r"^[^\s\"'`&<>,;(){}\[\]|\\]*+"
CONTEXT_CHARS = 40
DICTIONARY_DOCS = 5
SAMPLE = 20_000
TREES, DEPTH, SEED = 20, 6, 5
THRESHOLD = 0.5

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
SPANS = "array<struct<begin:int,end:int,value:string>>"


def matches(text: Column, pattern: str, group: int) -> Column:
    """begin, end and value of a group that ends its match, for all matches. Positions come from the pieces between the matches."""
    pieces = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    steps = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(hits)).alias("before"), hits.alias("hit"), values.alias("value"))

    def walk(state: Column, step: Column) -> Column:
        end = state["at"] + F.length(step["before"]) + F.length(step["hit"])
        one = F.struct((end - F.length(step["value"])).alias("begin"), end.alias("end"), step["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(one).cast(SPANS)).alias("found"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("found"))
    return F.aggregate(steps, start, walk)["found"]


def shortened(text: Column, spans: Column) -> Column:
    """Unquoted values up to a sign that may belong to the text around them, without full stops and the like at the end."""

    def shorter(span: Column) -> Column:
        value = F.regexp_replace(F.regexp_extract(span["value"], SHORTER, 0), r"[.:!?]++$", "")
        return F.struct(span["begin"].alias("begin"), (span["begin"] + F.length(value)).alias("end"), value.alias("value"))

    bare = F.filter(spans, lambda span: ~F.substring(text, span["end"] + 1, F.lit(1)).rlike(r"[\"'`\\]"))
    return F.filter(F.transform(bare, shorter), lambda span: span["end"] - span["begin"] >= VALUE_CHARS)


def proposed(text: Column) -> Column:
    """All candidates of a text with their positions and the characters around them."""
    named = F.when(text.rlike(f"(?i){GIVEN}"), F.concat(matches(text, ASSIGNED, 1), matches(text, INNER, 1)))
    named = F.coalesce(named, F.array().cast(SPANS))
    spans = F.array_sort(F.array_distinct(F.concat(matches(text, CANDIDATE, 0), named, shortened(text, named))))

    def placed(span: Column) -> Column:
        first = F.greatest(span["begin"] - CONTEXT_CHARS, F.lit(0))
        before = F.substring(text, first + 1, span["begin"] - first)
        after = F.substring(text, span["end"] + 1, F.lit(CONTEXT_CHARS))
        return F.struct(span["begin"].alias("begin"), span["end"].alias("end"), span["value"].alias("value"), before.alias("before"), after.alias("after"))

    return F.transform(spans, placed)


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate: id, doc_id, path, begin, end, value, before, after."""
    some = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("path"), "text")
    rows = some.filter(F.col("text").rlike(CANDIDATE) | F.col("text").rlike(ASSIGNED)).select("doc_id", "path", F.explode(proposed(F.col("text"))).alias("c"))
    return rows.select(F.monotonically_increasing_id().alias("id"), "doc_id", "path", "c.*")


def dictionary(docs: DataFrame, least: int = DICTIONARY_DOCS) -> DataFrame:
    """word, docs: lower-case words of at least three letters that at least `least` documents hold."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,40}+"), F.lit(0)))
    counts = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("docs"))
    return counts.filter(F.col("docs") >= least)


def pairs_of(word: Column) -> Column:
    """Neighbouring letters; a word of one letter has none."""
    last = F.greatest(F.length(word) - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(word, i, F.lit(2)))


def letter_pairs(words: DataFrame) -> DataFrame:
    """pair, log_share: how common a pair of letters is among the dictionary's words."""
    counts = words.select(F.explode(pairs_of(F.col("word"))).alias("pair"), "docs").groupBy("pair").agg(F.sum("docs").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 1
    return counts.select("pair", F.log(F.col("n") / F.lit(float(total))).alias("log_share"))


def described(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The candidates with their features."""
    words = stored(dictionary(docs), "dictionary")
    parts = found.select("id", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,40}+"), F.lit(0))).alias("word"))
    covered = parts.join(words.select("word"), "word").groupBy("id").agg(F.sum(F.length("word")).alias("_covered"))
    letters = found.select("id", F.explode(pairs_of(F.lower("value"))).alias("pair"))
    likely = lookup_join(letters, letter_pairs(words), ["pair"], "left")
    likely = likely.groupBy("id").agg(F.avg(F.coalesce("log_share", F.lit(-16.0))).alias("pair_likelihood"))
    per_path = docs.groupBy(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("path")).agg(F.count(F.lit(1)).alias("_docs"))
    rates = found.groupBy("path").agg(F.count(F.lit(1)).alias("_hits")).join(per_path, "path")
    rows = lookup_join(found, rates.select("path", (F.col("_hits") / F.col("_docs")).alias("path_rate")), ["path"], "left")
    rows = rows.join(covered, "id", "left").join(likely, "id", "left")
    value, length = F.col("value"), F.length("value").cast("double")
    classes = F.translate(F.translate(F.translate(value, LOWER, "a" * 26), UPPER, "A" * 26), DIGITS, "0" * 10)
    share = lambda sign: F.length(F.regexp_replace(classes, f"[^{sign}]", "")) / length
    changes = F.length(F.regexp_replace(classes, r"(.)\1*+", "#")) - 1
    features = {
        "length": length,
        "lower_share": share("a"),
        "upper_share": share("A"),
        "digit_share": share("0"),
        "transitions": changes / length,
        "distinct_share": F.size(F.array_distinct(F.split(value, ""))) / length,
        "hexadecimal": value.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "coverage": F.coalesce(F.col("_covered"), F.lit(0)) / length,
        "pair_likelihood": F.coalesce("pair_likelihood", F.lit(-16.0)),
        "path_rate": F.coalesce("path_rate", F.lit(0.0)),
        "in_path": (F.col("before").rlike(r"[/.@]$") | F.col("after").rlike(r"^[/.@]") | value.contains("/")).cast("double"),
        "assigned": F.col("before").rlike(r"[=:]\s{0,3}[\"']?$").cast("double"),
        "named": F.col("before").rlike(NAMES).cast("double"),
        "harmless": (F.col("before").rlike(HARMLESS) | F.col("after").rlike(HARMLESS)).cast("double"),
        "quoted": (F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")).cast("double"),
    }
    return rows.select(*found.columns, *(feature.cast("double").alias(f"f_{name}") for name, feature in features.items()))


def ruled(rows: DataFrame) -> DataFrame:
    """Adds `label`: 1 or 0 where a rule tells, else null."""
    value, before = F.col("value"), F.col("before")
    secret = value.rlike(PROVIDERS) | (before.rlike(NAMED) & value.rlike("[0-9]") & value.rlike("[A-Za-z]"))
    plain = value.rlike("^([A-Z]?[a-z]+|[A-Z]+|[0-9]+)$") | value.rlike(UUID) | value.rlike("^[=_+/-]+$") | before.rlike(r"(?i)(sha-?1|sha-?256|md5|commit)\W{0,3}$")
    return rows.withColumn("label", F.when(plain, 0).when(secret, 1))


def with_findings(rows: DataFrame, findings: DataFrame) -> DataFrame:
    """Adds `label` from findings (doc_id, begin, label)."""
    marks = findings.groupBy("doc_id", "begin").agg(F.max("label").cast("int").alias("label"))
    return rows.join(marks, ["doc_id", "begin"], "left")


def scored(labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Adds `probability`, by a forest trained on a bounded sample of the labelled rows."""
    names = [c for c in labelled.columns if c.startswith("f_")]
    table = VectorAssembler(inputCols=names, outputCol="_features").transform(labelled)
    order = F.xxhash64("doc_id", "begin", "value"), "doc_id", "begin"
    some = [table.filter(F.col("label") == label).orderBy(*order).limit(sample) for label in (0, 1)]
    # one partition of at most 2 * sample short rows: the forest's draws then do not depend on how the candidates lie
    rows = some[0].unionByName(some[1]).select("_features", F.col("label").cast("double").alias("label"), "doc_id", "begin")
    rows = stored(rows.repartition(1).sortWithinPartitions("doc_id", "begin", "label"), "training")
    counts = {row.label: row["count"] for row in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return labelled.withColumn("probability", F.lit(float(max(counts, default=0.0))))
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, probabilityCol="_p", rawPredictionCol="_r"
    )
    model = forest.fit(rows.coalesce(1))
    return model.transform(table).withColumn("probability", F.get(vector_to_array("_p"), F.lit(1))).select(*labelled.columns, "probability")


def scan(docs: DataFrame, findings: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """All candidates with features, label, probability and `secret`."""
    found = stored(candidates(docs), "candidates")
    rows = stored(described(found, docs), "features")
    labelled = ruled(rows) if findings is None else with_findings(rows, findings)
    return scored(labelled).withColumn("secret", F.col("probability") >= threshold)


def digest(docs: DataFrame) -> DataFrame:
    """Per candidate: its document, place, a hash in place of its value, and the forest's verdict."""
    return scan(docs).select(
        "doc_id", "begin", "end", F.sha2("value", 256).alias("value_sha256"), F.round("probability", 6).alias("probability"), "secret"
    )
