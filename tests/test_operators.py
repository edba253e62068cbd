"""Cleaning, validation, merges, statistics, ranking; brute force where a query has a second way."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gleanery.operators import clean, enrich, lookup, merge, ranking, stats, validate
from gleanery.plans import reports
from gleanery.plans.batch import check_batch
from gleanery.schemas import CLEAN_COLUMNS, RAW

NOW = datetime(2024, 6, 1)


def raw(spark, rows):
    base = {"source_name": "Test", "url": "", "title": "T", "description": "", "author": "", "tags": [], "score": "",
            "extra": {}, "scraped_at": NOW, "batch_id": "b", "source_ord": 0, "page_no": 0}
    full = [tuple((base | row | {"item_pos": i})[f.name] for f in RAW) for i, row in enumerate(rows)]
    return spark.createDataFrame(full, RAW)


def test_clean_record(spark):
    row = {"source_name": "Gazette", "url": "https://gazette.example/p/7", "title": "<i>Rain</i> in <b>May</b>",
           "author": " \t R. Roe ", "tags": ["Weather", "weather", "UK"], "score": "3,077 views"}
    (out,) = clean.load_projection(clean.clean_records(raw(spark, [row]))).collect()
    assert out.__fields__ == CLEAN_COLUMNS and len(CLEAN_COLUMNS) == 13
    assert (out.title, out.author, out.score, out.tags) == ("Rain in May", "R. Roe", 3077.0, ["weather", "uk"])


def test_junk_and_errors_are_dropped(spark):
    rows = [{"title": t} for t in ("", "N/A", "n/a", "null", "—", "-", "...", None)] + [{"score": "1.2.3"}, {"extra": {"price": "."}}]
    assert clean.clean_records(raw(spark, rows)).count() == 0


def test_first_of_a_run_wins(spark):
    rows = [{"url": f"https://e.com/{n}", "title": t} for n, t in ((1, "A"), (1, "B"), (2, "C"))]
    kept = clean.drop_duplicates_in_run(clean.clean_records(raw(spark, rows))).collect()
    assert sorted(r.title for r in kept) == ["A", "C"]


def test_fingerprint_falls_back_to_the_title(spark):
    frame = spark.createDataFrame([("e.com/p", "x"), ("https://e.com/p/#top", "y"), ("", "<b>x</b>"), (None, "x")], "u string, t string")
    prints = [r[0] for r in frame.select(clean.fingerprint(frame.u, frame.t)).collect()]
    assert prints[0] == prints[1] and prints[2] == prints[3] != prints[0]


def clean_row(spark, **changes):
    row = {"source_name": "Gazette", "title": "Rain", "url": "https://gazette.example/p/7",
           "description": "d", "author": "R. Roe", "category": "weather", "tags": ["uk"], "score": "3.25",
           "price": None, "published_at": None, "ingested_at": NOW, "batch_id": "run-7", "fingerprint": "0" * 40}
    types = {"tags": "array<string>", "published_at": "timestamp", "ingested_at": "timestamp", "price": "double"}
    schema = ", ".join(f"{name} {types.get(name, 'string')}" for name in row)
    return spark.createDataFrame([tuple((row | changes).values())], schema)


@pytest.mark.parametrize(
    "changes, errors",
    [
        ({}, []),
        ({"title": ""}, ["title: shorter than 1"]),
        ({"title": " \xa0"}, ["title: shorter than 1"]),
        ({"title": None}, ["title: not a string"]),
        ({"source_name": "x" * 101, "url": "u" * 2001}, ["source_name: longer than 100", "url: longer than 2000"]),
        ({"description": "d" * 2001, "author": "a" * 256}, ["description: longer than 2000", "author: longer than 255"]),
        ({"category": "c" * 101, "batch_id": "", "fingerprint": ""},
         ["category: longer than 100", "batch_id: shorter than 1", "fingerprint: shorter than 1"]),
        ({"url": None, "tags": None}, []),
        ({"score": "100000000"}, ["score: does not fit decimal(12,4)"]),
    ],
)
def test_validation_rules(spark, changes, errors):
    (row,) = validate.validate_records(clean_row(spark, **changes)).collect()
    assert row.errors == errors


def test_validation_coerces(spark):
    (row,) = validate.validate_records(clean_row(spark, score="-1", tags=[f"t{i}" for i in range(50)], title=" x ")).collect()
    assert (row.score, len(row.tags), row.title, row.errors) == (None, 20, "x", [])
    (row,) = validate.validate_records(clean_row(spark, score="7.5", url=None)).collect()
    assert (row.score, row.url) == (7.5, "")


RECORDS = "source_name string, category string, score double, ingested_at timestamp, fingerprint string, url string, batch_id string"


def records(spark, count=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        source = rng.choice("aaab") if i else "only"
        score = rng.choice([None, *range(8)])
        rows.append((source, rng.choice(["x", "x", "y", "", None]), None if score is None else float(score), datetime(2024, 1, rng.randint(1, 9)),
                     f"f{i:04d}", f"u{rng.randint(1, 50)}", "b"))
    return rows, spark.createDataFrame(rows, RECORDS)


def test_normalise_scores_by_brute_force(spark):
    rows, frame = records(spark)
    got = {r.fingerprint: r.score for r in enrich.normalise_scores(frame).collect()}
    assert len(got) == len(rows)
    for row in rows:
        scores = [r[2] for r in rows if r[0] == row[0] and r[2] is not None]
        low, high = min(scores, default=0), max(scores, default=0)
        want = row[2] if row[2] is None or high == low else round((row[2] - low) / (high - low), 4)
        assert (got[row[4]] is None) == (want is None) and (want is None or abs(float(got[row[4]]) - want) < 1e-4)


def brute_ranks(rows):
    ranks = {}
    for category in {r[1] for r in rows} - {None, ""}:
        chosen = [r for r in rows if r[1] == category]
        chosen.sort(key=lambda r: (-(r[2] if r[2] is not None else -1), -r[3].timestamp(), r[4]))
        ranks |= {r[4]: n for n, r in enumerate(chosen, 1)}
    return ranks


def test_ranks_by_brute_force(spark):
    rows, frame = records(spark)
    want = brute_ranks(rows)
    got = {r.fingerprint: r.rank_in_category for r in ranking.rank_in_category(frame, partitions=7).collect()}
    assert got == want
    top = {r.fingerprint: r.rank_in_category for r in ranking.top_per_category(frame, 10).collect()}
    assert top == {k: v for k, v in want.items() if v <= 10}


@pytest.mark.parametrize("max_bytes", [lookup.MAX_BROADCAST_BYTES, 0])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_small_and_large(spark, max_bytes, how):
    rows, frame = records(spark)
    names = spark.createDataFrame([("a", 1), ("z", 2)], "source_name string, n int")
    out = lookup.lookup_join(frame, names, ["source_name"], how, max_bytes).collect()
    want = sorted((r[4], 1 if r[0] == "a" else None) for r in rows if how == "left" or r[0] == "a")
    assert sorted((r.fingerprint, r.n) for r in out) == want
    plan = lookup.lookup_join(frame, names, ["source_name"], how, max_bytes)._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (max_bytes > 0)


def test_backfill(spark):
    frame = spark.createDataFrame([("s", None, 1), ("s", "", 2), ("s", "c", 3), ("t", None, 4), ("t", "", 5)], "source_name string, category string, i int")
    known = spark.createDataFrame([("s", "known")], "source_name string, category string")
    got = {r.i: r.category for r in enrich.backfill_category(frame, known).collect()}
    assert got == {1: "known", 2: "known", 3: "c", 4: None, 5: ""}


def test_source_stats_order_and_counts(spark):
    rows, frame = records(spark)
    out = stats.source_stats(frame, F.lit(datetime(2024, 1, 9, 12)).cast("timestamp")).collect()
    assert [r.source_name for r in out] == ["a", "b", "only"]
    mine = [r for r in rows if r[0] == "a"]
    assert (out[0].total_records, out[0].unique_urls) == (len(mine), len({r[5] for r in mine}))
    assert out[0].records_last_24h == sum(r[3] > datetime(2024, 1, 8, 12) for r in mine)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_keys", [1, 3, 100])
def test_spread_join_equals_a_plain_join(spark, how, hot_keys):
    names = [None, "hot", "hot", "hot", "b", "c", "d", "unknown", "unknown"]
    rows = spark.createDataFrame([(names[i % 9], i, {"a": "b"}) for i in range(180)], "name string, number int, extra map<string,string>")
    known = spark.createDataFrame([("hot", 1), ("b", 2), ("c", None), ("d", 4), ("idle", 5), (None, 6)], "name string, value int")
    found = lookup.spread_join(rows, known, ["name"], how, hot_keys).drop("extra")
    want = rows.join(known, ["name"], how).drop("extra")
    assert found.columns == want.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


def test_spread_join_starts_no_job_and_leaves_hot_rows_in_place(spark):
    rows = spark.range(0, 40_000, 1, 8).select(F.struct(F.lit("hot").alias("source_name"), "id").alias("doc"), F.lit("hot").alias("source_name"))
    rows = rows.unionByName(rows.limit(50).withColumn("source_name", F.concat(F.lit("s"), F.col("doc.id"))))
    known = spark.range(60).select(F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("s"), "id")).alias("source_name"), "id")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("built", "")
    joined = lookup.spread_join(rows, known, ["source_name"], hot_keys=1)
    assert not tracker.getJobIdsForGroup("built")
    spark.sparkContext.setJobGroup("run", "")
    tasks = joined.filter("id = 0").groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in tasks) == 40_000 and len(tasks) >= 8


def test_salted_join_spreads_wrapped_and_equal_rows(spark):
    wrapped = spark.range(0, 8_000, 1, 8).select(F.struct("id", F.lit("x").alias("source")).alias("doc"), F.lit("x").alias("source"))
    equal = spark.range(0, 8_000, 1, 8).select(F.lit("x").alias("source"))
    known = spark.createDataFrame([("x", 1)], "source string, value int")
    for rows in (wrapped, equal):
        spread = lookup.salted_join(rows, known, ["source"], salts=16)
        plan = spread._jdf.queryExecution().optimizedPlan().toString()
        assert "spark_partition_id" in plan.lower()
        assert spread.count() == 8_000
    salt = lookup.F.pmod(lookup.F.xxhash64(lookup.F.spark_partition_id(), *lookup._hashed(wrapped)), lookup.F.lit(16))
    assert wrapped.select(salt.alias("s")).distinct().count() == 16


def test_rows_to_insert(spark):
    _, frame = records(spark, 30)
    twice = frame.unionByName(frame)
    fresh = merge.rows_to_insert(frame.limit(10), twice, ["ingested_at"])
    assert fresh.count() == 20 and fresh.select("fingerprint").distinct().count() == 20
    assert merge.rows_to_insert(fresh, fresh, ["ingested_at"]).count() == 0


LOG = ("batch_id string, source_name string, records_raw bigint, records_clean bigint, records_failed bigint, "
       "started_at timestamp, finished_at timestamp, status string, error_message string")  # fmt: skip


def test_audit_upserts(spark):
    early, late = datetime(2024, 1, 1), datetime(2024, 1, 2)
    log = spark.createDataFrame([("b", "s", 5, 4, 1, early, early, "partial", "old"), ("c", "s", 1, 1, 0, None, early, "success", "")], LOG)
    run = spark.createDataFrame([("b", "s", 9, 8, 0, late, late, "success", ""), ("d", "s", 1, 1, 0, late, late, "failed", "x" * 5000)], LOG)
    got = {r.batch_id: r for r in merge.upsert_audit(log, run).collect()}
    assert tuple(got["b"])[2:] == (9, 8, 0, early, late, "success", "") and got["c"].started_at is None
    assert len(got["d"].error_message) == 1000 and len(got) == 3
    summary = run.select("batch_id", "source_name", "records_raw", "records_clean", "records_failed", "started_at", "finished_at", "status")
    got = {r.batch_id: r for r in merge.upsert_summary(log, summary).collect()}
    assert tuple(got["b"])[2:] == (5, 8, 1, early, late, "success", "old") and got["d"].error_message == ""


def test_run_duration(spark):
    frame = spark.createDataFrame([(datetime(2024, 1, 1, 12), datetime(2024, 1, 1, 12, 0, 5))], "a timestamp, b timestamp")
    assert frame.select(stats.run_duration(frame.a, frame.b)).first()[0] == 5.0


def test_counts_add_up(spark):
    rows = [{"title": t, "url": f"u{u}", "score": s} for t, u, s in
            [("A", 1, ""), ("A", 1, ""), ("N/A", 2, ""), ("B", 3, "1..2"), ("C", 4, "999999999"), ("D", 5, "3")]]
    frame = raw(spark, rows)
    checked = check_batch(frame)
    (c,) = stats.run_counts(frame, checked).collect()
    assert (c.records_raw, c.records_junk, c.records_error, c.records_duplicate, c.records_clean, c.records_failed) == (6, 1, 1, 1, 2, 1)


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_group_limits_run_before_the_shuffle(spark):
    _, frame = records(spark)
    for limited in (clean.keep_first(frame, ["fingerprint"], ["ingested_at"]), ranking.top_per_category(frame)):
        plan = physical(limited)
        assert "Partial" in plan and plan.count("WindowGroupLimit") == 2


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_type source_name", "props title", "event_type url", "event_type category", "ts ingested_at", "props fingerprint"
    )
    plan = physical(reports.latest_of_source(events, "view"))
    assert "EqualTo(event_type,view)" in plan and "TakeOrderedAndProject" in plan and "value" not in plan.split("ReadSchema")[1]


def test_score_bounds_move_no_records(spark):
    _, frame = records(spark)
    plan = physical(enrich.normalise_scores(frame))
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
