"""Whole loads against the tables: stored rows, quarantine, audit, repeats, purge, streaming."""

import uuid
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gleanery.operators import clean, enrich, ranking, stats
from gleanery.operators.limits import Limits
from gleanery.plans import batch
from gleanery.plans.batch import SourceRun, run_batch
from gleanery.plans.warehouse import KEY_BUCKETS, TABLES, Warehouse
from gleanery.schemas import CLEAN_COLUMNS, RAW
from gleanery.session import scratch_path
from gleanery.sources.registry import source_frame
from gleanery.streaming.ingest import ingest_stream

NOW = datetime(2024, 6, 1, 12)


@pytest.fixture
def warehouse(spark):
    house = Warehouse(spark, f"t{uuid.uuid4().hex[:8]}", scratch_path(spark, "warehouse"))
    house.create()
    yield house
    house.drop()


def raw(spark, rows):
    """Rows of (source, url, title, score, extra, batch); position by order."""
    full = [(s, u, t, "", "", [], sc, ex, NOW, b, 0, 0, i) for i, (s, u, t, sc, ex, b) in enumerate(rows)]
    return spark.createDataFrame(full, RAW)


ROWS = [
    ("Hacker News", "https://e.com/1", "Story", "10", {"category": ""}, "b1"),
    ("Hacker News", "https://e.com/1/", "Story again", "11", {"category": ""}, "b1"),
    ("Hacker News", "https://e.com/2", "N/A", "5", {}, "b1"),
    ("Hacker News", "https://e.com/3", "Odd", "1.2.3", {}, "b1"),
    ("Hacker News", "https://e.com/4", "Bad category", "1", {"category": None}, "b1"),
    ("Hacker News", "https://e.com/5", "Huge", "999999999", {}, "b1"),
    ("Hacker News", "https://e.com/6", "Other", "30", {"category": "x", "price": "£1,000.50"}, "b1"),
]


def moment():
    return F.lit(NOW).cast("timestamp")


def run(warehouse, rows, load_id, source="Hacker News", batch="b1"):
    sources = [SourceRun(source, batch, lambda: raw(warehouse.spark, rows))]
    categories = source_frame(warehouse.spark).select(F.col("name").alias("source_name"), "category")
    return run_batch(warehouse, sources, load_id, categories, moment())


def test_load_stores_and_counts(spark, warehouse):
    totals = run(warehouse, ROWS, "l1").first()
    assert (totals.total_raw, totals.total_clean, totals.total_inserted) == (7, 2, 2)
    stored = {r.title: r for r in warehouse.table("clean_records").collect()}
    assert set(stored) == {"Story", "Other"}
    assert stored["Story"].category == "tech_news" and stored["Other"].category == "x"
    assert float(stored["Other"].price) == 1000.5
    bad = {r.title: r.errors for r in warehouse.table("quarantine").collect()}
    assert bad == {"Bad category": ["category: not a string"], "Huge": ["score: does not fit decimal(12,4)"]}
    (audit,) = warehouse.log().collect()
    assert audit.status == "success" and audit.records_raw == 7
    assert (audit.records_clean, audit.records_failed, audit.records_junk) == (2, 2, 1)
    assert (audit.records_error, audit.records_duplicate) == (1, 1)
    assert warehouse.table("staged_raw").count() == 0


def test_load_again_changes_nothing(spark, warehouse):
    run(warehouse, ROWS, "l1")
    before = sorted(r.fingerprint for r in warehouse.table("clean_records").collect())
    assert run(warehouse, ROWS, "l1").first().total_inserted == 2
    assert run(warehouse, ROWS, "l2", batch="b2").first().total_inserted == 0
    assert sorted(r.fingerprint for r in warehouse.table("clean_records").collect()) == before
    assert {(r.batch_id) for r in warehouse.log().collect()} == {"b1"} | {"b2"}


def test_empty_load(spark, warehouse):
    assert run(warehouse, [], "l1").first().total_inserted == 0
    (audit,) = warehouse.log().collect()
    assert (audit.status, audit.records_raw) == ("success", 0)


def test_failing_producer_is_recorded(spark, warehouse):
    def fail():
        raise RuntimeError("the producer gave up")

    good = SourceRun("Hacker News", "b1", lambda: raw(spark, ROWS[:1]))
    run_batch(warehouse, [SourceRun("Broken", "b0", fail), good], "l1", ingested_at=moment())
    log = {r.source_name: r for r in warehouse.log().collect()}
    assert log["Broken"].status == "failed" and "gave up" in log["Broken"].error_message
    assert log["Hacker News"].status == "success" and log["Hacker News"].records_clean == 1


def test_failed_storing_is_partial(spark, warehouse, monkeypatch):
    monkeypatch.setattr(Warehouse, "load", lambda *a: (_ for _ in ()).throw(RuntimeError("x" * 5000)))
    run(warehouse, ROWS, "l1")
    (audit,) = warehouse.log().collect()
    assert audit.status == "partial" and len(audit.error_message) == 1000


def test_views(spark, warehouse):
    run(warehouse, ROWS, "l1")
    warehouse.register_views()
    top = spark.table("vw_top_items_per_category").orderBy("category").collect()
    assert [(r.category, r.rank_in_category) for r in top] == [("tech_news", 1), ("x", 1)]
    (stats,) = spark.table("vw_source_stats").collect()
    assert (stats.total_records, stats.unique_urls, stats.records_last_24h) == (2, 2, 0)
    norm = {float(r.score): float(r.score_norm) for r in spark.table("vw_normalised_scores").collect()}
    assert norm == {10.0: 0.0, 30.0: 1.0}


@pytest.mark.parametrize("load_id", ["2024-06-01T12:00", "a/b=c", "it's", "50% \\ off"])
def test_replays_replace(spark, warehouse, load_id):
    run(warehouse, ROWS, load_id)
    assert warehouse.table("staged_raw").count() == 0
    assert run(warehouse, [ROWS[2]], load_id).first().total_inserted == 0  # the retry has no usable row
    assert warehouse.table("clean_records").count() == warehouse.table("quarantine").count() == 0
    (audit,) = warehouse.log().collect()
    assert (audit.records_raw, audit.records_clean, audit.records_junk) == (1, 0, 1)
    assert run(warehouse, ROWS, load_id).first().total_inserted == 2


def test_snapshot_with_fewer_sources(spark, warehouse):
    schema = "source_name string, url string, raw_html string, scraped_at timestamp, batch_id string"
    rows = [("a/b", "u1", "<p>", NOW, "b"), ("c:d", "u2", "<q>", NOW, "b")]
    warehouse.save_snapshot(spark.createDataFrame(rows, schema), "l'1")
    warehouse.save_snapshot(spark.createDataFrame(rows[1:], schema), "l'1")
    assert [r.source_name for r in warehouse.table("raw_scrape_data").collect()] == ["c:d"]


def test_counts_under_padded_and_missing_names(spark, warehouse):
    rows = [(" Padded ", f"https://e.com/{i}", f"t{i}", "1", {"category": ""}, "b1") for i in range(2)]
    rows += [(None, "https://e.com/9", "t9", "1", {"category": ""}, "b1")]
    sources = [SourceRun(" Padded ", "b1", lambda: raw(spark, rows[:2])), SourceRun(None, "b1", lambda: raw(spark, rows[2:]))]
    warehouse.stage(raw(spark, rows), "staged_raw", "l1", producer="p")
    counts = {r.source_name: r for r in stats.run_counts(raw(spark, rows), batch.check_batch(raw(spark, rows), moment())).collect()}
    assert (counts[" Padded "].records_clean, counts[" Padded "].records_duplicate) == (2, 0)
    assert (counts[None].records_failed, counts[None].records_duplicate) == (1, 0)
    batch.store(warehouse, "l1", ingested_at=moment())
    log = {r.source_name: r.records_failed for r in warehouse.log().collect()}
    assert log[" Padded "] == 0 and log[None] == 1
    assert len(sources) == 2


def test_second_session_finds_the_tables(spark):
    place = scratch_path(spark, "kept")
    first = Warehouse(spark, f"t{uuid.uuid4().hex[:8]}", place)
    first.create()
    run(first, ROWS, "l:1")
    first.drop()  # only the catalog's entries: as if a new application had started
    again = Warehouse(spark, f"t{uuid.uuid4().hex[:8]}", place)
    again.create()
    assert again.table("clean_records").count() == 2 and again.log().count() == 1
    assert run(again, ROWS, "l2", batch="b2").first().total_inserted == 0
    again.drop()


def test_purge(spark, warehouse):
    run(warehouse, ROWS[:1], "old")
    later = [SourceRun("Hacker News", "b2", lambda: raw(spark, ROWS[6:]))]
    run_batch(warehouse, later, "new", ingested_at=F.lit(datetime(2024, 9, 1)).cast("timestamp"))
    mixed = warehouse.table("clean_records").withColumn("load_id", F.lit("mixed")).checkpoint()
    warehouse.replace_partitions(mixed, "clean_records")
    warehouse.purge(as_of=F.lit(datetime(2024, 9, 10)).cast("timestamp"))
    assert {(r.load_id, r.title) for r in warehouse.table("clean_records").collect()} == {("new", "Other"), ("mixed", "Other")}
    assert warehouse.log().count() == 2


def many(count, start=0):
    return [("Hacker News", f"https://e.com/{i}", f"Story {i}", str(i), {"category": ""}, "b1") for i in range(start, start + count)]


def stored_files(warehouse):
    return set(warehouse.table("clean_records").inputFiles())


def test_only_touched_buckets_are_read(spark, warehouse):
    run(warehouse, many(60), "l1")
    records = warehouse.table("clean_records")
    assert records.select("key_bucket").distinct().count() == KEY_BUCKETS
    one = records.filter("key_bucket = 3").select("fingerprint", "key_bucket").limit(2)
    known = warehouse.known_keys(one, "l2")
    assert known.select("key_bucket").distinct().collect() == [(3,)]
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "key_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert plan.split("ReadSchema: ")[1].startswith("struct<fingerprint:string>")
    assert run(warehouse, [*many(5, 58), many(1)[0]], "l2", batch="b2").first().total_inserted == 3


def test_replay_leaves_no_row_of_other_buckets_or_days(spark, warehouse):
    run(warehouse, many(30), "l1")
    other = [SourceRun("Hacker News", "b1", lambda: raw(spark, many(4)))]
    run_batch(warehouse, other, "l1", ingested_at=F.lit(datetime(2024, 6, 2)).cast("timestamp"))
    left = warehouse.table("clean_records").select("title", F.col("ingested_on").cast("string")).collect()
    assert sorted(tuple(r) for r in left) == [(f"Story {i}", "2024-06-02") for i in range(4)]


def test_purge_touches_border_days_only(spark, warehouse):
    for day in (1, 2, 10, 20):
        runs = [SourceRun("Hacker News", "b1", lambda day=day: raw(spark, many(20, 100 * day)))]
        run_batch(warehouse, runs, f"day {day}", ingested_at=F.lit(datetime(2024, 6, day, 6)).cast("timestamp"))
    late = warehouse.table("clean_records").filter("load_id = 'day 10'").limit(3)
    late = late.withColumns({"ingested_at": F.lit(datetime(2024, 6, 10, 18)).cast("timestamp"), "load_id": F.lit("late")}).checkpoint()
    warehouse.replace_partitions(late, "clean_records")
    kept = {f for f in stored_files(warehouse) if "ingested_on=2024-06-20" in f or "load_id=late" in f}
    warehouse.purge(as_of=F.lit(datetime(2024, 6, 17, 12)).cast("timestamp"), days=7)
    assert {tuple(r) for r in warehouse.table("clean_records").groupBy("load_id").count().collect()} == {("late", 3), ("day 20", 20)}
    assert stored_files(warehouse) == kept  # partitions without an old row are the same files as before
    assert {p["ingested_on"] for p in warehouse.partitions("clean_records")} == {"2024-06-10", "2024-06-20"}
    assert run(warehouse, many(2, 100), "again").first().total_inserted == 2  # purged keys are no longer known


def test_reports_from_summaries_equal_those_of_all_records(spark, warehouse):
    def check():
        records = warehouse.table("clean_records")
        as_of = F.lit(datetime(2024, 6, 3, 12)).cast("timestamp")
        assert warehouse.source_stats(as_of).collect() == stats.source_stats(records, as_of).collect()
        plain = lambda rows: sorted(map(str, rows.select(*CLEAN_COLUMNS, "rank_in_category").collect()))
        for count in (2, 10, 12):
            assert plain(warehouse.top_items(count)) == plain(ranking.top_per_category(records, count))
        scaled = enrich.normalise_scores(records, into="score_norm").select("fingerprint", "source_name", "score", "score_norm")
        assert sorted(map(str, warehouse.normalised_scores().collect())) == sorted(map(str, scaled.collect()))

    def load(name, rows, day):
        runs = [SourceRun("Hacker News", "b1", lambda: raw(spark, rows))]
        run_batch(warehouse, runs, name, source_frame(spark).select(F.col("name").alias("source_name"), "category"), F.lit(datetime(2024, 6, day)).cast("timestamp"))

    check()  # of an empty warehouse
    load("l1", many(30), 1)
    load("l2", [*many(5, 28), ("Lobsters", "", "No link", None, {"category": "x"}, "b2"), ("Lobsters", "", "Nor here", "7", {"category": "x"}, "b2")], 3)
    check()
    before = {f for f in warehouse.table("record_summaries").inputFiles() if "load_id=l2" in f}
    load("l3", many(4, 100), 4)
    load("l1", many(12), 2)  # a replay with fewer rows, on another day
    check()
    assert before <= set(warehouse.table("record_summaries").inputFiles())
    warehouse.purge(as_of=F.lit(datetime(2024, 6, 9)).cast("timestamp"), days=6)
    check()
    read = warehouse.source_stats(F.lit(datetime(2024, 6, 30)).cast("timestamp")).inputFiles()
    assert read and not [f for f in read if "clean_records" in f]


def test_log_drops_other_runs_before_it_groups(spark, warehouse):
    for load in ("l1", "l2"):
        run(warehouse, many(2), load)
    run(warehouse, many(1, 50), "l3", batch="b9")
    wanted = spark.createDataFrame([("b9", "Hacker News")], "batch_id string, source_name string")
    assert [r.batch_id for r in warehouse.log(runs=wanted).collect()] == ["b9"]
    plan = warehouse.log(runs=wanted)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")
    before = sorted(warehouse.log().collect())
    assert warehouse.table("ingestion_log").count() == 4
    warehouse.compact_log()
    warehouse.compact_log()
    assert warehouse.table("ingestion_log").count() == 2 and sorted(warehouse.log().collect()) == before


def test_snapshot_is_not_cleared_before_the_new_one_is_there(spark, warehouse, monkeypatch):
    schema = "source_name string, url string, raw_html string, scraped_at timestamp, batch_id string"
    pages = spark.createDataFrame([("a", "u1", "<p>", NOW, "b"), (None, "u2", "<q>", NOW, "b")], schema)
    warehouse.save_snapshot(pages, "l1")
    with monkeypatch.context() as broken:
        broken.setattr(Warehouse, "replace_partitions", lambda *a: (_ for _ in ()).throw(RuntimeError("disk full")))
        with pytest.raises(RuntimeError):
            warehouse.save_snapshot(pages.limit(1), "l1")
    assert warehouse.table("raw_scrape_data").count() == 2
    warehouse.save_snapshot(pages.filter("source_name = 'a'"), "l1")
    assert [r.url for r in warehouse.table("raw_scrape_data").collect()] == ["u1"]


def test_snapshot(spark, warehouse):
    pages = spark.createDataFrame([("s1", "u1", "<p>", NOW, "b"), ("s2", "u2", "<q>", NOW, "b")],
                                  "source_name string, url string, raw_html string, scraped_at timestamp, batch_id string")
    warehouse.save_snapshot(pages, "l1")
    warehouse.save_snapshot(pages, "l1")
    warehouse.save_snapshot(pages, "l2")
    assert warehouse.table("raw_scrape_data").count() == 4


def test_create_and_drop_are_repeatable(spark):
    house = Warehouse(spark, f"t{uuid.uuid4().hex[:8]}", scratch_path(spark, "warehouse"))
    house.create()
    house.create()
    assert {r.tableName for r in spark.sql(f"SHOW TABLES IN {house.database}").collect()} >= set(TABLES)
    house.drop()
    house.drop()


def test_stream_runs_a_failed_micro_batch_again(spark, warehouse, monkeypatch):
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    raw(spark, ROWS).coalesce(1).write.parquet(landing)

    def ingest():
        stream = spark.readStream.schema(RAW).parquet(landing)
        ingest_stream(warehouse, stream, lambda rows: rows, checkpoint, ingested_at=moment()).awaitTermination()

    with monkeypatch.context() as broken:
        broken.setattr(Warehouse, "load", lambda *a: (_ for _ in ()).throw(RuntimeError("disk full")))
        with pytest.raises(StreamingQueryException):
            ingest()
    assert [(r.status, "disk full" in r.error_message) for r in warehouse.log().collect()] == [("partial", True)]
    ingest()
    assert sorted(r.title for r in warehouse.table("clean_records").collect()) == ["Other", "Story"]
    assert [r.status for r in warehouse.log().collect()] == ["success"]


def test_stream_equals_batch(spark, warehouse):
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    schema = RAW

    def ingest():
        stream = spark.readStream.schema(schema).parquet(landing)
        query = ingest_stream(warehouse, stream, lambda rows: rows, checkpoint, ingested_at=moment())
        query.awaitTermination()

    raw(spark, ROWS[:4]).coalesce(1).write.mode("append").parquet(landing)
    ingest()
    raw(spark, [*ROWS[4:], ROWS[0]]).coalesce(1).write.mode("append").parquet(landing)
    ingest()
    ingest()
    assert sorted(r.title for r in warehouse.table("clean_records").collect()) == ["Other", "Story"]
    loads = {r.load_id for r in warehouse.table("clean_records").select("load_id").distinct().collect()}
    assert loads == {"ingest-000000000", "ingest-000000001"}


def test_cuts_and_broken_rules_are_counted_as_they_are_written(spark, warehouse):
    rows = [("S", "", f"{i} " + "t" * 520, "1", {"category": "c" * (120 * (i % 2))}, "b1") for i in range(4)]
    run(warehouse, rows, "l1", "S")
    counted = lambda load: {r.rule: r.rows for r in warehouse.table("rule_counts").filter(F.col("load_id") == load).collect() if r.rows}
    assert counted("l1") == {"cut: title": 4, "category: longer than 100": 2}
    run(warehouse, rows, "l1", "S")  # a replay replaces its counts
    assert counted("l1") == {"cut: title": 4, "category: longer than 100": 2}
    sources = [SourceRun("S", "b2", lambda: raw(spark, rows))]
    run_batch(warehouse, sources, "l2", ingested_at=moment(), limits=Limits(title=600))
    assert counted("l2") == {"title: longer than 500": 4, "category: longer than 100": 2}  # what limits let through, rules report
    run(warehouse, [], "l3")
    assert counted("l3") == {} and warehouse.table("rule_counts").filter("load_id = 'l3'").count() == len(stats.observed_rule_names())


def test_tags_are_cut_and_noted(spark):
    tags = [f"t{i}" for i in range(25)]
    frame = raw(spark, [("S", "", "Title", "1", {}, "b")]).withColumn("tags", F.array(*map(F.lit, ["x" * 150, *tags])))
    row = clean.clean_records(frame, moment(), note_cuts=True).first()
    assert (len(row.tags), row.cuts) == (20, ["tags", "tag"])
    assert clean.clean_records(frame, moment(), limits=Limits(tags=30, tag_length=200), note_cuts=True).first().cuts == []
