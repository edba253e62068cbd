"""The catalog tables, the reports over them, and the writes that keep them.

Every write of a load goes to partitions of its own (``load_id``) and replaces them as a whole when it is done, so a
load that was interrupted can simply run again. One writer at a time is assumed. With a ``location`` the tables are files
below it, and a later session that creates the same warehouse finds them again.

Stored records lie by day of ingestion, load and key bucket (a hash of the fingerprint). A load reads the known keys of the
buckets its own keys fall into, and joins bucket to bucket; a purge drops whole days and rewrites only those at the border.

The reports read summaries that can be merged: counts, sums, bounds, best records and distinct URLs of each day and load. A
summary is made once, when a report first finds records without one; replays and purges drop those they change.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.operators.clean import keep_first
from gleanery.operators.enrich import normalise_scores
from gleanery.operators.merge import rows_to_insert
from gleanery.operators.ranking import top_per_category
from gleanery.operators.validate import as_stored, invalid_rows, valid_rows
from gleanery.plans.reports import kept_after_purge
from gleanery.schemas import AUDIT, AUDIT_KEY, CLEAN_COLUMNS, FIRST, RAW, ROW_HASH, SEQUENCE, STORED
from gleanery.session import shared_folder

#: Part of the stored layout: fixed once a warehouse holds records.
KEY_BUCKETS = 8
#: How the partition of a null value is named on disk and in the catalog.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

_LOAD = T.StructField("load_id", T.StringType())
_PLACE = [T.StructField("ingested_on", T.DateType()), _LOAD, T.StructField("key_bucket", T.IntegerType())]
_SNAPSHOT = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("raw_html", T.StringType()),
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("batch_id", T.StringType()),
        _LOAD,
        T.StructField("source_name", T.StringType()),
    ]
)
_CHECKED = T.StructType(
    [
        *[f if not isinstance(f.dataType, T.DecimalType) else T.StructField(f.name, T.DoubleType()) for f in STORED],
        *[f for f in RAW if f.name in SEQUENCE],
        ROW_HASH,
        T.StructField("raw_keys", T.StructType([f for f in AUDIT if f.name in AUDIT_KEY])),
        T.StructField("errors", T.ArrayType(T.StringType())),
    ]
)

# table -> (columns, partition columns, which come last)
#: Best records kept per category in a summary; reports that ask for more read all records.
TOP_KEPT = 10
_SUMMARY = T.StructType(
    [
        T.StructField("source_name", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("total_records", T.LongType()),
        T.StructField("scored_records", T.LongType()),
        T.StructField("sum_score", T.DecimalType(22, 4)),
        T.StructField("min_score", T.DecimalType(12, 4)),
        T.StructField("max_score", T.DecimalType(12, 4)),
        T.StructField("last_ingested_at", T.TimestampType()),
        T.StructField("record", STORED),
        *_PLACE[:2],
        T.StructField("kind", T.StringType()),
    ]
)

TABLES = {
    "raw_scrape_data": (_SNAPSHOT, ["load_id", "source_name"]),
    "clean_records": (T.StructType([*STORED, *_PLACE]), [f.name for f in _PLACE]),
    "record_summaries": (_SUMMARY, ["ingested_on", "load_id", "kind"]),
    "quarantine": (T.StructType([*_CHECKED, _LOAD]), ["load_id"]),
    "ingestion_log": (T.StructType([*AUDIT, T.StructField("logged_at", T.TimestampType()), _LOAD]), ["load_id"]),
    "rule_counts": (T.StructType([T.StructField("rule", T.StringType()), T.StructField("rows", T.LongType()), _LOAD]), ["load_id"]),
    "staged_raw": (T.StructType([*RAW, _LOAD, T.StructField("producer", T.StringType())]), ["load_id", "producer"]),
    "staged_checked": (T.StructType([*_CHECKED, _LOAD]), ["load_id"]),
}
VIEWS = ("vw_top_items_per_category", "vw_source_stats", "vw_normalised_scores")


def key_bucket(fingerprint: Column) -> Column:
    """The bucket that a key is stored in and looked up in."""
    return F.pmod(F.xxhash64(fingerprint), F.lit(KEY_BUCKETS)).cast("int")


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@contextmanager
def _overwriting(spark: SparkSession, mode: str) -> Iterator[None]:
    """``dynamic`` overwrites only the partitions that get rows, when the job is done; ``static`` the named ones."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, mode)
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Warehouse:
    """Pipeline tables in one catalog database."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None) -> None:
        self.spark, self.database, self.location = spark, database, location

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def create(self) -> None:
        """Create the database and tables that do not exist yet; files that an earlier session left are found again."""
        where = f" LOCATION '{self.location}/_catalog'" if self.location else ""  # dropping a database clears its folder
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`{where}")
        for table, (schema, partitions) in TABLES.items():
            if self.spark.catalog.tableExists(self.name(table)):
                continue
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            place = f" LOCATION '{self.location}/{table}'" if self.location else ""
            self.spark.sql(
                f"CREATE TABLE {self.name(table)} ({columns}) USING parquet PARTITIONED BY ({', '.join(partitions)}){place}"
            )
            if self.location:
                self._recover(table)

    def _recover(self, table: str) -> None:
        """Enter the partitions that lie below the location of a table; a new location holds none."""
        try:
            self.spark.sql(f"ALTER TABLE {self.name(table)} RECOVER PARTITIONS")
        except Py4JJavaError as failure:
            if "FileNotFoundException" not in str(failure.java_exception):
                raise

    def refresh_summaries(self) -> None:
        """Summarise the days and loads that have no summary yet, and drop summaries of records that are gone."""
        days = lambda table: {(p["ingested_on"], p["load_id"]) for p in self.partitions(table)}
        stored, summed = days("clean_records"), days("record_summaries")
        for day, load in summed - stored:
            self.clear("record_summaries", ingested_on=day, load_id=load)
        if not stored - summed:
            return
        by_load: dict[str, list[str]] = {}
        for day, load in sorted(stored - summed):
            by_load.setdefault(load, []).append(day)
        chosen = F.lit(False)
        for load, some in by_load.items():
            chosen = chosen | ((F.col("load_id") == load) & F.col("ingested_on").isin([F.lit(day).cast("date") for day in some]))
        rows = self.table("clean_records").filter(chosen)
        place = ["ingested_on", "load_id"]
        totals = rows.groupBy(*place, "source_name").agg(
            F.count(F.lit(1)).alias("total_records"), F.count("score").alias("scored_records"), F.sum("score").alias("sum_score"),
            F.min("score").alias("min_score"), F.max("score").alias("max_score"), F.max("ingested_at").alias("last_ingested_at"),
        )
        urls = rows.select(*place, "source_name", "url").distinct()
        best = top_per_category(rows, TOP_KEPT, place).select(*place, F.struct(*STORED.fieldNames()).alias("record"))
        found = None
        for kind, part in (("totals", totals), ("urls", urls), ("top", best)):
            typed = [
                (F.col(f.name) if f.name in part.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in _SUMMARY if f.name != "kind"
            ]
            part = part.select(*typed, F.lit(kind).alias("kind"))
            found = part if found is None else found.unionByName(part)
        spread = found.hint("rebalance", *[F.col(name) for name in TABLES["record_summaries"][1]])
        self.replace_partitions(spread, "record_summaries")

    def summaries(self, kind: str) -> DataFrame:
        self.refresh_summaries()
        return self.table("record_summaries").filter(F.col("kind") == kind)

    def top_items(self, count: int = 10) -> DataFrame:
        """The best stored records of every category."""
        if count <= TOP_KEPT:
            records = self.summaries("top").select("record.*")
        else:
            records = self.table("clean_records")
        return top_per_category(records.select(*CLEAN_COLUMNS), count)

    def source_stats(self, as_of: Column | None = None) -> DataFrame:
        """As ``operators.stats.source_stats`` of all stored records; of these only the last days are read."""
        now = F.current_timestamp() if as_of is None else as_of
        day = F.expr("INTERVAL 24 HOURS")
        totals = self.summaries("totals").groupBy("source_name").agg(
            F.sum("total_records").alias("total_records"),
            (F.sum("sum_score").cast("decimal(22,4)") / F.sum("scored_records")).cast("decimal(16,8)").alias("avg_score"),
            F.max("last_ingested_at").alias("last_ingested_at"),
        )
        urls = self.table("record_summaries").filter("kind = 'urls'").groupBy("source_name").agg(F.count_distinct("url").alias("unique_urls"))
        # one day more, as sessions may differ in time zone
        late = self.table("clean_records").filter((F.col("ingested_on") >= F.date_sub(F.to_date(now - day), 1)) & (F.col("ingested_at") > now - day))
        recent = late.groupBy("source_name").agg(F.count(F.lit(1)).alias("records_last_24h"))
        joined = totals.join(urls, "source_name", "left").join(recent, "source_name", "left").na.fill(0, ["records_last_24h"])
        return joined.select(
            "source_name", "total_records", "unique_urls", "avg_score", "last_ingested_at", "records_last_24h"
        ).orderBy(F.desc("total_records"), "source_name")

    def score_bounds(self) -> DataFrame:
        """Least and greatest stored score per source."""
        totals = self.summaries("totals").groupBy("source_name")
        return totals.agg(F.min("min_score").alias("min_score"), F.max("max_score").alias("max_score"))

    def normalised_scores(self) -> DataFrame:
        """Stored scores scaled to 0..1 within their source, as ``score_norm``."""
        scored = normalise_scores(self.table("clean_records"), into="score_norm", bounds=self.score_bounds())
        return scored.select("fingerprint", "source_name", "score", "score_norm")

    def register_views(self) -> None:
        """The reports as temporary views of this session, for SQL."""
        for view, rows in zip(VIEWS, (self.top_items(), self.source_stats(), self.normalised_scores()), strict=True):
            rows.createOrReplaceTempView(view)

    def drop(self) -> None:
        """Drop the tables and the database. Files below a ``location`` stay."""
        for table in TABLES:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}`")

    def replace_partitions(self, rows: DataFrame, table: str) -> int:
        """Write rows, replacing exactly the partitions they fall into when done; returns how many were written."""
        seen = Observation()
        ordered = rows.select(*[f.name for f in TABLES[table][0]]).observe(seen, F.count(F.lit(1)).alias("rows"))
        with _overwriting(rows.sparkSession, "dynamic"):
            ordered.write.insertInto(self.name(table), overwrite=True)
        # a stream writes through a session of its own, whose new files the warehouse's session would not look for
        self.spark.catalog.refreshTable(self.name(table))
        return seen.get["rows"]

    def clear(self, table: str, **labels: str) -> None:
        """Remove all rows whose first partition columns have the given values."""
        schema, partitions = TABLES[table]
        spec = ", ".join(f"`{c}` = {_quoted(labels[c])}" if c in labels else f"`{c}`" for c in partitions)
        nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema if f.name not in labels)
        with _overwriting(self.spark, "static"):
            self.spark.sql(f"INSERT OVERWRITE TABLE {self.name(table)} PARTITION ({spec}) SELECT {nulls} WHERE false")

    def replace_load(self, rows: DataFrame, table: str, load_id: str, **labels: str) -> int:
        """Write the rows of a load. What an earlier attempt left stays readable until they are there, and goes even if
        there are none; returns how many were written."""
        names = {"load_id": load_id} | labels
        count = self.replace_partitions(rows.withColumns({name: F.lit(value) for name, value in names.items()}), table)
        if count == 0:
            self.clear(table, **names)
        return count

    def partitions(self, table: str, **labels: str) -> list[dict[str, str]]:
        """The labels of all partitions that have the given ones; metadata only."""
        chosen = ", ".join(f"`{name}` = {_quoted(value)}" for name, value in labels.items())
        names = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}{f' PARTITION ({chosen})' if labels else ''}").collect()
        return [{key: unquote(value) for key, value in (part.split("=", 1) for part in row.partition.split("/"))} for row in names]

    def _occupied(self, rows: DataFrame, table: str) -> set[tuple[str, ...]]:
        """The partitions that rows fall into, written as their labels are."""
        found = rows.select(*[F.col(name).cast("string") for name in TABLES[table][1]]).distinct().collect()
        return {tuple(NULL_PARTITION if value is None else value for value in row) for row in found}

    def replace_below(self, rows: DataFrame, table: str, earlier: list[dict[str, str]]) -> int:
        """Write rows, then clear those of the ``earlier`` partitions that got none: at no time is a row missing that stays.

        The rows must come out the same when they are computed again; returns how many were written.
        """
        count = self.replace_partitions(rows, table)
        if earlier:
            occupied = self._occupied(rows, table) if count else set()
            for labels in earlier:
                if tuple(labels[name] for name in TABLES[table][1]) not in occupied:
                    self.clear(table, **labels)
        return count

    def save_snapshot(self, pages: DataFrame, load_id: str) -> None:
        """Keep landed pages or documents as they came (source_name, url, raw_html, scraped_at, batch_id).

        Sources that an earlier attempt of the load had and this one has not are removed once the new ones are written.
        """
        earlier = self.partitions("raw_scrape_data", load_id=load_id)
        self.replace_below(pages.withColumn("load_id", F.lit(load_id)), "raw_scrape_data", earlier)

    def stage(self, rows: DataFrame, table: str, load_id: str, **labels: str) -> None:
        """Write an intermediate result of a load."""
        self.replace_load(rows, table, load_id, **labels)

    def staged(self, table: str, load_id: str) -> DataFrame:
        return self.table(table).filter(F.col("load_id") == load_id).drop("load_id")

    def clear_stage(self, load_id: str) -> None:
        for table in ("staged_raw", "staged_checked"):
            self.clear(table, load_id=load_id)

    def known_keys(self, new: DataFrame, load_id: str) -> DataFrame:
        """Keys stored by other loads, with their bucket, read from the buckets that ``new`` (with a key_bucket) falls into."""
        touched = [row.key_bucket for row in new.select("key_bucket").distinct().collect()]  # at most KEY_BUCKETS numbers
        theirs = (F.col("load_id") != load_id) & F.col("key_bucket").isin(touched)
        return self.table("clean_records").filter(theirs).select("fingerprint", "key_bucket")

    def place(self, records: DataFrame, load_id: str | Column) -> DataFrame:
        """Records with the columns they are stored by, in files of a good size however many buckets and tasks there are."""
        placed = records.withColumns(
            {
                "ingested_on": F.to_date("ingested_at"),
                "load_id": F.lit(load_id) if isinstance(load_id, str) else load_id,
                "key_bucket": key_bucket(F.col("fingerprint")),
            }
        )
        spread = placed.hint("rebalance", F.col("ingested_on"), F.col("load_id"), F.col("key_bucket"))
        # Sorted files let scans for one source skip row groups.
        return spread.sortWithinPartitions("ingested_on", "load_id", "key_bucket", "source_name")

    def load(self, checked: DataFrame, load_id: str) -> int:
        """Store the valid rows whose fingerprint is new, first one wins; returns how many were stored.

        Rows that the same load stored before do not count as known: they are replaced.
        """
        new = valid_rows(checked).withColumn("key_bucket", key_bucket(F.col("fingerprint")))
        fresh = as_stored(rows_to_insert(self.known_keys(new, load_id), new, FIRST, ["fingerprint", "key_bucket"]))
        earlier = self.partitions("clean_records", load_id=load_id)
        for day in {labels["ingested_on"] for labels in earlier}:
            self.clear("record_summaries", ingested_on=day, load_id=load_id)
        return self.replace_below(self.place(fresh, load_id), "clean_records", earlier)

    def quarantine(self, checked: DataFrame, load_id: str) -> None:
        """Keep the rows that failed validation, with their messages."""
        self.replace_load(invalid_rows(checked), "quarantine", load_id)

    def log(self, without: str | None = None, runs: DataFrame | None = None) -> DataFrame:
        """The audit log: the newest entry per (batch_id, source_name), of the given ``runs`` or of all.

        Entries of the load ``without`` are left out. Other runs' entries are dropped before the newest ones are found.
        """
        entries = self.table("ingestion_log")
        if without is not None:
            entries = entries.filter(F.col("load_id") != without)
        if runs is not None:
            wanted = runs.select(*[F.col(key).alias(f"_{key}") for key in AUDIT_KEY]).distinct()
            same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in AUDIT_KEY]
            entries = entries.join(wanted, same, "left_semi")
        newest = F.max_by(F.struct(*AUDIT.fieldNames()), F.struct("logged_at", "load_id")).alias("_entry")
        return entries.groupBy(*AUDIT_KEY).agg(newest).select("_entry.*")

    def compact_log(self) -> None:
        """Rewrite the audit log to one entry per run: what newer entries replaced goes. Run it every now and then."""
        shared_folder(self.spark)
        columns = [f.name for f in TABLES["ingestion_log"][0]]
        newest = F.max_by(F.struct(*columns), F.struct("logged_at", "load_id")).alias("_entry")
        kept = self.table("ingestion_log").groupBy(*AUDIT_KEY).agg(newest).select("_entry.*").checkpoint()
        self.replace_below(kept, "ingestion_log", self.partitions("ingestion_log"))

    def add_to_log(self, rows: DataFrame, load_id: str) -> None:
        """Write the audit entries of a load; what other loads wrote is not touched."""
        self.replace_load(rows.withColumn("logged_at", F.current_timestamp()), "ingestion_log", load_id)

    def purge(self, as_of: Column | None = None, days: int = 90) -> None:
        """Delete stored records older than ``days``; the audit log stays.

        Days that are old as a whole are dropped unread, one statement each. Only the days at the border (one on either side,
        as sessions may differ in time zone) are read, and of these only partitions with an old row are rewritten.
        """
        shared_folder(self.spark)
        now = F.current_timestamp() if as_of is None else as_of
        border = self.spark.range(1).select(F.to_date(now - F.expr(f"INTERVAL {int(days)} DAYS")).alias("day")).first().day
        near = [str(border + timedelta(days=shift)) for shift in (-1, 0, 1)]
        stored = self.partitions("clean_records")
        for day in sorted({labels["ingested_on"] for labels in stored if labels["ingested_on"] < near[0]}):
            self.clear("clean_records", ingested_on=day)
            self.clear("record_summaries", ingested_on=day)
        if not any(labels["ingested_on"] in near for labels in stored):
            return
        records = self.table("clean_records").filter(F.col("ingested_on").isin([F.lit(day).cast("date") for day in near]))
        place = TABLES["clean_records"][1]
        kept = kept_after_purge(records, now, days)
        sizes = records.groupBy(*place).agg(F.count(F.lit(1)).alias("all"))
        left = kept.groupBy(*place).agg(F.count(F.lit(1)).alias("young"))
        # a row for each partition of three days
        touched = sizes.join(left, place, "left").filter(~F.col("all").eqNullSafe(F.col("young"))).select(*place).checkpoint()
        mixed = kept.join(F.broadcast(touched), place, "left_semi").checkpoint()
        occupied = self._occupied(touched, "clean_records")
        old = [labels for labels in stored if tuple(labels[name] for name in place) in occupied]
        for day, load in {(labels["ingested_on"], labels["load_id"]) for labels in old}:
            self.clear("record_summaries", ingested_on=day, load_id=load)
        self.replace_below(mixed, "clean_records", old)
