"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import scratch_path

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]++"
BLANKS = " \t\n\x0b\f\r"


def word_count(text: Column) -> Column:
    """Words of a text without building a list of them; null counts as empty."""
    marks = F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "#"), BLANKS, "")
    return F.length(marks).cast("long")


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows written below the shared folder and read back: later steps neither compute them again nor lose them."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


#: Text that goes to a Python worker at once. Spark's own limit is 64 MB, of which the executor and the worker hold several copies.
ARROW_BATCH = "2m"
ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_small_batches(rows: DataFrame) -> DataFrame:
    """The rows, whose session from now on sends at most ARROW_BATCH (or one longer row) to a Python worker at once, unless it has a
    limit of its own. It is a setting of the session, as a plan asks for it only when it runs; results do not depend on it."""
    conf = rows.sparkSession.conf
    if conf.get(ARROW_LIMIT, None) is None:
        conf.set(ARROW_LIMIT, ARROW_BATCH)
    return rows


def give_back() -> None:
    """Memory that this process holds but no longer uses goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


#: What tasks keep in their Python worker for later tasks of their kind, by name.
_TABLES: dict[str, object] = {}


def kept_table(name: str, make: Callable[[str], object]) -> object:
    """The table of that name, made once per worker; building it may have taken far more memory than it holds."""
    if name not in _TABLES:
        _TABLES[name] = make(name)
        give_back()
    return _TABLES[name]


def forget_tables(but: str | None) -> None:
    """Tables that tasks of another kind kept go."""
    others = [name for name in _TABLES if name != but]
    for name in others:
        del _TABLES[name]
    if others:
        give_back()


def lean(task: Callable[[Iterator], Iterator], table: str | None = None) -> Callable[[Iterator], Iterator]:
    """The function of a task, giving back memory at its end: Spark keeps a Python worker for later tasks, of other stages too, and
    what the allocators keep of one stage would add to what the next one needs. For the same reason a worker holds no kept
    table but the one of the task that runs."""

    @functools.wraps(task)
    def run(batches: Iterator) -> Iterator:
        forget_tables(table)
        try:
            yield from task(batches)
        finally:
            give_back()

    return run
