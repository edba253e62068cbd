import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gleanery.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "gleanery-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def evaluate(spark):
    """Apply a Column function to many inputs in one job, results in input order."""

    def run(function, inputs, type_name="string"):
        rows = [(i, *(value if isinstance(value, tuple) else (value,))) for i, value in enumerate(inputs)]
        width = len(rows[0]) - 1
        types = type_name if isinstance(type_name, tuple) else (type_name,) * width
        names = [f"a{i}" for i in range(width)]
        schema = "i int, " + ", ".join(f"{n} {t}" for n, t in zip(names, types))
        frame = spark.createDataFrame(rows, schema)
        out = frame.select("i", function(*[frame[n] for n in names]).alias("r")).collect()
        return [row.r for row in sorted(out, key=lambda row: row.i)]

    return run


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
