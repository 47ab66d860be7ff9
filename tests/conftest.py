import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master(f"local[{os.environ.get('TEST_CPUS', '4')}]")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp")).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in sorted(os.listdir(f"{DATA}/sf0.001")):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{DATA}/sf0.001/{f}'")
    return con


def rows_of(frame):
    """Rows as sorted tuples of text, columns by name, floats to 9 digits."""

    def show(v):
        if v is None or v != v:
            return ""
        if isinstance(v, bool) or type(v).__name__.startswith("bool"):
            return str(bool(v))
        try:
            return str(round(float(v), 9) + 0.0)
        except (TypeError, ValueError):
            return str(v)

    cols = sorted(frame.columns)
    return sorted(tuple(show(v) for v in r) for r in frame[cols].itertuples(index=False))
