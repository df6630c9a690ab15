import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]
# Python workers import the functions that tests hand to Spark from here.
os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(HERE), HERE, os.environ.get("PYTHONPATH", "")])

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{shared}")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def duck(small):
    import duckdb

    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return con


def plain(v):
    return None if v is None or v != v else v.item() if hasattr(v, "item") else v


def rows_of(frame):
    """Rows of a pandas frame, columns by name, in an order of their own; nulls alike."""
    cols = sorted(frame.columns)
    return cols, sorted(repr(tuple(plain(v) for v in row)) for row in frame[cols].astype(object).itertuples(index=False, name=None))
