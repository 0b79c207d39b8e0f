import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{root}/checkpoints").config("spark.sql.warehouse.dir", f"{root}/warehouse").config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def same_rows(con, frame, sql):
    """Rows that only the SQL has, and rows that only the frame has."""
    mine = frame.toArrow()
    con.register("mine", mine)
    con.execute(f"CREATE OR REPLACE TEMP TABLE wanted AS {sql}")
    names = sorted(r[0] for r in con.execute("DESCRIBE wanted").fetchall())
    assert names == sorted(mine.column_names)
    cols = ", ".join(f'"{c}"' for c in names)
    one = con.execute(f"SELECT count(*) FROM (SELECT {cols} FROM wanted EXCEPT ALL SELECT {cols} FROM mine)").fetchall()[0][0]
    two = con.execute(f"SELECT count(*) FROM (SELECT {cols} FROM mine EXCEPT ALL SELECT {cols} FROM wanted)").fetchall()[0][0]
    con.unregister("mine")
    return one, two
