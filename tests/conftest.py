import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="spark-")).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def compare(spark):
    """Runs a query and its SQL on the same tables and compares rows, whatever their order."""
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    for p in sorted(Path(SF).glob("*.parquet")):
        con.sql(f"create view {p.stem} as select * from '{p}'")

    def tidy(df):
        df = df[sorted(df.columns)].astype(object).where(lambda x: x.notna(), None)
        df = df.map(lambda v: round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) or type(v).__name__ in ("Decimal", "int64", "float64", "int32") else str(v))
        return df.sort_values(list(df.columns), key=lambda c: c.astype(str)).reset_index(drop=True)

    def run(query, sql):
        a, b = tidy(query(spark, SF).toPandas()), tidy(con.sql(sql).df())
        pd.testing.assert_frame_equal(a, b, check_dtype=False, atol=1e-5)
        return len(a)

    return run
