import os
import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


DATA = "/root/testdata/sf0.001"
T0 = datetime(2031, 1, 1, tzinfo=timezone.utc)


def at(minute: int) -> datetime:
    return T0 + timedelta(minutes=minute)


class Make:
    """Small jagged tables; each row is a block."""

    def __init__(self, spark):
        from nestra import schema

        self.spark, self.schema = spark, schema

    def _rows(self, rows, ddl, more):
        from pyspark.sql import functions as F
        from pyspark.sql.types import StructType

        names = StructType.fromDDL(ddl).fieldNames()
        df = self.spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ddl)
        for n in more:
            df = df.withColumn(n, F.lit("clash"))
        return df

    def particles(self, *rows, more=()):
        return self._rows([{"block_no": 0, "run_no": 1, "ingested_at": at(0)} | r for r in rows], self.schema.PARTICLES, more)

    def hits(self, *rows, more=()):
        return self._rows([{"block_no": 0, "run_no": 1, "ingested_at": at(0)} | r for r in rows], self.schema.CALO_HITS, more)

    def tracks(self, *rows, more=()):
        return self._rows([{"block_no": 0, "run_no": 1, "ingested_at": at(0)} | r for r in rows], self.schema.TRACKS, more)

    def forest(self, event, *nodes, **cols):
        """nodes: (id, parent, inside)."""
        n = len(nodes)
        return {
            "event_id": event, "particle_id": [x[0] for x in nodes], "parent_id": [x[1] for x in nodes], "vx": [1300.0 if x[2] else 0.0 for x in nodes], "vy": [0.0] * n, "vz": [3100.0 if x[2] else 0.0 for x in nodes],
            "pdg_id": [22] * n, "is_primary": [True] * n, "energy": [1.0] * n, "time_ns": [1.0] * n, "px": [1.0] * n, "py": [1.0] * n, "pz": [1.0] * n,
        } | cols


@pytest.fixture
def make(spark):
    return Make(spark)


@pytest.fixture
def rows():
    def get(df, *cols):
        return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=lambda r: [(x is not None, str(type(x)), x) if not isinstance(x, (list, dict)) else (True, "", str(x)) for x in r])

    return get


@pytest.fixture(scope="session")
def against_sql():
    """Compare a query with its SQL on the small tables."""
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from read_parquet('{f}')")

    def form(v):
        if isinstance(v, (list, tuple)):
            return tuple(form(x) for x in v)
        return repr(v)

    def compare(spark, query, sql):
        df = query(spark, DATA)
        cols = sorted(df.columns)
        got = sorted(tuple(form(r[c]) for c in cols) for r in df.collect())
        res = con.execute(sql)
        names = [d[0] for d in res.description]
        assert sorted(names) == cols
        order = [names.index(c) for c in cols]
        assert got == sorted(tuple(form(r[k]) for k in order) for r in res.fetchall())

    return compare
