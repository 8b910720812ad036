"""Every registered query against its SQL counterpart."""

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as registry
from headway.functions.times import iso_time
from headway.plans.oracle import ORACLE
from headway.plans.queries import QUERIES
from tests.compare import assert_same, connect
from tests.conftest import DATA, TABLES


@pytest.fixture(scope="module")
def con():
    return connect(DATA, TABLES)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, con, name):
    rows = assert_same(registry.queries()[name](spark, DATA), con, registry.oracle_sql()[name])
    assert rows > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_times_are_iso(spark):
    runs = registry.queries()["flow_summary"](spark, DATA)
    assert runs.where("run_no = 0").first()["completed_at"][10] == "T"
    fixed = spark.range(1).select(iso_time(F.lit(1704067201)).alias("t")).first()
    assert fixed["t"] == "2024-01-01T00:00:01"


def test_entry(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("kind", ["vehicles", "trips"])
def test_messages_do_not_depend_on_partitions(spark, tmp_path, kind):
    """As many messages from one file and few partitions as from many."""
    from headway.plans import fixtures as fix

    found = []
    for files, partitions in ((1, "8"), (16, "200")):
        folder = tmp_path / str(files)
        for name in ("events", "orders", "lineitem"):
            spark.read.parquet(f"{DATA}/{name}.parquet").repartition(files).write.parquet(f"{folder}/{name}.parquet")
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        raw = getattr(fix, f"raw_{kind}")(spark, str(folder)).select("path", "length")
        found.append(sorted(map(tuple, raw.collect())))
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] and len({path for path, _ in found[0]}) == len(found[0])
