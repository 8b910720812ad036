"""The registered queries where one key holds a third of all rows.

One order holds a third of the lines, one supplier too, and one event comes as many
copies, so one feed, route, event kind and trip id are hot as well.
"""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from headway.operators.vehicles import with_stop_names
from headway.plans import fixtures as fix
from tests.compare import assert_same, connect
from tests.conftest import DATA, TABLES

HOT = {
    "events": """
        SELECT * FROM '{0}/events.parquet' UNION ALL
        SELECT e.* FROM '{0}/events.parquet' e, range(500) WHERE event_id = 138""",
    "lineitem": """
        SELECT * FROM '{0}/lineitem.parquet' UNION ALL
        SELECT * REPLACE (100 AS l_orderkey, 6 AS l_suppkey) FROM '{0}/lineitem.parquet'
        WHERE l_linenumber <= 4""",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = connect(DATA, TABLES)
    for name in TABLES:
        rows = HOT.get(name, "SELECT * FROM '{0}/" + name + ".parquet'").format(DATA)
        con.execute(f"COPY ({rows}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder, connect(folder, TABLES)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_hot_keys(spark, skewed, name):
    folder, con = skewed
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large
    try:
        assert_same(registry.queries()[name](spark, folder), con, registry.oracle_sql()[name])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def joined_lines(spark, folder):
    return fix.trip_lines(spark, folder)


def named_stops(spark, folder):
    lines = fix.table(spark, folder, "lineitem")
    stop_id = F.concat(F.col("l_suppkey").cast("string"), F.lit("N"))
    return with_stop_names(lines.withColumn("stop_id", stop_id), fix.stops(spark, folder))


@pytest.mark.parametrize("build", [joined_lines, named_stops])
def test_hot_join_key_is_split(spark, tmp_path, build):
    """Adaptive execution divides the partition of the hot key among tasks."""
    source = "/root/testdata/sf0.01"
    for name in ("orders", "supplier"):
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    hot = F.col("l_linenumber") <= 2
    lines = spark.read.parquet(f"{source}/lineitem.parquet").withColumns(
        {
            "l_orderkey": F.when(hot, 100).otherwise(F.col("l_orderkey")),
            "l_suppkey": F.when(hot, 6).otherwise(F.col("l_suppkey")),
        }
    )
    lines.repartition(8).write.parquet(f"{tmp_path}/lineitem.parquet")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = build(spark, str(tmp_path))
        used = rows.select(F.hash(*rows.columns).alias("h")).agg(F.max("h"))
        used.collect()
        assert "skew=true" in used._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
