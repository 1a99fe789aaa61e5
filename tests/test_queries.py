"""Every registered query against its SQL, on the whole smallest data set."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from eventmart.operators import flatten
from eventmart.sources import pos_api
from tests.compare import differences, oracle_connection
from workload.oracle import ORACLE
from workload.registry import FIRST_EXTRACT, QUERIES, SECOND_EXTRACT, Workspace

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= driver.queries().keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, oracle, name):
    frame = driver.queries()[name](spark, SF_DIR)
    assert differences(frame, oracle.sql(driver.oracle_sql()[name])) is None


def test_entry(spark):
    assert driver.entry(spark).columns == ["category_name", "units_sold", "revenue", "pct_of_total"]


def test_an_order_with_a_third_of_all_lines_becomes_bounded_documents(spark, tmp_path):
    from workload import mapping

    sf = Path(SF_DIR)
    lines = spark.read.parquet(str(sf / "lineitem.parquet"))
    key = lines.first()["l_orderkey"]
    hot = lines.limit(1).selectExpr("*", "explode(sequence(1, 3000)) as nth").withColumn("l_linenumber", F.col("nth").cast("int"))
    hot = hot.withColumn("l_orderkey", F.lit(key)).drop("nth")
    lines.filter(F.col("l_orderkey") != key).unionByName(hot).write.parquet(f"{tmp_path}/lineitem.parquet")
    (tmp_path / "orders.parquet").symlink_to(sf / "orders.parquet")
    documents = Workspace(spark, str(tmp_path)).documents()
    sizes = documents.select("id", F.size("line_items").alias("n")).collect()
    assert max(r.n for r in sizes) == mapping.LINES_A_DOCUMENT
    assert len({r.id for r in sizes}) == len(sizes)
    assert sum(r.n for r in sizes if r.id.split("/")[0] == f"ORD-{key}") == 3_000
    kept = flatten.explode_lines(documents).select(F.regexp_extract("line.uid", r"(\d+)-(\d+)$", 1).alias("key"), "line.uid")
    wanted = spark.read.parquet(f"{tmp_path}/lineitem.parquet").selectExpr("concat_ws('-', 'line', l_orderkey, l_linenumber) as uid")
    assert sorted(r.uid for r in kept.collect()) == sorted(r.uid for r in wanted.collect())


def test_a_replay_reads_only_its_extracts(spark):
    ws = Workspace.of(spark, SF_DIR)
    path = f"{ws.archived}/orders"
    everything = pos_api.read_order_pages(spark, path)
    one = pos_api.read_order_pages(spark, path, since=FIRST_EXTRACT, until=FIRST_EXTRACT)
    assert "PartitionFilters: [isnotnull(extracted_date" in one._jdf.queryExecution().toString()
    assert [r.extracted_at.hour for r in one.select("extracted_at").distinct().collect()] == [FIRST_EXTRACT.hour]
    later = pos_api.read_order_pages(spark, path, since=SECOND_EXTRACT)
    assert one.count() + later.count() == everything.count()
