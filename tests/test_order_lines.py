"""Order lines are put together with few shuffles, and their amounts are spelled from cents."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import r2
from ledgerloom.plans.queries import Tables
from ledgerloom.sources import star_schema

SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture
def only_suppliers_are_small(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3200")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_stay_by_order(spark, only_suppliers_are_small):
    documents = star_schema.order_documents(Tables(spark, SMALLEST).notes_of_orders)
    plan = documents._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey" in plan and "hashpartitioning(TipoDocumento" not in plan


def test_customers_meet_orders_before_lines_do(spark, only_suppliers_are_small):
    plan = Tables(spark, SMALLEST).raw._jdf.queryExecution().optimizedPlan().toString()
    depth = {name: next(i for i, line in enumerate(plan.splitlines()) if name in line) for name in ("Join Inner, (l_orderkey", "Join Inner, (o_custkey", "Join Inner, (l_partkey")}
    # The join with orders stands above the other two.
    assert depth["Join Inner, (l_orderkey"] < min(depth["Join Inner, (o_custkey"], depth["Join Inner, (l_partkey"])


def test_cents_are_those_of_rounding(spark):
    values = [0.0, -0.0, 0.004, 0.005, -0.005, -0.004, 1.005, 2.675, -2.675, 0.125, -0.125, 99.995, 1e6 + 0.375, 123456789.125, -123456789.125, 0.999, 9.9950000001]
    rows = spark.createDataFrame([(v,) for v in [*values, *(k * 0.0137 - 7 for k in range(2000))]], "x double")
    other = rows.select(star_schema._money(F.col("x")).alias("new"), r2(F.col("x")).cast("decimal(18,2)").cast("string").alias("old"))
    assert other.filter("not (new <=> old)").collect() == []
