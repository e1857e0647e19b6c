"""Plans: filters reach the scan, few columns are read, nothing is a cartesian product."""

import pytest
from pyspark.sql import functions as F

from firmlens.plans import QUERIES
from firmlens.plans.views import BOTH, companies, statements


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_range_is_pushed_and_columns_are_pruned(spark, sf_dir):
    text = plan(statements(spark, sf_dir, BOTH).select("company_id", "year", "sales"))
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert "GreaterThanOrEqual(o_orderdate" not in plan(statements(spark, sf_dir))
    assert "l_tax" not in text and "l_quantity" not in text


def test_company_filter_is_pushed(spark, sf_dir):
    text = plan(companies(spark, sf_dir).where(F.col("company_id") == 7).select("name", "place"))
    assert "EqualTo(c_custkey,7)" in text


@pytest.mark.parametrize("name", ["cash_flow_change", "join_company", "fuse_years_weighted", "extremes", "stratified_folds", "balance_long"])
def test_no_cartesian_product(spark, sf_dir, name):
    text = plan(QUERIES[name].run(spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_extremes_limit_rows_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan(QUERIES["extremes"].run(spark, sf_dir))


@pytest.mark.parametrize("parts", [1, 17])
def test_results_do_not_depend_on_partitions(spark, sf_dir, parts):
    from firmlens.operators.fusion import fuse_years_pct

    df = statements(spark, sf_dir).select("company_id", "year", "sales", "ebitda")
    whole = sorted(map(tuple, fuse_years_pct(df, "company_id", "year", 2000, 1999).collect()))
    again = sorted(map(tuple, fuse_years_pct(df.repartition(parts), "company_id", "year", 2000, 1999).collect()))
    assert whole == again


def test_equal_points_are_cut_before_the_shuffle(spark):
    from pyspark.sql import Window

    df = spark.range(100).select("id", F.array((F.col("id") % 3).cast("double")).alias("x"))
    order = Window.partitionBy("x").orderBy("id")
    assert "WindowGroupLimit" in plan(df.withColumn("n", F.row_number().over(order)).where("n <= 6").drop("n"))
