import datetime

from firmlens.plans.tables import nested_pages
from firmlens.session import parallelism


def test_few_companies_files_are_walked_by_all_tasks(spark, tmp_path):
    """Companies in one small file: their pages are still dealt to every task, none of them lost or repeated."""
    spark.createDataFrame([(0, "SPAIN")], "n_nationkey int, n_name string").write.parquet(str(tmp_path / "nation.parquet"))
    rows = [(i, f"c{i}", 0, 1.0, "A") for i in range(400)]
    customer = spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    customer.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    order = spark.createDataFrame([(1, datetime.date(1999, 1, 1))], "o_custkey long, o_orderdate date")
    order.write.parquet(str(tmp_path / "orders.parquet"))
    pages = nested_pages(spark, str(tmp_path))
    sizes = [n for n in pages.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    assert sum(sizes) == 400 and len(sizes) == parallelism(spark)
    assert max(sizes) < 100
