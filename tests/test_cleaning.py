import datetime as dt

from pyspark.sql import functions as F

from firmlens.operators import cleaning, fusion

BALANCE = (
    "total_assets double, fixed_assets double, current_assets double, total_liab_equity double, equity double, "
    "noncurrent_liab double, current_liab double"
)


def test_balance_identities(spark):
    rows = [
        (10.0, None, 4.0, 10.0, 4.0, None, None),
        (10.0, None, None, 10.0, 4.0, 1.0, None),
        (10.0, 3.0, None, None, 4.0, None, 2.0),
    ]
    out = cleaning.impute_balance(spark.createDataFrame(rows, BALANCE)).collect()
    assert (out[0]["fixed_assets"], out[0]["noncurrent_liab"], out[0]["current_liab"]) == (6.0, 0.0, 0.0)
    assert (out[1]["fixed_assets"], out[1]["current_assets"], out[1]["current_liab"]) == (None, None, 5.0)
    assert (out[2]["current_assets"], out[2]["noncurrent_liab"], out[2]["current_liab"]) == (7.0, 0.0, 2.0)


def test_funding_dates(spark):
    df = spark.createDataFrame([("jan/1900",), ("Mar/2019",), ("2018",), (None,), ("soon",)], "t string")
    got = [r[0] for r in df.select(cleaning.parse_funding_date(F.col("t"))).collect()]
    assert got == [dt.datetime(1900, 1, 1), dt.datetime(2019, 3, 1), dt.datetime(2018, 1, 1), dt.datetime(1900, 1, 1), None]


def test_fill_funding(spark):
    rows = [("1900-01-01", None, 0.0, None), ("1900-01-01", "seed", 5.0, None), ("2019-01-01", None, 0.0, 3.0)]
    df = spark.createDataFrame(rows, "first_funding_date string, last_round string, total_funding double, last_funding double")
    df = df.withColumn("first_funding_date", F.col("first_funding_date").cast("timestamp"))
    got = [(r["last_round"], r["last_funding"]) for r in cleaning.fill_funding(df).collect()]
    assert got == [("sin ronda", 0.0), ("seed", None), (None, 3.0)]


def test_group_mean_fill(spark):
    rows = [(1, "A", 2.0), (2, "A", 4.0), (3, "A", None), (4, "B", None), (5, None, 7.0), (6, None, None)]
    df = spark.createDataFrame(rows, "id int, g string, v double")
    keep = {r["id"]: r["v"] for r in cleaning.impute_group_mean(df, "g", "v").collect()}
    assert keep == {1: 2.0, 2: 4.0, 3: 3.0, 4: 30.0, 5: 7.0, 6: 30.0}
    lose = {r["id"]: r["v"] for r in cleaning.impute_group_mean(df, "g", "v", keep_null_group=False).collect()}
    assert lose[5] == 30.0


def test_year_fusion(spark):
    rows = [
        (1, 2021, 8.0, 8.0, 8.0, "a"),
        (1, 2020, 4.0, 0.0, None, "b"),
        (2, 2021, 1.0, 1.0, 1.0, "x"),
        (3, 2020, 1.0, 1.0, 1.0, "y"),
    ]
    df = spark.createDataFrame(rows, "company_id int, year int, u double, v double, w double, s string")
    mean = fusion.fuse_years_weighted(df, "company_id", "year", 2021, 2020).collect()
    assert [tuple(r) for r in mean] == [(1, 7.0, 0.0, None, "a")]
    pct = fusion.fuse_years_pct(df, "company_id", "year", 2021, 2020, ["w"]).collect()
    assert [tuple(r) for r in pct] == [(1, 100.0, 0.0, 8.0, "a")]
