from pyspark.sql import functions as F

from firmlens.functions import columns as C
from firmlens.functions.text import decode_class, strip_words


def test_null_fraction_is_strict_and_runs_before_the_sentinel(spark):
    from firmlens.operators.cleaning import null_sentinel

    rows = [("r1", None, "1", "2"), ("r2", None, None, "2"), (None, None, None, "2"), ("n.s.", "n.s.", "1", "2")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    kept = C.filter_null_fraction(df)
    assert sorted(r["a"] for r in kept.collect()) == ["n.s.", "r1"]
    cleaned = null_sentinel(kept.where("a = 'n.s.'")).first()
    assert cleaned.asDict() == {"a": None, "b": None, "c": 1.0, "d": 2.0}


def test_drop_identity_ignores_absent_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert C.drop_identity(df, ["b", "website"]).columns == ["a"]


def test_dedup_columns_keeps_first(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("x", "y", "x")
    out = C.dedup_columns(df)
    assert out.columns == ["x", "y"]
    assert tuple(out.first()) == (1, 2)


def test_names_with_dots_and_accents(spark):
    df = spark.createDataFrame([(None, 1.0)], "`Dotaciones amort. (%)` double, `Número` double")
    assert C.null_columns(df) == ["Dotaciones amort. (%)"]
    assert C.cols_like(df, "%") == ["Dotaciones amort. (%)"]


def test_find_by_name_unknown_is_empty(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "name string, v int")
    assert C.find_by_name(df, ["a"]).count() == 2
    assert C.find_by_name(df, ["zzz"]).count() == 0


def test_cast_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("1.5",), ("x",)], "v string")
    assert [r[0] for r in C.cast_columns(df, {"v": "double"}).collect()] == [1.5, None]


def test_text_helpers(spark):
    df = spark.createDataFrame([("Mar 2019 people", 1), (None, 7)], "t string, c int")
    out = df.select(strip_words(F.col("t"), ["Mar", "people"]).alias("t"), decode_class(F.col("c")).alias("c")).collect()
    assert [tuple(r) for r in out] == [("2019", "partly acquired"), (None, None)]
