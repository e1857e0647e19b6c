import math
import os
import threading
from multiprocessing.pool import ThreadPool

from pyspark.sql import functions as F, types as T

from firmlens import session
from firmlens.sources import pages, tables


def test_csv_round_trip_drops_index_and_nan(spark, tmp_path):
    df = spark.createDataFrame([(0, "a", 1.5), (1, None, math.nan)], "row int, s string, x double")
    tables.write_clean(df, str(tmp_path / "t"))
    schema = T.StructType([T.StructField("s", T.StringType()), T.StructField("x", T.DoubleType())])
    got = tables.read_clean(spark, str(tmp_path / "t"), schema).collect()
    assert sorted(map(tuple, got), key=str) == [("a", 1.5), (None, None)]


def test_log_appends(spark, tmp_path):
    df = spark.createDataFrame([(7, "here")], "company_id int, place string")
    for _ in range(2):
        tables.append_log(df, str(tmp_path / "log"))
    assert [tuple(r) for r in tables.read_log(spark, str(tmp_path / "log")).collect()] == [("7", "here")] * 2


def test_profile_page(spark):
    html = (
        '<h1 class="name">\nAcme </h1><div class="description"><time>Mar 2014</time></div>'
        '<div class="field employees"><b><a href="#">11-50 people</a></b></div>'
        '<a class="field-value-link" href="/x">Private</a><span class="highlight">Bilbao Basque Country</span>'
    )
    df = spark.createDataFrame([(1, html), (2, "<p>nothing</p>")], "page_id long, html string")
    got = pages.extract_page_fields(df).orderBy("page_id").collect()
    assert got[0].asDict() == {
        "page_id": 1, "name": "\nAcme", "launch_year": "2014", "employees": "11-50", "ownership": "Private",
        "location": "Bilbao", "ranking": None,
    }
    assert set(got[1].asDict().values()) == {2, None}


def test_nan_to_null(spark):
    df = spark.createDataFrame([(math.nan, 1)], "x double, i int")
    assert tables.nan_to_null(df).select(F.col("x").isNull()).first()[0]


def test_all_profile_fields_and_inner_tags(spark):
    html = '<h1><b>A</b>cme</h1><time>Jan 2001</time><div class="ranking-section-container">Dealroom.co signal <i>77</i></div>'
    got = pages.extract_page_fields(spark.createDataFrame([(html,)], "html string")).first()
    assert (got["name"], got["launch_year"], got["ranking"]) == ("Acme", "2001", "77")


def test_written_tables_go_when_work_is_done(spark):
    import os

    from firmlens.operators.quantiles import exact_quantiles
    from firmlens.session import scratch_path, shared_dir

    def folders():
        own = os.path.join(shared_dir(spark).removeprefix("file://"), f"firmlens-{spark.sparkContext.applicationId}")
        return set(os.listdir(own))

    scratch_path(spark, "x")
    before = folders()
    exact_quantiles(spark.range(50).selectExpr("id * 1.0D AS x"), ["x"], [0.5])
    assert folders() == before


def test_nested_elements():
    paths = {"a": (("div", "x"), ("a", None)), "b": (("div", "x y"),), "c": (("p", None),)}
    cases = {
        "": {},
        None: {},
        '<a>out</a><div id="1" class="z x"><div><a href="#">in <b>bold</b></a></div></div>': {"a": "in bold"},
        '<div class="y q x"><div>one</div><div>two</div></div>three': {"b": "onetwo"},
        '<div class="x y">open <p>para <i>it': {"b": "open para it", "c": "para it"},
        "<p>a</div></b>b<br>c<br/>d</p>e": {"c": "abcd"},
        '<p>x<script>if (a<b) "</p>"</script>y &amp; z</p>': {"c": "xy & z"},
        '<div class="x"></div><a>no</a><div class="x"><a>yes</a><a>later</a></div>': {"a": "yes"},
        '<div class="xy"><a>no</a></div><p a="<p>">q</p>': {"c": "q"},
    }
    for html, want in cases.items():
        assert pages.element_texts(html, paths) == want, html


def test_nested_fields_of_odd_tables(spark):
    df = spark.createDataFrame([(1, None, "n"), (2, "<h1> </h1>", "n"), (3, "<h1>A</h1>", "n"), (3, "<h1>A</h1>", "n")], "page_id long, html string, name_ string")
    got = [tuple(r) for r in pages.extract_nested_fields(df).select("page_id", "name", "ranking", "name_").orderBy("page_id").collect()]
    assert got == [(1, None, None, "n"), (2, None, None, "n"), (3, "A", None, "n"), (3, "A", None, "n")]
    assert pages.extract_nested_fields(df.where("false")).count() == 0


def test_temporary_leaves_the_tables_of_other_threads(spark):
    entered, written = threading.Event(), threading.Event()

    def passing():
        with session.temporary(spark):
            mine = session.settle(spark.range(3)).inputFiles()
            entered.set()
            written.wait(60)
        return mine

    with ThreadPool(1) as pool:
        gone = pool.apply_async(passing)
        assert entered.wait(60)
        kept = session.settle(spark.range(5))
        written.set()
        mine = gone.get()
    assert kept.count() == 5
    assert not any(os.path.exists(p.removeprefix("file:").rsplit("/", 1)[0]) for p in mine)
