"""Queries on sources, columns, joins and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from firmlens.functions import columns as C
from firmlens.functions.text import strip_words
from firmlens.operators import joins, profile
from firmlens.operators.quantiles import quartile_frame
from firmlens.plans.registry import QUERIES, query
from firmlens.plans.views import BOTH, EARLIER, LATER, companies, oracle, prepared, statements, table
from firmlens.session import parallelism, scratch_path, settle
from firmlens.sources import pages, tables

CUSTOMER = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)

# ---- sources and sinks ---------------------------------------------------------------------------


@query("read_declared_schema", "SELECT * FROM customer")
def read_declared_schema(spark, d):
    return tables.read_table(spark, f"{d}/customer.parquet", CUSTOMER)


@query("read_raw_csv", "SELECT * FROM customer")
def read_raw_csv(spark, d):
    path = scratch_path(spark, "raw")
    tables.write_clean(table(spark, d, "customer"), path)
    return tables.read_table(spark, path, CUSTOMER, "csv")


@query("read_clean_csv", oracle("SELECT * FROM stm", "stm"))
def read_clean_csv(spark, d):
    df = statements(spark, d)
    path = scratch_path(spark, "clean")
    index = F.monotonically_increasing_id().alias("row")
    tables.write_clean(df.select(index, *df.columns), path)
    return tables.read_clean(spark, path, df.schema)


@query("write_without_key", oracle("SELECT * EXCLUDE (company_id) FROM cmp", "cmp"))
def write_without_key(spark, d):
    df = companies(spark, d)
    path = scratch_path(spark, "nokey")
    tables.write_clean(df, path, "csv", key="company_id", with_key=False)
    return tables.read_clean(spark, path, df.drop("company_id").schema, index=None)


@query(
    "submission_log",
    oracle(
        "SELECT CAST(company_id AS VARCHAR) AS company_id, place FROM cmp "
        "UNION ALL SELECT CAST(s_suppkey AS VARCHAR), n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey",
        "cmp",
    ),
)
def submission_log(spark, d):
    path = scratch_path(spark, "log")
    tables.append_log(companies(spark, d), path)
    nation = table(spark, d, "nation")
    late = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    tables.append_log(late.select(F.col("s_suppkey").alias("company_id"), F.col("n_name").alias("place")), path)
    return tables.read_log(spark, path)


PAGE_RULES = {
    "heading": (r"(?s)<h1[^>]*>(.*?)</h1>", ("&amp;",)),
    "title": (r"(?s)<title>(.*?)</title>", ("%%%", "###", "***")),
    "lang": (r'<html lang="([a-z]+)"', ()),
    "host": (r"&copy; ([a-z.]+)", ("example.com",)),
    "launch_year": pages.PROFILE_RULES["launch_year"],
    "location": pages.PROFILE_RULES["location"],
}


def _page_field(name: str) -> str:
    pattern, words = PAGE_RULES[name]
    text = f"regexp_replace(regexp_extract(html, '{pattern}', 1), '<[^>]*>', '', 'g')"
    for w in words:
        text = f"replace({text}, '{w}', '')"
    return f"nullif(trim({text}), '') AS {name}"


@query("page_fields", f"SELECT page_id, url, {', '.join(map(_page_field, PAGE_RULES))} FROM pages")
def page_fields(spark, d):
    return pages.extract_page_fields(table(spark, d, "pages"), PAGE_RULES)


def profile_pages(spark, d):
    """Profile pages made from the companies, with every element that the rules look for."""
    month = F.element_at(F.array(*(F.lit(m) for m in pages.MONTHS)), F.col("company_id").cast("int") % 12 + 1)
    number = F.col("company_id").cast("string")
    parts = (
        '<h1 class="n">\n<b>', F.col("name"), "</b> Ltd</h1><time>", month, " ", (F.col("company_id") % 30 + 1990).cast("string"), "</time>",
        '<div class="field employees"><i><a href="#">', number, " people</a></i></div>",
        F.when(F.col("company_id") % 5 != 0, F.concat(F.lit('<a class="field-value-link" href="/x">'), F.col("place"), F.lit("</a>"))).otherwise(""),
        '<span class="highlight">', F.col("place"), " Basque Country</span>",
        '<div class="ranking-section-container">Dealroom.co signal ', number, "</div>",
    )
    html = F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts))
    return companies(spark, d).select("company_id", html.alias("html"))


@query(
    "profile_fields",
    oracle(
        "SELECT company_id, name || ' Ltd' AS name, (company_id % 30 + 1990)::VARCHAR AS launch_year, company_id::VARCHAR AS employees, "
        "CASE WHEN company_id % 5 <> 0 THEN place END AS ownership, place AS location, company_id::VARCHAR AS ranking FROM cmp",
        "cmp",
    ),
)
def profile_fields(spark, d):
    out = pages.extract_page_fields(profile_pages(spark, d))
    return out.withColumn("name", F.trim(F.regexp_replace("name", r"^\s+", "")))


def nested_pages(spark, d):
    """The same profiles as pages are written: attributes in any order, equal tags inside each other,
    tags left open, script text that looks like markup."""
    month = F.element_at(F.array(*(F.lit(m) for m in pages.MONTHS)), F.col("company_id").cast("int") % 12 + 1)
    number = F.col("company_id").cast("string")
    parts = (
        '<script>var t = "<h1>no</h1>";</script><time>1900</time><div><h1 id="t" class="big name"><b>', F.col("name"), "</b> Ltd</h1>",
        '<div data-x="1" class="wide description"><p>since <div><time datetime="x">', month, " ", (F.col("company_id") % 30 + 1990).cast("string"),
        '</time></div><p>unclosed</div><div id="e" class="employees big field"><div><a href="#">', number, " people</a></div></div>",
        F.when(F.col("company_id") % 5 != 0, F.concat(F.lit('<a href="/x" class="field-value-link">'), F.col("place"), F.lit("</a>"))).otherwise(""),
        '<span title="a>b" class="highlight">', F.col("place"), "<br> Basque Country</span>",
        '<div class="ranking-section-container"><div>Dealroom.co signal</div> <div><i>', number, "</div></div></div>",
    )
    html = F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts))
    # Companies are few bytes in few splits, their pages much work: they are dealt out before pages are made.
    dealt = companies(spark, d).repartition(parallelism(spark), "company_id")
    return dealt.select("company_id", html.alias("html"))


@query("profile_fields_nested", QUERIES["profile_fields"].sql)
def profile_fields_nested(spark, d):
    return pages.extract_nested_fields(nested_pages(spark, d))


# ---- columns and rows ----------------------------------------------------------------------------

BALANCE = ("fixed_assets", "current_assets", "total_assets", "equity", "noncurrent_liab", "current_liab")


@query(
    "select_groups",
    oracle(f"SELECT company_id, year, {', '.join(BALANCE)}, sales, ebitda, ebit FROM stm", "stm"),
)
def select_groups(spark, d):
    return C.select_groups(statements(spark, d), [("company_id", "year"), BALANCE, ("sales", "ebitda", "ebit", "equity")])


@query("drop_identity", oracle("SELECT * EXCLUDE (name, place, constitution_date) FROM cmp", "cmp"))
def drop_identity(spark, d):
    return C.drop_identity(companies(spark, d), ["name", "place", "constitution_date", "website", "tagline"])


@query(
    "numeric_columns",
    oracle("SELECT company_id, total_funding, last_funding, valuation, acq_class FROM cmp", "cmp"),
)
def numeric_columns(spark, d):
    df = companies(spark, d)
    return df.select(*C.cols_of(df, "numeric"))


@query(
    "text_columns",
    oracle("SELECT name, place, growth_stage, first_funding_txt, last_round FROM cmp", "cmp"),
)
def text_columns(spark, d):
    df = companies(spark, d)
    return df.select(*C.cols_of(df, "string"))


@query("columns_by_pattern", oracle("SELECT company_id, total_assets, total_liab_equity, equity, other_equity FROM stm", "stm"))
def columns_by_pattern(spark, d):
    df = statements(spark, d)
    return df.select("company_id", *C.cols_like(df, "^total|equity$"))


@query("columns_by_position", oracle("SELECT year, fixed_assets, current_assets, total_assets FROM stm", "stm"))
def columns_by_position(spark, d):
    df = statements(spark, d)
    return df.select(*C.cols_between(df, 1, 5))


@query(
    "dedup_columns",
    oracle(
        "SELECT stm.company_id, year, sales, name FROM stm JOIN cmp USING (company_id)",
        "stm",
        "cmp",
    ),
)
def dedup_columns(spark, d):
    s = statements(spark, d).select("company_id", "year", "sales").alias("s")
    c = companies(spark, d).select("company_id", "name").alias("c")
    both = s.join(c, F.col("s.company_id") == F.col("c.company_id")).select("s.*", "c.company_id", "c.name", "s.sales")
    return C.dedup_columns(both)


@query(
    "drop_null_columns",
    oracle(
        "SELECT * EXCLUDE (fixed_assets, current_assets, noncurrent_liab, current_liab, employees) FROM stm", "stm"
    ),
)
def drop_null_columns(spark, d):
    return C.drop_null_columns(settle(statements(spark, d)))


@query("drop_null_target", oracle("SELECT * FROM cmp WHERE valuation IS NOT NULL", "cmp"))
def drop_null_target(spark, d):
    return C.drop_null_rows(companies(spark, d), ["valuation"])


@query(
    "drop_incomplete_rows",
    oracle(
        "SELECT * FROM cmp WHERE name IS NOT NULL AND growth_stage IS NOT NULL AND constitution_date IS NOT NULL "
        "AND first_funding_txt IS NOT NULL AND last_round IS NOT NULL AND last_funding IS NOT NULL "
        "AND valuation IS NOT NULL",
        "cmp",
    ),
)
def drop_incomplete_rows(spark, d):
    return C.drop_null_rows(companies(spark, d))


SPARSE = ("growth_stage", "constitution_date", "first_funding_txt", "last_round", "last_funding", "valuation")


@query(
    "filter_null_fraction",
    oracle(
        f"SELECT {', '.join(SPARSE)} FROM cmp WHERE "
        f"({' + '.join(f'({c} IS NULL)::INT' for c in SPARSE)}) / CAST({len(SPARSE)} AS DOUBLE) < 0.5",
        "cmp",
    ),
)
def filter_null_fraction(spark, d):
    return C.filter_null_fraction(companies(spark, d).select(*SPARSE))


@query(
    "lookup_company",
    oracle("SELECT * FROM stm JOIN cmp USING (company_id) WHERE place = 'NATION_7' AND year = 2000 AND acq_class = 1", "stm", "cmp"),
)
def lookup_company(spark, d):
    df = statements(spark, d, (LATER, LATER)).join(companies(spark, d), "company_id")
    return C.lookup_company(df, place="NATION_7", year=LATER, acq_class=1)


@query(
    "latest_statement",
    oracle(
        "SELECT company_id, max(year) AS year, arg_max(sales, year) AS sales, arg_max(ebitda, year) AS ebitda "
        "FROM stm GROUP BY company_id",
        "stm",
    ),
)
def latest_statement(spark, d):
    latest = [F.max_by(c, "year").alias(c) for c in ("sales", "ebitda")]
    return statements(spark, d).groupBy("company_id").agg(F.max("year").alias("year"), *latest)


@query(
    "find_by_name",
    oracle("SELECT * FROM cmp WHERE place IN (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE')", "cmp"),
)
def find_by_name(spark, d):
    region = table(spark, d, "region").where(F.col("r_name") == "EUROPE")
    wanted = table(spark, d, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name")
    return C.find_by_name(companies(spark, d), wanted, "place")


@query(
    "null_pattern_counts",
    oracle(
        "p AS (SELECT company_id, max(CASE WHEN year = 1999 THEN employees END) AS e1, "
        "max(CASE WHEN year = 2000 THEN employees END) AS e2 FROM stm WHERE year IN (1999, 2000) GROUP BY company_id) "
        "SELECT count(*) FILTER (e1 IS NULL AND e2 IS NULL AND last_funding IS NULL) AS all_missing, "
        "count(*) FILTER (e1 IS NOT NULL AND e2 IS NULL) AS only_earlier, "
        "count(*) FILTER (last_funding IS NOT NULL AND e2 IS NULL) AS only_funding FROM p JOIN cmp USING (company_id)",
        "stm",
        "cmp",
    ),
)
def null_pattern_counts(spark, d):
    e1, e2 = f"employees_{EARLIER}", f"employees_{LATER}"
    wide = profile.pivot_year(statements(spark, d, BOTH), "company_id", "year", "employees", [EARLIER, LATER])
    wide = wide.join(companies(spark, d), "company_id")
    return C.null_pattern_counts(
        wide,
        {
            "all_missing": {e1: True, e2: True, "last_funding": True},
            "only_earlier": {e1: False, e2: True},
            "only_funding": {"last_funding": False, e2: True},
        },
    )


@query("rename_columns", oracle("SELECT * RENAME (place AS town, acq_class AS target) FROM cmp", "cmp"))
def rename_columns(spark, d):
    return C.rename(companies(spark, d), {"place": "town", "acq_class": "target"})


@query(
    "cast_columns",
    oracle(
        "SELECT company_id, year, TRY_CAST(turnover_txt AS DOUBLE) AS turnover_txt, CAST(employees AS BIGINT) AS employees FROM stm",
        "stm",
    ),
)
def cast_columns(spark, d):
    df = statements(spark, d).select("company_id", "year", "turnover_txt", "employees")
    return C.cast_columns(df, {"turnover_txt": "double", "employees": "bigint"})


@query(
    "strip_words",
    "SELECT o_orderkey, trim(replace(replace(o_orderpriority, '-', ''), 'NOT SPECIFIED', '')) AS priority FROM orders",
)
def strip_words_query(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", strip_words(F.col("o_orderpriority"), ["-", "NOT SPECIFIED"]).alias("priority")
    )


# ---- joins ---------------------------------------------------------------------------------------


@query(
    "join_statements",
    oracle(
        "a AS (SELECT company_id, year, fixed_assets, sales FROM stm WHERE fixed_assets IS NOT NULL), "
        "b AS (SELECT company_id, year, current_liab, sales FROM stm WHERE current_liab IS NOT NULL) "
        "SELECT company_id, year, fixed_assets, a.sales AS sales_x, current_liab, b.sales AS sales_y "
        "FROM a FULL OUTER JOIN b USING (company_id, year)",
        "stm",
    ),
)
def join_statements(spark, d):
    df = settle(statements(spark, d).select("company_id", "year", "fixed_assets", "current_liab", "sales"))
    a = C.drop_null_rows(df.select("company_id", "year", "fixed_assets", "sales"), ["fixed_assets"])
    b = C.drop_null_rows(df.select("company_id", "year", "current_liab", "sales"), ["current_liab"])
    return joins.join_statements(a, b)


@query(
    "join_company",
    oracle(
        "legal AS (SELECT company_id, name, place, constitution_date FROM cmp), "
        "funding AS (SELECT company_id, total_funding, last_round, growth_stage FROM cmp WHERE last_round IS NOT NULL), "
        "facts AS (SELECT company_id, year, sales, employees FROM stm) "
        "SELECT * FROM legal FULL OUTER JOIN funding USING (company_id) FULL OUTER JOIN facts USING (company_id)",
        "stm",
        "cmp",
    ),
)
def join_company(spark, d):
    c = settle(companies(spark, d))
    legal = c.select("company_id", "name", "place", "constitution_date")
    funding = C.drop_null_rows(c.select("company_id", "total_funding", "last_round", "growth_stage"), ["last_round"])
    facts = settle(statements(spark, d).select("company_id", "year", "sales", "employees"))
    return joins.join_company(legal, funding, facts)


@query(
    "employees_with_funding",
    oracle(
        "p AS (SELECT company_id, max(CASE WHEN year = 1999 THEN employees END) AS employees_1999, "
        "max(CASE WHEN year = 2000 THEN employees END) AS employees_2000 FROM stm WHERE year IN (1999, 2000) GROUP BY company_id) "
        "SELECT company_id, employees_1999, employees_2000, last_funding FROM p JOIN cmp USING (company_id)",
        "stm",
        "cmp",
    ),
)
def employees_with_funding(spark, d):
    wide = profile.pivot_year(statements(spark, d, BOTH), "company_id", "year", "employees", [EARLIER, LATER])
    return wide.join(companies(spark, d).select("company_id", "last_funding"), "company_id", "inner")


@query(
    "attach_year",
    oracle("SELECT o_orderkey, o_custkey, year, sales FROM orders LEFT JOIN (SELECT company_id, year, sales FROM stm) s "
           "ON o_custkey = company_id AND year(o_orderdate) = year", "stm"),
)
def attach_year(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_custkey").alias("company_id"), F.year("o_orderdate").alias("order_year")
    )
    stm = statements(spark, d).select("company_id", "year", F.col("year").alias("order_year"), "sales")
    return joins.attach_by_key(orders, stm, ["company_id", "order_year"], ["year", "sales"]).drop("company_id", "order_year")


# ---- profiles ------------------------------------------------------------------------------------


@query(
    "companies_by_place",
    oracle(
        "SELECT place, CAST(trunc(count(company_id) / CAST((SELECT count(DISTINCT year) FROM stm) AS DOUBLE)) AS INTEGER) AS companies "
        "FROM stm JOIN cmp USING (company_id) GROUP BY place",
        "stm",
        "cmp",
    ),
)
def companies_by_place(spark, d):
    years = statements(spark, d).select("year").distinct().count()
    rows = statements(spark, d).select("company_id").join(companies(spark, d).select("company_id", "place"), "company_id")
    return profile.companies_by_place(rows, years)


@query(
    "distinct_companies_by_place",
    oracle(
        "SELECT place, count(DISTINCT company_id) AS companies FROM stm JOIN cmp USING (company_id) GROUP BY place", "stm", "cmp"
    ),
)
def distinct_companies_by_place(spark, d):
    rows = statements(spark, d).select("company_id").join(companies(spark, d).select("company_id", "place"), "company_id")
    return profile.distinct_companies_by_place(rows)


@query("value_counts_stage", oracle("SELECT growth_stage, count(*) AS n FROM cmp WHERE growth_stage IS NOT NULL GROUP BY 1", "cmp"))
def value_counts_stage(spark, d):
    return profile.value_counts(companies(spark, d), "growth_stage")


@query(
    "value_counts_named",
    oracle("SELECT growth_stage, count(last_funding) AS n FROM cmp WHERE growth_stage IS NOT NULL GROUP BY 1", "cmp"),
)
def value_counts_named(spark, d):
    return profile.value_counts(companies(spark, d), "growth_stage", counted="last_funding")


@query("value_counts_scaled", oracle("SELECT acq_class, 2 * count(*) AS n FROM cmp GROUP BY 1", "cmp"))
def value_counts_scaled(spark, d):
    return profile.value_counts(companies(spark, d), "acq_class", scale=2)


@query("value_counts_events", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts_events(spark, d):
    return profile.value_counts(table(spark, d, "events"), "event_type")


STM_COLUMNS = (
    "company_id", "year", "fixed_assets", "current_assets", "total_assets", "total_liab_equity", "subscribed",
    "other_equity", "equity", "noncurrent_liab", "current_liab", "sales", "debt", "taxes", "inventory", "ebitda",
    "ebit", "amort", "payables", "employees", "turnover_txt",
)


@query(
    "null_profile",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, count(*) FILTER ({c} IS NULL) AS missing, "
            f"count(*) FILTER ({c} IS NULL) / CAST(count(*) AS DOUBLE) AS fraction FROM stm"
            for c in STM_COLUMNS
        ),
        "stm",
    ),
)
def null_profile(spark, d):
    return profile.null_profile(statements(spark, d))


@query(
    "total_missing",
    oracle("SELECT CAST(" + " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in STM_COLUMNS) + " AS BIGINT) AS missing FROM stm", "stm"),
)
def total_missing(spark, d):
    return profile.total_missing(statements(spark, d))


@query("count_sentinel", oracle("SELECT count(*) FILTER (turnover_txt = 'n.s.') AS cells FROM stm", "stm"))
def count_sentinel(spark, d):
    return profile.count_sentinel(statements(spark, d), "n.s.")


@query(
    "missing_min",
    oracle(
        "SELECT count(*) FILTER (current_liab IS NULL) AS missing_rows, 21 AS n_columns, min(current_liab) AS min FROM stm",
        "stm",
    ),
)
def missing_min(spark, d):
    return profile.missing_min(statements(spark, d), "current_liab")


DESCRIBED = ("fixed_assets", "current_liab", "sales", "ebitda", "employees")


def _rounded(df, digits, *names):
    return df.withColumns({n: F.round(n, digits) for n in names})


@query(
    "describe",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
            f"min({c}) AS min, max({c}) AS max, round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median, "
            f"round(quantile_cont({c}, 0.75), 6) AS q3 FROM stm"
            for c in DESCRIBED
        ),
        "stm",
    ),
)
def describe(spark, d):
    # Quartiles of amounts in cents end after six digits, so no rounding falls on a tie.
    return _rounded(_rounded(profile.describe(statements(spark, d), DESCRIBED), 4, "mean", "std"), 6, "q1", "median", "q3")


@query(
    "table_shape",
    oracle("SELECT count(*) AS rows, 21 AS columns, count(DISTINCT company_id) AS companies FROM stm", "stm"),
)
def table_shape(spark, d):
    return profile.table_shape(statements(spark, d), "company_id")


@query(
    "quartiles",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q1, "
            f"round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q3, max({c}) AS max, "
            f"round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 6) AS iqr FROM prep"
            for c in ("fixed_assets", "current_assets", "turnover", "working_capital")
        ),
        "prep",
    ),
)
def quartiles(spark, d):
    df = quartile_frame(prepared(spark, d), ["fixed_assets", "current_assets", "turnover", "working_capital"])
    return _rounded(df, 6, "q1", "median", "q3", "iqr")


CORRELATED = ("fixed_assets", "current_liab", "sales", "debt", "employees", "taxes")


@query(
    "corr_matrix",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS corr FROM stm" for a in CORRELATED for b in CORRELATED
        ),
        "stm",
    ),
)
def corr_matrix(spark, d):
    return _rounded(profile.corr_matrix(statements(spark, d), CORRELATED), 8, "corr")


@query(
    "corr_with_target",
    oracle(
        "c AS ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS variable, corr({c}, sales) AS corr FROM stm"
            for c in STM_COLUMNS
            if c not in ("company_id", "year", "sales", "turnover_txt")
        )
        + ") SELECT variable, round(corr, 8) AS corr FROM c ORDER BY c.corr DESC, variable LIMIT 10",
        "stm",
    ),
)
def corr_with_target(spark, d):
    df = statements(spark, d).drop("company_id")
    return _rounded(profile.corr_with(df, "sales", top=10), 8, "corr")


def _reconcile_sql(name: str, left: str, right: str) -> str:
    return (
        f"SELECT '{name}' AS rule, count(*) FILTER ({left} = {right}) AS agree, "
        f"count(*) FILTER ({left} <> {right}) AS differ, count(*) FILTER (({left} = {right}) IS NULL) AS unknown FROM stm"
    )


@query(
    "reconcile",
    oracle(
        " UNION ALL ".join(
            [
                _reconcile_sql("assets", "round_even(total_assets, 0)", "round_even(fixed_assets + current_assets, 0)"),
                _reconcile_sql("equity", "equity", "subscribed + other_equity"),
                _reconcile_sql("balance", "round_even(total_assets, 0)", "round_even(total_liab_equity, 0)"),
                _reconcile_sql("working_capital", "round_even(current_assets - current_liab, 2)", "round_even(noncurrent_liab, 2)"),
            ]
        ),
        "stm",
    ),
)
def reconcile(spark, d):
    c = F.col
    rules = {
        "assets": (F.bround("total_assets", 0), F.bround(c("fixed_assets") + c("current_assets"), 0)),
        "equity": (c("equity"), c("subscribed") + c("other_equity")),
        "balance": (F.bround("total_assets", 0), F.bround("total_liab_equity", 0)),
        "working_capital": (F.bround(c("current_assets") - c("current_liab"), 2), F.bround("noncurrent_liab", 2)),
    }
    return profile.reconcile(statements(spark, d), rules)


@query(
    "first_violation",
    oracle(
        "SELECT company_id, year, equity, subscribed, other_equity FROM stm "
        "WHERE equity <> subscribed + other_equity ORDER BY company_id, year LIMIT 1",
        "stm",
    ),
)
def first_violation(spark, d):
    df = statements(spark, d).select("company_id", "year", "equity", "subscribed", "other_equity")
    rule = (F.col("equity"), F.col("subscribed") + F.col("other_equity"))
    return profile.first_violation(df, rule, ["company_id", "year"])


@query(
    "group_mean",
    oracle(
        "SELECT growth_stage, round(avg(employees), 6) AS mean FROM stm JOIN cmp USING (company_id) "
        "WHERE growth_stage IS NOT NULL GROUP BY 1",
        "stm",
        "cmp",
    ),
)
def group_mean(spark, d):
    df = statements(spark, d).join(companies(spark, d), "company_id")
    return _rounded(profile.group_mean(df, "growth_stage", "employees"), 6, "mean")


@query(
    "filtered_mean",
    oracle("SELECT round(avg(valuation) FILTER (total_funding = 0), 6) AS mean, count(*) FILTER (total_funding = 0) AS n FROM cmp", "cmp"),
)
def filtered_mean(spark, d):
    return _rounded(profile.filtered_agg(companies(spark, d), F.col("total_funding") == 0, "valuation"), 6, "mean")


@query(
    "pivot_year",
    oracle(
        "SELECT company_id, max(CASE WHEN year = 1999 THEN sales END) AS sales_1999, "
        "max(CASE WHEN year = 2000 THEN sales END) AS sales_2000 FROM stm WHERE year IN (1999, 2000) GROUP BY company_id",
        "stm",
    ),
)
def pivot_year(spark, d):
    return profile.pivot_year(statements(spark, d, BOTH), "company_id", "year", "sales", [EARLIER, LATER])


EXTREME = ("sales", "ebitda", "fixed_assets", "current_liab")


@query(
    "extremes",
    oracle(
        "l AS ("
        + " UNION ALL ".join(f"SELECT '{c}' AS variable, {c} AS value, company_id, name, year FROM stm JOIN cmp USING (company_id)" for c in EXTREME)
        + "), k AS (SELECT * FROM l WHERE value IS NOT NULL), "
        "r AS (SELECT *, 'top' AS side, row_number() OVER (PARTITION BY variable ORDER BY value DESC, company_id, name, year) AS rank FROM k "
        "UNION ALL SELECT *, 'bottom', row_number() OVER (PARTITION BY variable ORDER BY value, company_id, name, year) FROM k) "
        "SELECT company_id, name, year, variable, side, value, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 6",
        "stm",
        "cmp",
    ),
)
def extremes(spark, d):
    df = statements(spark, d).join(companies(spark, d).select("company_id", "name"), "company_id")
    return profile.extremes(df, EXTREME)


@query(
    "head_of_profile",
    oracle(
        "SELECT growth_stage, count(*) AS n FROM cmp WHERE growth_stage IS NOT NULL GROUP BY 1 ORDER BY n DESC, growth_stage LIMIT 3",
        "cmp",
    ),
)
def head_of_profile(spark, d):
    return profile.value_counts(companies(spark, d), "growth_stage").orderBy(F.desc("n"), "growth_stage").limit(3)
