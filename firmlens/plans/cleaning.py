"""Queries on cleaning, imputation, measures, fusion, encoding and outliers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from firmlens.functions import measures as M
from firmlens.functions.columns import filter_null_fraction
from firmlens.functions.text import decode_class
from firmlens.operators import cleaning, encoding, fusion, imputation, outliers, splitting
from firmlens.plans.registry import query
from firmlens.plans.views import (
    BOTH,
    EARLIER,
    LATER,
    companies,
    cte,
    fuse_sql,
    oracle,
    prepared,
    statements,
)
from firmlens.session import settle

AS_OF = dt.datetime(2002, 6, 30, 12, 0, 0)


def rounded(df, digits, *names):
    return df.withColumns({n: F.round(n, digits) for n in names})


# ---- cleaning ------------------------------------------------------------------------------------


@query(
    "sentinel_to_null",
    oracle("SELECT company_id, year, TRY_CAST(nullif(turnover_txt, 'n.s.') AS DOUBLE) AS turnover_txt FROM stm", "stm"),
)
def sentinel_to_null(spark, d):
    return cleaning.null_sentinel(statements(spark, d).select("company_id", "year", "turnover_txt"))


PARTS = ("fixed_assets", "current_assets", "noncurrent_liab", "current_liab")


@query("balance_imputation", oracle(f"SELECT company_id, year, {', '.join(PARTS)} FROM bal", "bal"))
def balance_imputation(spark, d):
    return cleaning.impute_balance(statements(spark, d)).select("company_id", "year", *PARTS)


@query(
    "recompute_totals",
    oracle(
        "SELECT company_id, year, fixed_assets + current_assets AS total_assets, subscribed + other_equity AS equity, "
        "current_assets - current_liab AS working_capital FROM stm",
        "stm",
    ),
)
def recompute_totals(spark, d):
    df = cleaning.recompute_totals(statements(spark, d))
    return df.select("company_id", "year", "total_assets", "equity", "working_capital")


PREPARED = (
    "company_id", "year", "employees", "fixed_assets", "current_assets", "total_assets", "equity", "noncurrent_liab",
    "current_liab", "working_capital", "turnover",
)


@query(
    "prepared_statements",
    oracle(
        f"SELECT {', '.join(PREPARED)} FROM prep WHERE ({' + '.join(f'({c} IS NULL)::INT' for c in PREPARED)}) "
        f"/ CAST({len(PREPARED)} AS DOUBLE) < 0.5",
        "prep",
    ),
)
def prepared_statements(spark, d):
    df = prepared(spark, d).select(*PREPARED)
    return filter_null_fraction(df)


FIRST_DATE_SQL = (
    "CASE WHEN first_funding_txt IS NULL THEN TIMESTAMP '1900-01-01' "
    "WHEN contains(first_funding_txt, '/') THEN strptime(first_funding_txt, '%b/%Y') "
    "ELSE strptime(first_funding_txt, '%Y') END"
)


@query("parse_funding_date", oracle(f"SELECT company_id, {FIRST_DATE_SQL} AS first_funding_date FROM cmp", "cmp"))
def parse_funding_date(spark, d):
    parsed = cleaning.parse_funding_date(F.col("first_funding_txt"))
    return companies(spark, d).select("company_id", parsed.cast("timestamp_ntz").alias("first_funding_date"))


@query("parse_slash_date", "SELECT o_orderkey, o_orderdate AS parsed FROM orders")
def parse_slash_date(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    text = F.date_format("o_orderdate", "yyyy/MM/dd")
    return orders.select("o_orderkey", cleaning.parse_slash_date(text).cast("timestamp_ntz").alias("parsed"))


@query(
    "fill_funding",
    oracle(
        f"SELECT company_id, CASE WHEN {FIRST_DATE_SQL} = TIMESTAMP '1900-01-01' AND last_round IS NULL THEN 'sin ronda' "
        "ELSE last_round END AS last_round, CASE WHEN total_funding = 0 AND last_funding IS NULL THEN 0 ELSE last_funding END "
        "AS last_funding FROM cmp",
        "cmp",
    ),
)
def fill_funding(spark, d):
    df = companies(spark, d)
    df = df.withColumn("first_funding_date", cleaning.parse_funding_date(F.col("first_funding_txt")))
    return cleaning.fill_funding(df).select("company_id", "last_round", "last_funding")


def _group_fill_sql(known: str) -> str:
    return oracle(
        "j AS (SELECT company_id, year, growth_stage, employees FROM stm JOIN cmp USING (company_id)) "
        f"SELECT company_id, year, growth_stage, round(coalesce({known}, CASE WHEN growth_stage IS NOT NULL THEN "
        "avg(employees) OVER (PARTITION BY growth_stage) END, 30), 6) AS employees FROM j",
        "stm",
        "cmp",
    )


@query("group_mean_fill", _group_fill_sql("employees"))
def group_mean_fill(spark, d):
    df = statements(spark, d).join(companies(spark, d), "company_id")
    df = settle(df.select("company_id", "year", "growth_stage", "employees"))
    return rounded(cleaning.impute_group_mean(df, "growth_stage", "employees"), 6, "employees")


@query("group_mean_fill_strict", _group_fill_sql("CASE WHEN growth_stage IS NOT NULL THEN employees END"))
def group_mean_fill_strict(spark, d):
    df = statements(spark, d).join(companies(spark, d), "company_id")
    df = settle(df.select("company_id", "year", "growth_stage", "employees"))
    return rounded(cleaning.impute_group_mean(df, "growth_stage", "employees", keep_null_group=False), 6, "employees")


# ---- imputation ----------------------------------------------------------------------------------


def knn_impute_sql(source: str, key: str, cols, k: int = 10, others=()) -> str:
    """The neighbour imputation by brute force, every receiver against every row."""
    n = len(cols)
    seen = " + ".join(f"(a.{c} IS NOT NULL AND b.{c} IS NOT NULL)::INT" for c in cols)
    dist = " + ".join(f"coalesce((a.{c} - b.{c}) * (a.{c} - b.{c}), 0)" for c in cols)
    fills = []
    for c in cols:
        near = (
            f"SELECT q, v, dist FROM (SELECT a.{key} AS q, b.{key} AS b, b.{c} AS v, {seen} AS seen, "
            f"sqrt(CASE WHEN {seen} = {n} THEN {dist} ELSE ({dist}) / ({seen}) * {n} END) AS dist "
            f"FROM {source} a JOIN {source} b ON a.{c} IS NULL AND b.{c} IS NOT NULL AND {seen} > 0) "
            f"QUALIFY row_number() OVER (PARTITION BY q ORDER BY dist, b) <= {k}"
        )
        fills.append(
            f"fill_{c} AS (SELECT q, coalesce(avg(v) FILTER (dist = 0), "
            f"sum(v / nullif(dist, 0)) / sum(1 / nullif(dist, 0))) AS v FROM ({near}) GROUP BY q)"
        )
    out = ", ".join(f"coalesce(s.{c}, fill_{c}.v, (SELECT avg({c}) FROM {source})) AS {c}" for c in cols)
    joins = " ".join(f"LEFT JOIN fill_{c} ON fill_{c}.q = s.{key}" for c in cols)
    rest = "".join(f", s.{c}" for c in others)
    return f"WITH {', '.join(fills)} SELECT s.{key}{rest}, {out} FROM {source} s {joins}"


RESOURCES = (
    "fixed_assets", "amort", "current_assets", "total_assets", "equity", "noncurrent_liab", "current_liab",
    "total_liab_equity", "inventory", "payables",
)
TURNOVER = ("turnover", "fixed_assets", "sales")
STAFF = ("employees", "turnover")

cte(
    "cy",
    "SELECT company_id * 10000 + year AS company_year, * EXCLUDE (turnover_txt), "
    "TRY_CAST(nullif(turnover_txt, 'n.s.') AS DOUBLE) AS turnover FROM stm",
    "stm",
)
cte("imp1", knn_impute_sql("cy", "company_year", RESOURCES, others=("turnover", "sales", "employees")), "cy")
cte("imp2", knn_impute_sql("imp1", "company_year", TURNOVER, others=("current_liab", "employees")), "imp1")
cte("imp3", knn_impute_sql("imp2", "company_year", ("employees",), others=("turnover",)), "imp2")


def company_years(spark, d):
    """Statements with gaps and one key column."""
    df = cleaning.null_sentinel(statements(spark, d)).withColumnRenamed("turnover_txt", "turnover")
    return df.withColumn("company_year", F.col("company_id") * 10000 + F.col("year"))


def _round_sql(names, digits=4):
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in names)


@query("knn_imputation", oracle(f"SELECT company_year, amort, payables, inventory, {_round_sql(PARTS)} FROM imp1", "imp1"))
def knn_imputation(spark, d):
    df = imputation.impute_knn(company_years(spark, d).select("company_year", *RESOURCES), "company_year", RESOURCES)
    return rounded(df.select("company_year", "amort", "payables", "inventory", *PARTS), 4, *PARTS)


@query(
    "knn_imputation_groups",
    oracle(f"SELECT company_year, {_round_sql(('turnover', 'fixed_assets', 'current_liab'))} FROM imp2", "imp2"),
)
def knn_imputation_groups(spark, d):
    df = company_years(spark, d).select("company_year", *RESOURCES, "turnover", "sales")
    df = imputation.impute_groups(df, "company_year", [RESOURCES, TURNOVER])
    return rounded(df.select("company_year", "turnover", "fixed_assets", "current_liab"), 4, "turnover", "fixed_assets", "current_liab")


@query(
    "knn_imputation_remaining",
    oracle(
        knn_impute_sql("cy", "company_year", STAFF).replace(
            "SELECT s.company_year, ", "SELECT company_year, round(employees, 4) AS employees, round(turnover, 4) AS turnover FROM (SELECT s.company_year, "
        )[len("WITH ") :]
        + ")",
        "cy",
    ),
)
def knn_imputation_remaining(spark, d):
    df = company_years(spark, d).select("company_year", *STAFF)
    return rounded(imputation.impute_remaining(df, "company_year"), 4, *STAFF)


MEDIAN = ("last_funding", "total_funding")


@query(
    "median_imputation",
    oracle(
        "SELECT company_id, growth_stage, coalesce(last_funding, (SELECT quantile_cont(last_funding, 0.5) FROM cmp WHERE growth_stage IS NOT NULL)) "
        "AS last_funding, total_funding FROM cmp",
        "cmp",
    ),
)
def median_imputation(spark, d):
    df = settle(companies(spark, d).select("company_id", "growth_stage", *MEDIAN))
    known, unknown = df.where(F.col("growth_stage").isNotNull()), df.where(F.col("growth_stage").isNull())
    known, unknown = imputation.impute_median(known, unknown, MEDIAN)
    return known.unionByName(unknown)


@query("model_imputation")
def model_imputation(spark, d):
    """Known stages stay, missing ones get one of the known labels."""
    df = companies(spark, d).select("company_id", "growth_stage", "total_funding", "last_funding", "acq_class")
    return imputation.impute_by_model(
        df, ["growth_stage"], ["total_funding", "last_funding", "acq_class"], "company_id"
    )


# ---- measures ------------------------------------------------------------------------------------

RATIOS = tuple(M.RATIOS)


def _ratio_query(name: str, ratios):
    @query(name, oracle(f"SELECT company_id, year, {', '.join(ratios)} FROM rat", "rat"))
    def run(spark, d):
        return M.add_ratios(prepared(spark, d), ratios).select("company_id", "year", *ratios)


_ratio_query("debt_ratios", RATIOS[0:3])
_ratio_query("ebitda_ratios", RATIOS[3:5])
_ratio_query("sales_ratios", RATIOS[5:8])
_ratio_query("acid_test", RATIOS[8:9])
_ratio_query("collection_days", RATIOS[9:10])


@query(
    "ages",
    oracle(
        f"SELECT company_id, CAST(date_sub('day', constitution_date, TIMESTAMP '{AS_OF}') AS INTEGER) AS days_operating, "
        f"CAST(date_sub('day', {FIRST_DATE_SQL}, TIMESTAMP '{AS_OF}') AS INTEGER) AS days_since_round FROM cmp",
        "cmp",
    ),
)
def ages(spark, d):
    df = companies(spark, d).withColumn("last_funding_date", cleaning.parse_funding_date(F.col("first_funding_txt")))
    dates = {"days_operating": "constitution_date", "days_since_round": "last_funding_date"}
    return M.add_ages(df, AS_OF, dates).select("company_id", *dates)


cte(
    "fcf",
    "SELECT r.*, capex, current_change, ebit - taxes + amort - capex - current_change AS free_cash_flow FROM rat r "
    "LEFT JOIN (SELECT a.company_id, a.fixed_assets - (b.fixed_assets - b.amort) AS capex, "
    "a.current_assets - b.current_assets AS current_change FROM rat a JOIN rat b ON a.company_id = b.company_id "
    f"AND a.year = {LATER} AND b.year = {EARLIER}) USING (company_id) WHERE r.year IN ({EARLIER}, {LATER})",
    "rat",
)


@query("free_cash_flow", oracle("SELECT company_id, year, capex, current_change, free_cash_flow FROM fcf", "fcf"))
def free_cash_flow(spark, d):
    # Written once: the change between the years is joined back to the same rows.
    df = M.free_cash_flow(settle(prepared(spark, d, BOTH)), LATER, EARLIER)
    return df.select("company_id", "year", "capex", "current_change", "free_cash_flow")


CHANGE = ("sales", "ebitda", "total_assets", "ratio_debt_assets", "ratio_acid_test", "capex", "free_cash_flow")


@query("cash_flow_change", oracle(fuse_sql("fcf", CHANGE, kind="pct"), "fcf"))
def cash_flow_change(spark, d):
    """Free cash flow and the two-year change of every company."""
    df = settle(prepared(spark, d, BOTH)).transform(M.add_ratios).transform(M.free_cash_flow, LATER, EARLIER)
    df = df.select("company_id", "year", *CHANGE)
    return fusion.fuse_years_pct(df, "company_id", "year", LATER, EARLIER)


LOGGED = ("sales", "ebit", "fixed_assets", "working_capital")


@query(
    "log1p_columns",
    oracle(
        "SELECT company_id, year, " + ", ".join(f"CASE WHEN {c} > -1 THEN round(ln(1 + {c}), 9) END AS {c}" for c in LOGGED) + " FROM prep",
        "prep",
    ),
)
def log1p_columns(spark, d):
    df = prepared(spark, d).select("company_id", "year", *LOGGED)
    return rounded(M.log1p_all(df, LOGGED), 9, *LOGGED)


@query(
    "missing_to_zero",
    oracle("SELECT company_id, coalesce(last_funding, 0) AS last_funding, coalesce(valuation, 0) AS valuation FROM cmp", "cmp"),
)
def missing_to_zero(spark, d):
    df = companies(spark, d).select("company_id", "last_funding", "valuation")
    return M.nan_to_num(df, ["last_funding", "valuation"])


@query("inverse_log", oracle("SELECT company_id, round(exp(total_funding / 1000), 6) AS value FROM cmp", "cmp"))
def inverse_log(spark, d):
    return companies(spark, d).select("company_id", F.round(M.exp_pred(F.col("total_funding") / 1000), 6).alias("value"))


@query(
    "boxcox_fixed",
    oracle(
        "SELECT company_id, CASE WHEN valuation > 0 THEN round((pow(valuation, 0.5) - 1) / 0.5, 8) END AS half, "
        "CASE WHEN valuation > 0 THEN round(ln(valuation), 8) END AS zero, round(valuation, 4) AS back FROM cmp",
        "cmp",
    ),
)
def boxcox_fixed(spark, d):
    v = F.col("valuation")
    half = M.boxcox(v, 0.5)
    return companies(spark, d).select(
        "company_id",
        F.round(half, 8).alias("half"),
        F.round(M.boxcox(v, 0.0), 8).alias("zero"),
        F.round(M.inv_boxcox(half, 0.5), 4).alias("back"),
    )


@query(
    "boxcox_fit",
    oracle(
        "x AS (SELECT valuation / exp(avg(ln(valuation)) OVER ()) AS z FROM cmp WHERE valuation > 0), "
        "g AS (SELECT (i - 20) / CAST(10 AS DOUBLE) AS exponent FROM range(41) t(i)), "
        "s AS (SELECT exponent, var_pop(pow(z, exponent) / exponent) AS v FROM x, g "
        "WHERE exponent <> 0 GROUP BY exponent UNION ALL SELECT 0.0, var_pop(ln(z)) FROM x) "
        "SELECT round(arg_min(exponent, v), 6) AS exponent FROM s",
        "cmp",
    ),
)
def boxcox_fit(spark, d):
    """The best exponent of a 41-point grid, so that a plain grid search can check it."""
    df = companies(spark, d)
    lam = M.boxcox_fit(df, "valuation", steps=41, rounds=1)
    return df.agg(F.round(F.max(F.lit(lam)), 6).alias("exponent"))


@query(
    "round_even",
    oracle(
        "SELECT company_id, year, round_even(inventory / 8, 2) AS two, round_even(inventory / 2, 0) AS zero, "
        "round_even(inventory / 4, 1) AS one FROM stm",
        "stm",
    ),
)
def round_even(spark, d):
    """Eighths, quarters and halves hit the ties exactly."""
    n = F.col("inventory")
    return statements(spark, d).select(
        "company_id",
        "year",
        M.round_even(n / 8, 2).alias("two"),
        M.round_even(n / 2, 0).alias("zero"),
        M.round_even(n / 4, 1).alias("one"),
    )


@query(
    "decode_class",
    oracle(
        "SELECT company_id, CASE acq_class WHEN 0 THEN 'not acquired' WHEN 1 THEN 'partly acquired' WHEN 2 THEN 'fully acquired' "
        "END AS text FROM cmp",
        "cmp",
    ),
)
def decode_class_query(spark, d):
    return companies(spark, d).select("company_id", decode_class(F.col("acq_class")).alias("text"))


# ---- fusion --------------------------------------------------------------------------------------

FUSED = ("sales", "ebitda", "fixed_assets", "employees", "turnover", "ratio_acid_test")


@query("fuse_years_weighted", oracle(fuse_sql("rat", FUSED, ("taxes",)), "rat"))
def fuse_years_weighted(spark, d):
    df = M.add_ratios(prepared(spark, d, BOTH)).select("company_id", "year", *FUSED, "taxes")
    return fusion.fuse_years_weighted(df, "company_id", "year", LATER, EARLIER, ["taxes"])


@query("fuse_years_pct", oracle(fuse_sql("rat", FUSED, ("taxes",), "pct"), "rat"))
def fuse_years_pct(spark, d):
    df = M.add_ratios(prepared(spark, d, BOTH)).select("company_id", "year", *FUSED, "taxes")
    return fusion.fuse_years_pct(df, "company_id", "year", LATER, EARLIER, ["taxes"])


# ---- encoding, scaling, splitting ----------------------------------------------------------------


@query(
    "label_encode",
    oracle(
        ", ".join(
            f"codes_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) - 1 AS k FROM (SELECT DISTINCT {c} FROM cmp WHERE {c} IS NOT NULL))"
            for c in ("growth_stage", "place", "name")
        )
        + " SELECT company_id, CAST(coalesce(s.k, (SELECT count(*) FROM codes_growth_stage)) AS INTEGER) AS growth_stage, "
        "CAST(p.k AS INTEGER) AS place, CAST(n.k AS INTEGER) AS name FROM cmp LEFT JOIN codes_growth_stage s ON s.v = growth_stage "
        "LEFT JOIN codes_place p ON p.v = place LEFT JOIN codes_name n ON n.v = name",
        "cmp",
    ),
)
def label_encode(spark, d):
    return encoding.label_encode(settle(companies(spark, d).select("company_id", "growth_stage", "place", "name")))


@query(
    "recode_ordinal",
    oracle("SELECT company_id, CAST(dense_rank() OVER (ORDER BY place) - 1 AS INTEGER) AS place FROM cmp", "cmp"),
)
def recode_ordinal(spark, d):
    return encoding.recode_ordinal(companies(spark, d).select("company_id", "place"), "place")


SCALED = ("sales", "ebitda", "fixed_assets", "current_liab")


@query(
    "standardize",
    oracle(
        "SELECT company_id, year, " + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 8) AS {c}" for c in SCALED)
        + ", taxes FROM stm",
        "stm",
    ),
)
def standardize(spark, d):
    df = settle(statements(spark, d).select("company_id", "year", *SCALED, "taxes"))
    return rounded(encoding.standardize(df, skip=["company_id", "year", "taxes"]), 8, *SCALED)


@query(
    "minmax",
    oracle(
        "SELECT company_id, year, "
        + ", ".join(f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) AS {c}" for c in SCALED)
        + ", taxes FROM stm",
        "stm",
    ),
)
def minmax(spark, d):
    df = settle(statements(spark, d).select("company_id", "year", *SCALED, "taxes"))
    return encoding.minmax(df, skip=["company_id", "year", "taxes"])


@query(
    "train_test_split",
    oracle(
        "SELECT company_id, CASE WHEN CAST('0x' || substr(md5('42|' || company_id::VARCHAR), 1, 8) AS BIGINT) % 100 < 20 "
        "THEN 'test' ELSE 'train' END AS part FROM cmp",
        "cmp",
    ),
)
def train_test_split(spark, d):
    train, test = splitting.split(companies(spark, d).select("company_id"), "company_id", 0.2)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "stratified_folds",
    oracle(
        "SELECT company_id, acq_class, CAST((row_number() OVER (PARTITION BY acq_class ORDER BY md5('42|' || company_id::VARCHAR)) - 1) % 5 "
        "AS INTEGER) AS fold FROM cmp",
        "cmp",
    ),
)
def stratified_folds(spark, d):
    return splitting.stratified_folds(companies(spark, d).select("company_id", "acq_class"), "acq_class", "company_id", 5)


@query(
    "repeated_folds",
    oracle(
        "SELECT company_id, acq_class, CAST(r AS INTEGER) AS repeat, CAST((row_number() OVER (PARTITION BY acq_class, r "
        "ORDER BY md5('42|' || r::VARCHAR || '|' || company_id::VARCHAR)) - 1) % 10 AS INTEGER) AS fold FROM cmp, range(3) t(r)",
        "cmp",
    ),
)
def repeated_folds(spark, d):
    df = companies(spark, d).select("company_id", "acq_class")
    return splitting.stratified_folds(df, "acq_class", "company_id", 10, repeats=3)


# ---- outliers ------------------------------------------------------------------------------------

CHECKED = ("sales", "ebitda", "fixed_assets", "current_assets", "working_capital", "turnover")


def _limit_sql(lower: str) -> str:
    q = "quantile_cont({c}, {p})"
    parts = []
    for c in CHECKED:
        q1, q3 = q.format(c=c, p=0.25), q.format(c=c, p=0.75)
        parts.append(
            f"SELECT '{c}' AS variable, {q3 if lower == 'q3' else q1} - 1.5 * ({q3} - {q1}) AS out_min, "
            f"{q3} + 1.5 * ({q3} - {q1}) AS out_max FROM prep"
        )
    return " UNION ALL ".join(parts)


def _limits_rounded(lower: str) -> str:
    return oracle(
        f"l AS ({_limit_sql(lower)}) SELECT variable, round(out_min, 6) AS out_min, round(out_max, 6) AS out_max FROM l", "prep"
    )


@query("outlier_limits", _limits_rounded("q3"))
def outlier_limits(spark, d):
    return rounded(outliers.outlier_limits(prepared(spark, d), CHECKED), 6, "out_min", "out_max")


@query("outlier_limits_q1", _limits_rounded("q1"))
def outlier_limits_q1(spark, d):
    return rounded(outliers.outlier_limits(prepared(spark, d), CHECKED, "q1"), 6, "out_min", "out_max")


def _flag_sql(c: str) -> str:
    lo = f"(SELECT out_min FROM l WHERE variable = '{c}')"
    hi = f"(SELECT out_max FROM l WHERE variable = '{c}')"
    return f"coalesce({c} < {lo} OR {c} > {hi}, false)"


@query(
    "flag_outliers",
    oracle(
        f"l AS ({_limit_sql('q1')}) SELECT company_id, year, " + ", ".join(f"{_flag_sql(c)} AS {c}_is_outlier" for c in CHECKED) + " FROM prep",
        "prep",
    ),
)
def flag_outliers(spark, d):
    df = settle(prepared(spark, d).select("company_id", "year", *CHECKED))
    return outliers.flag_outliers(df, outliers.limits(df, CHECKED, "q1", stored=True)).drop(*CHECKED)


@query(
    "drop_outlier_rows",
    oracle(
        f"l AS ({_limit_sql('q1')}) SELECT company_id, year, sales FROM prep WHERE "
        + " + ".join(f"({_flag_sql(c)})::INT" for c in CHECKED)
        + " <= 0.1 * 6",
        "prep",
    ),
)
def drop_outlier_rows(spark, d):
    df = settle(prepared(spark, d).select("company_id", "year", *CHECKED))
    flagged = outliers.flag_outliers(df, outliers.limits(df, CHECKED, "q1", stored=True))
    return outliers.drop_outlier_rows(flagged, [f"{c}_is_outlier" for c in CHECKED]).select("company_id", "year", "sales")


@query("isolation_forest")
def isolation_forest(spark, d):
    df = imputation.impute_knn(company_years(spark, d).select("company_year", *RESOURCES), "company_year", RESOURCES)
    return outliers.isolation_forest(df, RESOURCES, "company_year").select("company_year", "score", "outlier")
