"""The company tables that queries work on, bound to the order, customer and line-item tables.

Years 2000 and 1999 are the later and the earlier fiscal year. Gaps sit at fixed places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from firmlens.functions.measures import add_ratios
from firmlens.operators.cleaning import impute_balance, null_sentinel, recompute_totals
from firmlens.operators.fusion import fuse_years_weighted

LATER, EARLIER = 2000, 1999


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The fiscal years of everything that sets two years side by side.
BOTH = (EARLIER, LATER)


def statements(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Company-year statements of all years, or from the first to the last of ``years``.

    The year filter is a date range that reaches the scan. Lines are summed per order first: that
    aggregate keeps the partitioning of the join, and the number of orders becomes a plain count
    instead of a distinct one.
    """
    orders = table(spark, sf_dir, "orders")
    if years:
        # Literals of the column's own type: a cast on the column would keep the filter from the scan.
        kind = orders.schema["o_orderdate"].dataType
        start, end = (F.lit(f"{y}-01-01").cast(kind) for y in (years[0], years[1] + 1))
        orders = orders.where((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end))

    def money(c) -> F.Column:
        """Ten-thousandths as a whole number: sums are exact whatever their order, and the
        decimal is made from a long, which is much cheaper than from a double."""
        return F.rint(c * 10000).cast("long").cast("decimal(18,0)")

    price = F.col("l_extendedprice")
    new = F.col("l_returnflag") == "N"
    sums = {
        "fixed": money(F.when(new, price).otherwise(0.0)),
        "current": money(F.when(~new, price).otherwise(0.0)),
        "sales": money(price * (1 - F.col("l_discount"))),
        "debt": money(price * F.col("l_discount")),
        "taxes": money(price * F.col("l_tax")),
        "inventory": money(F.col("l_quantity")),
    }
    per_order = (
        orders.select("o_orderkey", F.col("o_custkey").alias("company_id"), F.year("o_orderdate").alias("year"))
        .join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_orderkey", "company_id", "year")
        .agg(*(F.sum(v).alias(c) for c, v in sums.items()))
    )
    totals = per_order.groupBy("company_id", "year").agg(
        *((F.sum(c).cast("double") / 10000.0).alias(c) for c in sums),
        F.count(F.lit(1)).cast("double").alias("orders"),
    )

    def gap(every: int, c) -> F.Column:
        return F.when(F.col("company_id") % every != 0, c)

    total = F.col("fixed") + F.col("current")
    sales, debt = F.col("sales"), F.col("debt")
    return totals.select(
        "company_id",
        "year",
        gap(7, F.col("fixed")).alias("fixed_assets"),
        gap(11, F.col("current")).alias("current_assets"),
        total.alias("total_assets"),
        total.alias("total_liab_equity"),
        (0.25 * total).alias("subscribed"),
        (0.15 * total).alias("other_equity"),
        (0.40 * total).alias("equity"),
        gap(5, 0.35 * total).alias("noncurrent_liab"),
        gap(13, 0.25 * total).alias("current_liab"),
        "sales",
        "debt",
        "taxes",
        "inventory",
        (0.3 * sales - debt).alias("ebitda"),
        (0.2 * sales - debt).alias("ebit"),
        (0.1 * sales).alias("amort"),
        (0.05 * sales).alias("payables"),
        gap(9, F.col("orders")).alias("employees"),
        F.when(F.col("company_id") % 17 == 0, "n.s.").otherwise(F.col("inventory").cast("int").cast("string")).alias("turnover_txt"),
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legal and funding facts, one row per company."""
    first = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_date"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    month = F.month("first_date")
    name = F.when(month == 1, "jan").when(month == 2, "feb").when(month == 3, "mar").otherwise("apr")
    year = F.year("first_date").cast("string")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(first, F.col("o_custkey") == key, "left")
        .select(
            key.alias("company_id"),
            F.col("c_name").alias("name"),
            F.col("n_name").alias("place"),
            F.when(key % 10 != 3, F.col("c_mktsegment")).alias("growth_stage"),
            F.col("first_date").alias("constitution_date"),
            F.when(key % 8 == 0, F.lit(None))
            .when(key % 8 == 1, year)
            .otherwise(F.concat(name, F.lit("/"), year))
            .alias("first_funding_txt"),
            F.when(key % 4 != 0, "seed").alias("last_round"),
            F.when(key % 6 == 0, 0.0).otherwise(F.abs(balance)).alias("total_funding"),
            F.when(key % 3 != 0, F.abs(balance) / 2).alias("last_funding"),
            F.when(key % 2 != 0, F.abs(balance) + 1).alias("valuation"),
            F.when(balance < 2000, 0).when(balance < 6000, 1).otherwise(2).alias("acq_class"),
        )
    )


def prepared(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Statements after sentinel removal, identity fills and recomputed totals."""
    df = null_sentinel(statements(spark, sf_dir, years)).withColumnRenamed("turnover_txt", "turnover")
    return df.transform(impute_balance).transform(recompute_totals)


FEATURES = (
    "fixed_assets", "current_assets", "total_assets", "equity", "noncurrent_liab", "current_liab", "sales", "debt",
    "taxes", "inventory", "ebitda", "ebit", "amort", "payables", "working_capital", "ratio_debt_assets",
    "ratio_debt_equity", "ratio_ebitda_assets", "ratio_ebitda_equity", "ratio_sales_ebitda", "ratio_sales_assets",
    "ratio_acid_test", "ratio_collection_days",
)


def fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per company with both years: the weighted mean of every feature."""
    df = add_ratios(prepared(spark, sf_dir, BOTH)).select("company_id", "year", *FEATURES)
    return fuse_years_weighted(df, "company_id", "year", LATER, EARLIER)


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fused features with the funding figures and both targets."""
    facts = companies(spark, sf_dir).select(
        "company_id", "place", "growth_stage", "total_funding", "last_funding", "valuation", "acq_class"
    )
    return fused(spark, sf_dir).join(facts, "company_id")


def scoring_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every company with both years and all inputs of the two published scorers.

    Measures that the bound tables lack are made from those they have.
    """
    rounds = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("company_id")).agg(
        F.count(F.lit(1)).cast("double").alias("total_rounds"),
        F.datediff(F.lit("2002-06-30").cast("date"), F.min("o_orderdate").cast("date")).cast("double").alias("days_operating"),
    )
    staff = statements(spark, sf_dir, BOTH).groupBy("company_id").agg(F.avg("employees").alias("employees"))

    def over(a: str, b: str):
        return F.col(a) / F.nullif(F.col(b), F.lit(0.0))

    total_debt = F.col("noncurrent_liab") + F.col("current_liab")
    return (
        model_table(spark, sf_dir)
        .join(rounds, "company_id", "left")
        .join(staff, "company_id", "left")
        .withColumns(
            {
                "total_liab_equity": F.col("total_assets"),
                "share_capital": F.col("equity") * 0.625,
                "cash": F.col("current_assets") - F.col("inventory"),
                "collection_days": F.col("ratio_collection_days"),
                "indebtedness": total_debt / F.nullif("total_assets", F.lit(0.0)),
                "financial_autonomy": over("equity", "total_assets"),
                "staff_cost_ratio": over("employees", "sales"),
                "inventory_turnover": over("sales", "inventory"),
                "net_asset_turnover": over("sales", "equity"),
                "return_on_assets": (F.col("ebit") - F.col("taxes")) / F.nullif("total_assets", F.lit(0.0)),
                "economic_return": over("ebit", "total_assets"),
                "financial_result": -F.col("debt"),
                "value_added": F.col("sales") - F.col("payables"),
                "liquidity_ratio": over("current_assets", "current_liab"),
                "general_liquidity": over("working_capital", "current_liab"),
                "solvency_ratio": over("equity", "debt"),
            }
        )
    )


# ---- the same tables as SQL ----------------------------------------------------------------------

_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    _CTES[name] = (needs, sql)


def oracle(body: str, *needs: str) -> str:
    """``body`` (a SELECT, or more CTEs ending in one) after the tables it needs."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in _CTES[name][0]:
            add(n)
        if name not in order:
            order.append(name)

    for n in needs:
        add(n)
    body = body.strip()
    ctes = ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in order)
    if not ctes:
        return body if body.upper().startswith("SELECT") else f"WITH {body}"
    return f"WITH {ctes}{' ' if body.upper().startswith('SELECT') else ', '}{body}"


cte(
    "stm",
    """
SELECT company_id, CAST(year AS INTEGER) AS year,
  CASE WHEN company_id % 7 = 0 THEN NULL ELSE fixed0 END AS fixed_assets,
  CASE WHEN company_id % 11 = 0 THEN NULL ELSE current0 END AS current_assets,
  fixed0 + current0 AS total_assets, fixed0 + current0 AS total_liab_equity,
  0.25 * (fixed0 + current0) AS subscribed, 0.15 * (fixed0 + current0) AS other_equity,
  0.40 * (fixed0 + current0) AS equity,
  CASE WHEN company_id % 5 = 0 THEN NULL ELSE 0.35 * (fixed0 + current0) END AS noncurrent_liab,
  CASE WHEN company_id % 13 = 0 THEN NULL ELSE 0.25 * (fixed0 + current0) END AS current_liab,
  sales, debt, taxes, inventory, 0.3 * sales - debt AS ebitda, 0.2 * sales - debt AS ebit,
  0.1 * sales AS amort, 0.05 * sales AS payables,
  CASE WHEN company_id % 9 = 0 THEN NULL ELSE n_orders END AS employees,
  CASE WHEN company_id % 17 = 0 THEN 'n.s.' ELSE CAST(CAST(inventory AS INT) AS VARCHAR) END AS turnover_txt
FROM (
  SELECT o_custkey AS company_id, year(o_orderdate) AS year,
    CAST(SUM(CAST(CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE 0 END AS DECIMAL(18,4))) AS DOUBLE) AS fixed0,
    CAST(SUM(CAST(CASE WHEN l_returnflag <> 'N' THEN l_extendedprice ELSE 0 END AS DECIMAL(18,4))) AS DOUBLE) AS current0,
    CAST(SUM(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS sales,
    CAST(SUM(CAST(l_extendedprice * l_discount AS DECIMAL(18,4))) AS DOUBLE) AS debt,
    CAST(SUM(CAST(l_extendedprice * l_tax AS DECIMAL(18,4))) AS DOUBLE) AS taxes,
    CAST(SUM(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS inventory,
    CAST(COUNT(DISTINCT o_orderkey) AS DOUBLE) AS n_orders
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  GROUP BY o_custkey, year(o_orderdate))
""",
)
cte(
    "cmp",
    """
SELECT c_custkey AS company_id, c_name AS name, n_name AS place,
  CASE WHEN c_custkey % 10 = 3 THEN NULL ELSE c_mktsegment END AS growth_stage,
  f.first_date AS constitution_date,
  CASE WHEN c_custkey % 8 = 0 THEN NULL
       WHEN c_custkey % 8 = 1 THEN CAST(year(f.first_date) AS VARCHAR)
       ELSE CASE month(f.first_date) WHEN 1 THEN 'jan' WHEN 2 THEN 'feb' WHEN 3 THEN 'mar' ELSE 'apr' END
            || '/' || CAST(year(f.first_date) AS VARCHAR) END AS first_funding_txt,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'seed' END AS last_round,
  CASE WHEN c_custkey % 6 = 0 THEN CAST(0 AS DOUBLE) ELSE abs(c_acctbal) END AS total_funding,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE abs(c_acctbal) / 2 END AS last_funding,
  CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE abs(c_acctbal) + 1 END AS valuation,
  CASE WHEN c_acctbal < 2000 THEN 0 WHEN c_acctbal < 6000 THEN 1 ELSE 2 END AS acq_class
FROM customer JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_date FROM orders GROUP BY o_custkey) f
  ON f.o_custkey = c_custkey
""",
)
cte(
    "bal",
    """
SELECT * EXCLUDE (fixed_assets, current_assets, noncurrent_liab, current_liab),
  fa AS fixed_assets, coalesce(current_assets, total_assets - fa) AS current_assets,
  coalesce(nl, 0) AS noncurrent_liab, coalesce(current_liab, total_liab_equity - equity - nl, 0) AS current_liab
  FROM (SELECT *, coalesce(fixed_assets, total_assets - current_assets) AS fa,
          coalesce(noncurrent_liab, total_liab_equity - equity - current_liab) AS nl FROM stm)
""",
    "stm",
)
cte(
    "prep",
    """
SELECT company_id, year, fixed_assets, current_assets, fixed_assets + current_assets AS total_assets,
  total_liab_equity, subscribed, other_equity, subscribed + other_equity AS equity, noncurrent_liab, current_liab,
  sales, debt, taxes, inventory, ebitda, ebit, amort, payables, employees,
  TRY_CAST(nullif(turnover_txt, 'n.s.') AS DOUBLE) AS turnover, current_assets - current_liab AS working_capital
FROM bal
""",
    "bal",
)
cte(
    "rat",
    """
SELECT *, debt / nullif(ebitda, 0) AS ratio_debt_ebitda, debt / nullif(total_assets, 0) AS ratio_debt_assets,
  debt / nullif(equity, 0) AS ratio_debt_equity, ebitda / nullif(total_assets, 0) AS ratio_ebitda_assets,
  ebitda / nullif(equity, 0) AS ratio_ebitda_equity, sales / nullif(ebitda, 0) AS ratio_sales_ebitda,
  sales / nullif(total_assets, 0) AS ratio_sales_assets, sales / nullif(equity, 0) AS ratio_sales_equity,
  (current_assets - inventory) / nullif(current_liab, 0) AS ratio_acid_test,
  payables * 365 / nullif(sales, 0) AS ratio_collection_days
FROM prep
""",
    "prep",
)


def fuse_sql(source: str, fused_cols, kept_cols=(), kind: str = "weighted") -> str:
    """The two-year fusion of a table as a self-join."""
    merge = "a.{c} * 0.75 + b.{c} * 0.25" if kind == "weighted" else "(a.{c} - b.{c}) / nullif(b.{c}, 0) * 100"
    parts = [f"CASE WHEN b.{c} = 0 THEN 0 ELSE {merge.format(c=c)} END AS {c}" for c in fused_cols]
    parts += [f"a.{c} AS {c}" for c in kept_cols]
    return (
        f"SELECT a.company_id, {', '.join(parts)} FROM {source} a JOIN {source} b "
        f"ON a.company_id = b.company_id AND a.year = {LATER} AND b.year = {EARLIER}"
    )


cte("fused", fuse_sql("rat", FEATURES), "rat")
cte(
    "mt",
    "SELECT fused.*, place, growth_stage, total_funding, last_funding, valuation, acq_class "
    "FROM fused JOIN cmp USING (company_id)",
    "fused",
    "cmp",
)
