"""The same tables and results in plain SQL, for an independent engine.

Sums of two-decimal values are exact decimals here, so agreement also shows that
the Spark results carry no noise of floating point. Means, and what follows from
them, are added up as plain doubles; the last digits of such columns depend on the
engine, so queries and SQL show them through ``settled``.
"""

from __future__ import annotations

def settled(column: str) -> str:
    """A double cut after its sixth decimal, at a border that no simple fraction lies on."""
    return f"floor({column} * 1e6 + CAST(0.4373 AS DOUBLE)) / 1e6"


# Store and product of a line, what that needs joined, and the line's date.
_HOT = "CASE WHEN l_orderkey % 3 = 0 THEN"
_KEYS = {
    "item": ("l_suppkey", "l_partkey", "", "CAST(l_shipdate AS DATE)"),
    "hot": (
        f"{_HOT} 1 ELSE l_suppkey END",
        f"{_HOT} 1 ELSE l_partkey END",
        "",
        f"{_HOT} DATE '1997-06-07' ELSE CAST(l_shipdate AS DATE) END",
    ),
    "brand": (
        "n_regionkey",
        "CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER)",
        "JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey",
        "CAST(l_shipdate AS DATE)",
    ),
}

CALENDAR = """
span AS (
  SELECT min(CAST(l_shipdate AS DATE)) AS a, max(CAST(l_shipdate AS DATE)) AS z FROM lineitem),
days AS (
  SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY))
              AS DATE) AS CAL_DT FROM span),
numbered AS (
  SELECT CAL_DT, CAST(date_diff('day', DATE '1995-01-01', CAL_DT) AS INTEGER) AS n,
         CAST(dayofyear(CAL_DT) AS INTEGER) - 1 AS doy,
         CAST(year(CAL_DT) AS INTEGER) AS y, CAST(month(CAL_DT) AS INTEGER) AS m,
         CAST(quarter(CAL_DT) AS INTEGER) AS q
  FROM days),
plain_calendar AS (
  SELECT CAL_DT, 'Fiscal' AS CAL_TYPE_DESC, n % 7 AS DAY_OF_WK_NUM,
         CASE n % 7 WHEN 0 THEN 'Sunday' WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday'
           WHEN 3 THEN 'Wednesday' WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday'
           ELSE 'Saturday' END AS DAY_OF_WK_DESC,
         y AS YR_NUM, 1 + (doy + (n - doy) % 7) // 7 AS WK_NUM,
         y * 100 + 1 + (doy + (n - doy) % 7) // 7 AS YR_WK_NUM,
         m AS MNTH_NUM, y * 100 + m AS YR_MNTH_NUM, q AS QTR_NUM, y * 100 + q AS YR_QTR_NUM
  FROM numbered)"""

# The calendar as it is; with the weeks of summer unknown; and with December's dates twice.
_CALENDARS = {
    "plain": "calendar AS (SELECT * FROM plain_calendar)",
    "loose": """calendar AS (
      SELECT * REPLACE (CASE WHEN MNTH_NUM IN (6, 7) THEN 0 ELSE YR_NUM END AS YR_NUM,
                        CASE WHEN MNTH_NUM IN (6, 7) THEN 0 ELSE WK_NUM END AS WK_NUM)
      FROM plain_calendar)""",
    "repeated": """calendar AS (
      SELECT * FROM plain_calendar UNION ALL SELECT * FROM plain_calendar WHERE MNTH_NUM = 12)""",
}


def _lines(grain: str) -> str:
    store, product, joins, day = _KEYS[grain]
    return f"""
lines AS (
  SELECT *, {day} AS SHIP_DT,
         CASE WHEN l_orderkey % 97 <> 0 THEN CAST({store} AS INTEGER) END AS STORE_KEY,
         CAST({product} AS INTEGER) AS PROD_KEY
  FROM lineitem JOIN part ON p_partkey = l_partkey {joins})"""


_SALES = """
raw_sales AS (
  SELECT CAST((l_orderkey * 10 + l_linenumber) % 2147483647 AS INTEGER) AS TRANS_ID,
         PROD_KEY, STORE_KEY,
         CASE WHEN l_orderkey % 89 <> 0 THEN SHIP_DT END AS TRANS_DT,
         l_linenumber AS TRANS_TIME, l_quantity AS SALES_QTY, p_retailprice AS SALES_PRICE,
         l_extendedprice AS SALES_AMT,
         CASE WHEN l_orderkey % 83 <> 0 THEN l_discount END AS DISCOUNT,
         l_quantity * 10 AS SALES_COST,
         round((l_extendedprice - l_quantity * 10) * 100) / 100 AS SALES_MGRN,
         l_tax AS SHIP_COST
  FROM lines),
sales AS (
  SELECT * REPLACE (coalesce(STORE_KEY, 0) AS STORE_KEY, coalesce(DISCOUNT, 0) AS DISCOUNT)
  FROM raw_sales)"""

_INVENTORY = """
counts AS (
  SELECT *, (l_orderkey * 7 + l_linenumber * 13 + k * 5) % 60 AS on_hand,
         CASE WHEN l_orderkey % 101 <> 0 THEN SHIP_DT + CAST(CASE WHEN k = 0
           THEN l_linenumber % 2
           ELSE 6 - date_diff('day', DATE '1995-01-01', SHIP_DT) % 7 END AS INTEGER) END AS CAL_DT
  FROM lines CROSS JOIN (SELECT unnest([0, 1]) AS k)),
raw_inventory AS (
  SELECT CAL_DT, STORE_KEY, PROD_KEY,
         CAST(CASE WHEN l_orderkey % 79 <> 0 THEN on_hand END AS DOUBLE) AS INVENTORY_ON_HAND_QTY,
         CAST((l_orderkey + l_linenumber * 3 + k) % 25 AS DOUBLE) AS INVENTORY_ON_ORDER_QTY,
         CASE WHEN l_orderkey % 73 <> 0 THEN CASE WHEN on_hand < 6 THEN 1 ELSE 0 END END
           AS OUT_OF_STOCK_FLG,
         CAST(l_orderkey % 3 AS DOUBLE) AS WASTE_QTY, k = 0 AS PROMOTION_FLG,
         CAL_DT + 3 AS NEXT_DELIVERY_DT
  FROM counts),
inventory AS (
  SELECT * REPLACE (coalesce(STORE_KEY, 0) AS STORE_KEY,
                    coalesce(INVENTORY_ON_HAND_QTY, 0) AS INVENTORY_ON_HAND_QTY,
                    coalesce(OUT_OF_STOCK_FLG, 0) AS OUT_OF_STOCK_FLG)
  FROM raw_inventory)"""

STORE = """
store AS (
  SELECT CAST(s_suppkey AS INTEGER) AS STORE_KEY, CAST(s_suppkey + 100 AS INTEGER) AS STORE_NUM,
         s_name AS STORE_DESC, 'None' AS ADDR, 'None' AS CITY, r_name AS REGION,
         'None' AS CNTRY_CD, n_name AS CNTRY_NM, 'None' AS POSTAL_ZIP_CD,
         'None' AS PROV_STATE_DESC, 'None' AS PROV_STATE_CD, 'None' AS STORE_TYPE_CD,
         'None' AS STORE_TYPE_DESC, 'None' AS FRNCHS_FLG, 'None' AS STORE_SIZE,
         CAST(s_nationkey AS INTEGER) AS MARKET_KEY, n_name AS MARKET_NAME,
         0 AS SUBMARKET_KEY, 'None' AS SUBMARKET_NAME,
         CAST(s_suppkey % 90 AS DOUBLE) AS LATITUDE, CAST(s_suppkey % 180 AS DOUBLE) AS LONGITUDE
  FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey)"""

PRODUCT = """
product AS (
  SELECT CAST(p_partkey AS INTEGER) AS PROD_KEY, p_name AS PROD_NAME, p_retailprice AS VOL,
         CAST(0 AS DOUBLE) AS WGT, p_brand AS BRAND_NAME, 0 AS STATUS_CODE,
         'None' AS STATUS_CODE_NAME, CAST(p_size AS INTEGER) AS CATEGORY_KEY,
         p_type AS CATEGORY_NAME, 0 AS SUBCATEGORY_KEY, 'None' AS SUBCATEGORY_NAME
  FROM part)"""


def _exact(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


_DAILY = f"""
daily_sales AS (
  SELECT TRANS_DT AS CAL_DT, STORE_KEY, PROD_KEY, {_exact("SALES_QTY")} AS SALES_QTY,
         {_exact("SALES_AMT")} AS SALES_AMT,
         {_exact("SALES_PRICE")} / count(*) AS SALES_PRICE,
         {_exact("SALES_COST")} AS SALES_COST, {_exact("SALES_MGRN")} AS SALES_MGRN,
         {_exact("DISCOUNT")} / count(*) AS DISCOUNT, {_exact("SHIP_COST")} AS SHIP_COST
  FROM sales GROUP BY ALL),
daily_fact AS (
  SELECT coalesce(s.CAL_DT, i.CAL_DT) AS CAL_DT, coalesce(s.STORE_KEY, i.STORE_KEY) AS STORE_KEY,
         coalesce(s.PROD_KEY, i.PROD_KEY) AS PROD_KEY,
         coalesce(s.SALES_QTY, 0) AS SALES_QTY, coalesce(s.SALES_PRICE, 0) AS SALES_PRICE,
         coalesce(s.SALES_AMT, 0) AS SALES_AMT, coalesce(s.DISCOUNT, 0) AS DISCOUNT,
         coalesce(s.SALES_COST, 0) AS SALES_COST, coalesce(s.SALES_MGRN, 0) AS SALES_MGRN,
         coalesce(i.INVENTORY_ON_HAND_QTY, 0) AS STOCK_ON_HAND_QTY,
         coalesce(i.INVENTORY_ON_ORDER_QTY, 0) AS ORDERED_STOCK_QTY,
         CASE WHEN i.OUT_OF_STOCK_FLG = 1 THEN true ELSE false END AS OUT_OF_STOCK_FLG,
         CASE WHEN i.OUT_OF_STOCK_FLG = 1 THEN false ELSE true END AS IN_STOCK_FLG,
         CASE WHEN i.INVENTORY_ON_HAND_QTY < s.SALES_QTY THEN true ELSE false END
           AS LOW_STOCK_FLG
  FROM daily_sales s FULL JOIN inventory i
    ON s.CAL_DT = i.CAL_DT AND s.STORE_KEY = i.STORE_KEY AND s.PROD_KEY = i.PROD_KEY)"""

_WEEKLY = f"""
weekly AS (
  SELECT YR_NUM, WK_NUM, STORE_KEY, PROD_KEY, {_exact("SALES_QTY")} AS WK_SALES_QTY,
         sum(SALES_PRICE) / count(*) AS AVG_SALES_PRICE,
         {_exact("SALES_AMT")} AS WK_SALES_AMT,
         sum(DISCOUNT) AS WK_DISCOUNT,
         {_exact("SALES_COST")} AS WK_SALES_COST,
         {_exact("SALES_MGRN")} AS WK_SALES_MGRN,
         {_exact("CASE WHEN DAY_OF_WK_NUM = 6 THEN STOCK_ON_HAND_QTY ELSE 0 END")}
           AS EOP_STOCK_ON_HAND_QTY,
         {_exact("CASE WHEN DAY_OF_WK_NUM = 6 THEN ORDERED_STOCK_QTY ELSE 0 END")}
           AS EOP_ORDERED_STOCK_QTY,
         CAST(sum(CASE WHEN OUT_OF_STOCK_FLG THEN 1 ELSE 0 END) AS BIGINT) AS OUT_OF_STOCK_TIMES,
         CAST(sum(CASE WHEN IN_STOCK_FLG THEN 1 ELSE 0 END) AS BIGINT) AS IN_STOCK_TIMES,
         CAST(sum(CASE WHEN LOW_STOCK_FLG THEN 1 ELSE 0 END) AS BIGINT) AS LOW_STOCK_TIMES,
         sum(CASE WHEN LOW_STOCK_FLG
           THEN SALES_AMT - STOCK_ON_HAND_QTY * SALES_PRICE ELSE 0 END) AS POTENTIAL_LOW_STOCK_IMPACT,
         {_exact("CASE WHEN OUT_OF_STOCK_FLG THEN SALES_AMT ELSE 0 END")} AS NO_STOCK_IMPACT
  FROM daily_fact JOIN calendar USING (CAL_DT) GROUP BY YR_NUM, WK_NUM, STORE_KEY, PROD_KEY),
metrics AS (
  SELECT *, CASE WHEN WK_SALES_QTY <> 0 THEN WK_SALES_AMT / WK_SALES_QTY END AS AVG_UNIT_PRICE,
         OUT_OF_STOCK_TIMES / 7.0::DOUBLE AS OUT_OF_STOCK_DAY_RATIO,
         IN_STOCK_TIMES / 7.0::DOUBLE AS IN_STOCK_DAY_RATIO,
         OUT_OF_STOCK_TIMES + LOW_STOCK_TIMES AS TOTAL_LOW_STOCK_IMPACT,
         CASE WHEN WK_SALES_QTY <> 0 THEN EOP_STOCK_ON_HAND_QTY / WK_SALES_QTY END
           AS WEEKS_OF_SUPPLY
  FROM weekly)"""


def query(select: str, grain: str = "item", weeks: str = "plain", known: bool = False) -> str:
    """A statement over all tables and steps, by their names above; ``known``: no unknown keys in the facts."""
    facts = [_SALES, _INVENTORY]
    if known:
        where = " WHERE {0} IS NOT NULL AND STORE_KEY <> 0 AND PROD_KEY <> 0)"
        facts = [f.rstrip()[:-1] + where.format(d) for f, d in zip(facts, ("TRANS_DT", "CAL_DT"), strict=True)]
    steps = [CALENDAR, _CALENDARS[weeks], _lines(grain), *facts, STORE, PRODUCT]
    return "WITH " + ",".join([*steps, _DAILY, _WEEKLY]) + "\n" + select
