"""Column lists of the five input tables.

Each line gives a column, the type the mart job reads it with, and the type it
has in the raw table, whose integers are wide. CSV columns map by position, so the
order matters.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Names, order and types of the input columns.
_COLUMNS = {
    "calendar": """
        CAL_DT         date    date not null
        CAL_TYPE_DESC  string  varchar(20)
        DAY_OF_WK_NUM  int     varchar(30)
        DAY_OF_WK_DESC string  string
        YR_NUM         int     bigint
        WK_NUM         int     bigint
        YR_WK_NUM      int     bigint
        MNTH_NUM       int     bigint
        YR_MNTH_NUM    int     bigint
        QTR_NUM        int     bigint
        YR_QTR_NUM     int     bigint
    """,
    "inventory": """
        CAL_DT                 date     date
        STORE_KEY              int      bigint
        PROD_KEY               int      bigint
        INVENTORY_ON_HAND_QTY  double   decimal(38,2)
        INVENTORY_ON_ORDER_QTY double   decimal(38,2)
        OUT_OF_STOCK_FLG       int      bigint
        WASTE_QTY              double   decimal(38,2)
        PROMOTION_FLG          boolean  boolean
        NEXT_DELIVERY_DT       date     date
    """,
    "product": """
        PROD_KEY         int     bigint
        PROD_NAME        string  string
        VOL              double  decimal(38,2)
        WGT              double  decimal(38,2)
        BRAND_NAME       string  string
        STATUS_CODE      int     bigint
        STATUS_CODE_NAME string  string
        CATEGORY_KEY     int     bigint
        CATEGORY_NAME    string  string
        SUBCATEGORY_KEY  int     bigint
        SUBCATEGORY_NAME string  string
    """,
    "sales": """
        TRANS_ID    int     bigint
        PROD_KEY    int     bigint
        STORE_KEY   int     bigint
        TRANS_DT    date    date
        TRANS_TIME  int     bigint
        SALES_QTY   double  decimal(38,2)
        SALES_PRICE double  decimal(38,2)
        SALES_AMT   double  decimal(38,2)
        DISCOUNT    double  decimal(38,2)
        SALES_COST  double  decimal(38,2)
        SALES_MGRN  double  decimal(38,2)
        SHIP_COST   double  decimal(38,2)
    """,
    "store": """
        STORE_KEY       int            bigint
        STORE_NUM       int            varchar(30)
        STORE_DESC      string         varchar(150)
        ADDR            string         varchar(500)
        CITY            string         varchar(50)
        REGION          string         varchar(100)
        CNTRY_CD        string         varchar(30)
        CNTRY_NM        string         varchar(150)
        POSTAL_ZIP_CD   string         varchar(10)
        PROV_STATE_DESC string         varchar(30)
        PROV_STATE_CD   string         varchar(30)
        STORE_TYPE_CD   string         varchar(30)
        STORE_TYPE_DESC string         varchar(150)
        FRNCHS_FLG      string         boolean
        STORE_SIZE      string         decimal(19,3)
        MARKET_KEY      int            bigint
        MARKET_NAME     string         varchar(150)
        SUBMARKET_KEY   int            bigint
        SUBMARKET_NAME  string         varchar(150)
        LATITUDE        decimal(10,6)  decimal(19,6)
        LONGITUDE       decimal(10,6)  decimal(19,6)
    """,
}

# The order in which the tables are exported and audited.
EXPORT_ORDER = ("inventory", "sales", "store", "product", "calendar")

# The date column that limits a fact to what happened up to a day.
FACT_DATES = {"inventory": "CAL_DT", "sales": "TRANS_DT"}

_SIMPLE = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
}


def _data_type(text: str) -> T.DataType:
    if text.startswith("decimal("):
        precision, scale = text[len("decimal(") : -1].split(",")
        return T.DecimalType(int(precision), int(scale))
    if text.startswith("varchar("):
        return T.StringType()
    return _SIMPLE[text]


def _lines(table: str) -> list[tuple[str, str, str]]:
    rows = (line.split(None, 2) for line in _COLUMNS[table].strip().splitlines())
    return [(name, job, raw.strip()) for name, job, raw in rows]


def _struct(table: str, pick: int) -> T.StructType:
    return T.StructType(
        [
            T.StructField(row[0], _data_type(row[pick].removesuffix(" not null")))
            for row in _lines(table)
        ]
    )


TABLES = tuple(_COLUMNS)
JOB_SCHEMAS = {table: _struct(table, 1) for table in TABLES}
RAW_SCHEMAS = {table: _struct(table, 2) for table in TABLES}


def raw_ddl(table: str) -> str:
    """Column list of the raw table, with text lengths and NOT NULL."""
    return ", ".join(f"{name} {raw}" for name, _, raw in _lines(table))


def required_columns(table: str) -> list[str]:
    """Columns the raw table declares NOT NULL."""
    return [name for name, _, raw in _lines(table) if raw.endswith(" not null")]
