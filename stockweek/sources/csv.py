"""Typed CSV scans."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockweek.functions.nulls import fill_nulls
from stockweek.sources.schemas import JOB_SCHEMAS

# One CSV format for every reader and writer: comma, one header line.
CSV_FORMAT = {"sep": ",", "header": "true"}


def read_csv(
    spark: SparkSession, table: str, path: str | list[str], null_value: str | None = None
) -> DataFrame:
    """Rows of a table's CSV, columns by position; a field that does not parse is null.

    ``null_value`` names a text to read as null, such as ``\\N``. By default only
    the empty field is null.
    """
    reader = spark.read.options(**CSV_FORMAT).schema(JOB_SCHEMAS[table])
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(path)


def read_table(
    spark: SparkSession, table: str, path: str | list[str], null_value: str | None = None
) -> DataFrame:
    """The CSV scan followed by null normalisation, as the mart job reads its inputs."""
    return fill_nulls(read_csv(spark, table, path, null_value))


# The scan's column for lines that are not what the schema says, and the fields of such a line.
_LINE, _FIELDS, _MORE = "_line_that_is_bad", "_fields_as_text", "_fields_and_one_more"

TOO_FEW, TOO_MANY, NO_VALUE = "too few fields", "too many fields", "does not parse"


def _with_bad_lines(
    spark: SparkSession, table: str, path: str | list[str], null_value: str | None
) -> DataFrame:
    """The typed scan; a line with a bad field, or too few or many, is there as text besides."""
    schema = T.StructType([*JOB_SCHEMAS[table].fields, T.StructField(_LINE, T.StringType())])
    reader = spark.read.options(**CSV_FORMAT).schema(schema)
    # Of a line that is parsed in part only, the parser does not know how many fields it has.
    reader = reader.option("columnNameOfCorruptRecord", _LINE).option("columnPruning", "false")
    options = {"sep": CSV_FORMAT["sep"], "columnNameOfCorruptRecord": _LINE}
    if null_value is not None:
        reader, options["nullValue"] = reader.option("nullValue", null_value), null_value
    # As text every field parses, so only lines of other than so many fields are bad then.
    texts = "".join(f"{name} string, " for name in JOB_SCHEMAS[table].fieldNames())
    more = f"{texts}{_MORE} string, {_LINE} string"
    return reader.csv(path).withColumns(
        {
            _FIELDS: F.from_csv(_LINE, f"{texts}{_LINE} string", options),
            _MORE: F.from_csv(_LINE, more, options),
        }
    )


def _problems(table: str) -> dict[tuple[str | None, str], Column]:
    """For each column that may not parse, and for the lines, how many do not."""
    other = F.col(f"{_FIELDS}.{_LINE}").isNotNull()
    one_more = F.col(f"{_MORE}.{_LINE}").isNull() | F.col(f"{_MORE}.{_MORE}").isNotNull()
    # Several empty fields at the end of a line show in its separators alone.
    n_fields = F.length(_LINE) - F.length(F.replace(_LINE, F.lit(CSV_FORMAT["sep"]), F.lit(""))) + 1
    empty_end = F.endswith(_LINE, F.lit(2 * CSV_FORMAT["sep"])) & (n_fields > len(JOB_SCHEMAS[table].fields))
    many = one_more | empty_end
    found = {(None, TOO_FEW): other & ~many, (None, TOO_MANY): other & many}
    for field in JOB_SCHEMAS[table].fields:
        if not isinstance(field.dataType, T.StringType):
            given = F.col(f"{_FIELDS}.{field.name}").isNotNull()
            found[field.name, NO_VALUE] = F.col(field.name).isNull() & given
    return {key: F.count_if(bad) for key, bad in found.items()}


_REPORT = "TABLE_NAME string, COLUMN_NAME string, PROBLEM string, N bigint"


def parse_report(
    spark: SparkSession, table: str, path: str | list[str], null_value: str | None = None
) -> DataFrame:
    """What the scan of a table's CSV turns to null or leaves out: a count for each column and problem.

    One pass without a shuffle of rows. Columns of text have no row, they take any field. A
    field beyond the last column is dropped by the scan, a missing one is null; both
    are counted by line, without a column.
    """
    problems = _problems(table)
    names = [F.struct(F.lit(c).alias("c"), F.lit(p).alias("p"), n.alias("n")) for (c, p), n in problems.items()]
    counts = _with_bad_lines(spark, table, path, null_value).agg(F.array(*names).alias("counts"))
    return counts.select(F.explode("counts").alias("x")).select(
        F.lit(table).alias("TABLE_NAME"),
        F.col("x.c").alias("COLUMN_NAME"),
        F.col("x.p").alias("PROBLEM"),
        F.col("x.n").alias("N"),
    )


class ObservedScan:
    """A table scanned as ``read_table`` does, which counts what did not parse on the way.

    ``rows`` is the table. Once a job has read it, ``report`` has the counts, without another
    pass. The whole line has to be parsed for it, so columns are not pruned. A task that
    is run again because an executor was lost may count its part twice; ``parse_report`` does
    not, at the price of a pass.
    """

    def __init__(
        self,
        spark: SparkSession,
        table: str,
        path: str | list[str],
        null_value: str | None = None,
    ):
        self._problems, self._seen = _problems(table), Observation()
        self._table, self._counted_alone = table, parse_report(spark, table, path, null_value)
        counts = [n.alias(f"n{i}") for i, n in enumerate(self._problems.values())]
        scan = _with_bad_lines(spark, table, path, null_value).observe(self._seen, *counts)
        self.rows = fill_nulls(scan.drop(_LINE, _FIELDS, _MORE))

    def report(self) -> list[tuple[str, str | None, str, int]]:
        """Rows as those of ``parse_report``; waits for the job that reads the table."""
        try:
            counts = self._seen.get
        except Py4JJavaError:
            # Spark leaves an observed scan out of a plan whose result it finds to be empty.
            return [tuple(row) for row in self._counted_alone.collect()]
        return [(self._table, *key, int(counts[f"n{i}"])) for i, key in enumerate(self._problems)]


def report_table(spark: SparkSession, scans: list[ObservedScan]) -> DataFrame:
    """The reports of several scans in one table."""
    return spark.createDataFrame([row for scan in scans for row in scan.report()], _REPORT)
