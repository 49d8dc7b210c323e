"""Running a function over the texts of a table, batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TextWork = Callable[[pa.Array], list[pa.Array]]


def col(name: str):
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(taken: Sequence[str], wanted: str) -> str:
    """``wanted``, or with underscores added until no column has that name."""
    lower = {name.lower() for name in taken}
    while wanted.lower() in lower:
        wanted += "_"
    return wanted


def without(keep: Sequence[str], added: Sequence[str]) -> list[str]:
    """The ``keep`` columns that no added one replaces; names compare without case."""
    lower = {name.lower() for name in added}
    return [name for name in keep if name.lower() not in lower]


def own_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns c0, c1..., which no result's name equals, and those names by the old ones."""
    names = {name: f"c{i}" for i, name in enumerate(df.columns)}
    return df.select(*(col(name).alias(own) for name, own in names.items())), names


def integer_id(df: DataFrame, name: str) -> Column:
    """An id column as bigint. Ids are integers; a column of another type is refused at once."""
    kind = df.schema[name].dataType
    if not isinstance(kind, (T.IntegralType, T.NullType)):
        raise TypeError(f"ids must be integers, but {name} is {kind.simpleString()}")
    return col(name).cast("bigint")


# Bytes of texts that a task takes at a time.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Let batches for Python end at ``BATCH_BYTES``, unless the session has a bound of its own."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(setting, None) is None:
        spark.conf.set(setting, str(BATCH_BYTES))


def give_back() -> None:
    """Return to the system what freed objects leave in a task's process, which later tasks use again."""
    pa.system_memory_pool().release_unused()


def map_texts(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    fields: str,
    make: Callable[[], TextWork],
    kind: str = "string",
    beside: Sequence[str] = (),
) -> DataFrame:
    """The ``keep`` columns of every row, and ``fields`` made from its text.

    ``make`` runs once per task; what it returns gets the texts of a batch, nulls
    included, as large binary, and returns one array per field. A field replaces a
    kept column of the same name; other columns are not read, so theirs can't clash.
    ``kind`` is the type that the text column is read as, string or binary. With
    ``beside``, the work gets a batch of those columns and the text, the text last.
    """
    added = T.StructType.fromDDL(fields).fields
    keep = without(keep, [f.name for f in added])
    schema = T.StructType([df.schema[name] for name in keep] + added)
    names, types, n = schema.names, [_arrow_type(f.dataType) for f in added], len(keep)
    columns = [*keep, *beside]
    # A text that is kept as well goes to the task once.
    once = text in keep and df.schema[text].dataType.simpleString() == kind
    at = columns.index(text) if once else len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Arrow's own pool would keep what batches leave; the system's gives it back.
        pa.set_memory_pool(pa.system_memory_pool())
        work = make()
        for batch in batches:
            given = batch.column(at).cast(pa.large_binary())
            if beside:
                more = batch.columns[n : n + len(beside)]
                given = pa.RecordBatch.from_arrays([*more, given], names=[*beside, "text"])
            made = [a.cast(t) for a, t in zip(work(given), types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *made], names=names)
            del given, made
            give_back()
        del work
        give_back()

    bound_batches(df.sparkSession)
    inputs = [col(name).alias(f"c{i}") for i, name in enumerate(columns)]
    inputs += [] if once else [col(text).cast(kind).alias("text")]
    return df.select(*inputs).mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    simple = {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
        "string": pa.string(),
        "binary": pa.binary(),
        "array<bigint>": pa.list_(pa.int64()),
        "array<int>": pa.list_(pa.int32()),
    }
    return simple[kind.simpleString()]


def as_bytes(texts: pa.Array) -> list[bytes]:
    """The texts as UTF-8; a null is empty."""
    return [t or b"" for t in texts.to_pylist()]
