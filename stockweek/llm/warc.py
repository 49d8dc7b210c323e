"""Pages written as WARC bundles by Spark's tasks, read back, and fetched by record.

Tasks write the pages that they read, so that no page is shuffled where the list of
repeated payloads is small enough to be sent to all of them. Every task writes bundles of
its own names and puts out a row for each record: where it is. Those rows are the
index; a bundle counts only if the index names it, so what a lost task has left is never
read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import UTC, datetime
from hashlib import sha1

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockweek.llm import warc_format as warc
from stockweek.llm.columns import bound_batches, col
from stockweek.session import scratch_dir

# Payloads of fewer bytes are written out each time.
MIN_SHARED_BYTES = 1000

# The list of repeated payloads is sent to all executors up to this many bytes.
BROADCAST_BYTES = 32 << 20

# Compressed bytes of frames that a task reads at a time.
READ_BYTES = 16 << 20

_INDEX = (
    "record_id string, record_type string, bundle string, frame int, frame_offset bigint, "
    "record_length bigint"
)
_PAGE = (
    "page_id string, record_id string, record_type string, payload_bytes bigint, "
    "payload_digest string, refers_to string, refers_to_id string, url string"
)
_PLACE = "bundle string, frame int, frame_offset bigint, record_length bigint"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder by its scheme, and the path in it."""
    if "://" not in path:
        path = path.removeprefix("file:")
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _payload(html: Column) -> Column:
    return F.coalesce(html.cast("string"), F.lit("")).cast("binary")


def _decided(pages: DataFrame) -> DataFrame:
    """Rows with the digest of their payload, and of shared ones the page that holds it."""
    digest = F.unhex(F.sha2("payload", 256))
    with_digest = pages.withColumn("digest", digest)
    long = F.octet_length("payload") >= MIN_SHARED_BYTES
    shared = (
        with_digest.filter(long)
        .groupBy("digest")
        .agg(F.struct(F.max("key").alias("key")).alias("owner"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", "owner")
    )
    path = scratch_dir(pages.sparkSession, "payloads")
    shared.write.parquet(path)
    shared = pages.sparkSession.read.parquet(path)
    key_bytes = F.coalesce(F.octet_length(F.col("owner.key").cast("string")), F.lit(0))
    size = shared.agg(F.sum(key_bytes + 80)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        shared = F.broadcast(shared)
    return with_digest.join(shared, "digest", "left")


def _writer(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        fs, base = file_system(folder)
        task = f"{TaskContext.get().partitionId():06}-{uuid.uuid4().hex}"
        bundle, writer, written, n = "", None, 0, 0
        for batch in batches:
            rows = []
            for key, url, html, digest, shared, owner in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if writer is None:
                    bundle = f"bundle-{task}-{written:04}.warc.zst"
                    writer = warc.BundleWriter(fs.open_output_stream(f"{base}/{bundle}", compression=None))
                    writer.add(warc.info_record(bundle, date))
                    written += 1
                revisit = shared and key != owner
                n += 1
                # A record that others refer to has an id that their writers know too.
                name = (digest.hex(), owner) if shared and not revisit else (bundle, n)
                page = warc.Page(
                    key,
                    warc.record_id(*name),
                    "revisit" if revisit else "response",
                    len(html),
                    sha1(html).hexdigest(),
                    owner if revisit else None,
                    warc.record_id(digest.hex(), owner) if revisit else None,
                    url,
                    html,
                )
                place = writer.add(warc.make_record(page, date))
                rows.append((page.record_id, page.record_type, f"{folder}/{bundle}", *place))
                if writer.packed > warc.BUNDLE_BYTES:
                    writer.close()
                    writer = None
            yield _batch(rows, _INDEX)
        if writer is not None:
            writer.close()

    return run


_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], fields: str) -> pa.RecordBatch:
    parts = [f.split(" ") for f in fields.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in parts]
    arrays = [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(columns, parts, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in parts])


def write_warc(
    df: DataFrame,
    folder: str | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: datetime | None = None,
) -> DataFrame:
    """Write a record for every row, dated ``date`` or now; the index of the records.

    Its columns: ``record_id``, ``record_type``, ``bundle``, ``frame``, ``frame_offset``
    and ``record_length``, the last two in bytes of the unpacked frame.

    The payload is the html as UTF-8, empty for null. Of rows with equal payloads of
    ``MIN_SHARED_BYTES`` or more, the one with the largest page id is the response, and
    the others are revisits that refer to it. A missing id is smaller than any other. Rows
    that share both payload and largest id are the same record, written each time under
    one record id. Shorter payloads are always responses. Payloads compare by their
    SHA-256. Ids may be of any type that has an order, and are written as text. Urls may
    hold any characters and be missing. A very long page has a frame to itself and is
    held whole by its task, a few times over. An empty table has an empty index and no
    bundle. Other columns are not read. ``folder`` must be a new one that all executors
    share; if not given, one under ``spark.checkpoint.dir`` is made.
    """
    spark = df.sparkSession
    folder = (folder or scratch_dir(spark, "warc")).rstrip("/")
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    bound_batches(spark)
    pages = df.select(
        col(page_id).alias("key"),
        col(url).cast("string").alias("url"),
        _payload(col(html)).alias("payload"),
    )
    rows = _decided(pages).select(
        F.col("key").cast("string"),
        "url",
        "payload",
        "digest",
        F.col("owner").isNotNull().alias("shared"),
        F.col("owner.key").cast("string").alias("owner"),
    )
    written = (date or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows.mapInArrow(_writer(folder, written), _INDEX).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def _open(bundle: str):
    fs, path = file_system(bundle)
    return fs.open_input_file(path)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of consecutive frames of every bundle."""
    fields = "bundle string, start bigint, length bigint, first int"
    for batch in batches:
        rows = []
        for bundle in batch.column(0).to_pylist():
            with _open(bundle) as file:
                frames = warc.read_frames(file, file.size())
            run: list[warc.Frame] = []
            for frame in [*frames, None]:
                if run and (frame is None or frame.start + frame.packed - run[0].start > READ_BYTES):
                    end = run[-1].start + run[-1].packed
                    rows.append((bundle, run[0].start, end - run[0].start, run[0].number))
                    run = []
                if frame is not None:
                    run.append(frame)
        yield _batch(rows, fields)


def _reader(fields: str, payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        for batch in batches:
            for chunk in batch.to_pylist():
                last = chunk["start"] + chunk["length"]
                with _open(chunk["bundle"]) as file:
                    for frame in warc.read_frames(file, file.size())[chunk["first"] :]:
                        if frame.start >= last:
                            break
                        rows = []
                        for at, head, block in warc.records(warc.read_frame(file, frame)):
                            page = warc.read_page(head, block)
                            if page:
                                where = (chunk["bundle"], frame.number, at, len(block))
                                rows.append((*page[:-1], *where, *([page.payload] if payload else [])))
                        yield _batch(rows, fields)

    return run


def read_warc(spark: SparkSession, bundles: DataFrame, payload: bool = False) -> DataFrame:
    """The records of the bundles that the ``bundle`` column names, each bundle once, as pages.

    Bundles are read from their own tables of frames, in runs of ``READ_BYTES`` that
    are dealt to tasks, so a large bundle is read by many. Columns: ``page_id`` as text, ``record_id``,
    ``record_type``, ``payload_bytes`` and ``payload_digest`` of the full payload, for
    revisits ``refers_to``, the response's page id, and ``refers_to_id``, its record id; ``url``;
    ``bundle``, ``frame``, ``frame_offset`` and ``block_length``; and with ``payload`` the bytes
    themselves, null for revisits. A payload that differs from its digest raises.
    """
    bound_batches(spark)
    fields = f"{_PAGE}, bundle string, frame int, frame_offset bigint, block_length bigint"
    fields += ", payload binary" if payload else ""
    names = bundles.select("bundle").distinct()
    chunks = names.mapInArrow(_chunks, "bundle string, start bigint, length bigint, first int")
    # Dealt in turn: a hash of few chunks would leave tasks without any.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return chunks.repartition(tasks).mapInArrow(_reader(fields, payload), fields)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of places sorted by bundle and frame, the pages; each frame is unpacked once."""
    name, file, frames, number, data = None, None, [], -1, b""
    for batch in batches:
        rows = []
        for bundle, frame, at, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bundle != name:
                if file:
                    file.close()
                name, file, number = bundle, _open(bundle), -1
                frames = warc.read_frames(file, file.size())
            if frame != number:
                number, data = frame, warc.read_frame(file, frames[frame])
            _, head, block = next(warc.records(data[at : at + length]))
            page = warc.read_page(head, block)
            rows.append((*page, bundle, frame, at, length))
        yield _batch(rows, f"{_PAGE}, payload binary, {_PLACE}")
    if file:
        file.close()


def fetch_records(index: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The pages of the records that the ``record_id`` column of ``record_ids`` names, with payloads.

    Only the frames that hold them are read. Columns: those of ``read_warc``, with
    ``record_length`` for the length. Ids that the index doesn't hold give no row, repeated ids one.
    """
    bound_batches(index.sparkSession)
    wanted = index.join(record_ids.select("record_id").distinct(), "record_id", "left_semi")
    places = wanted.select("bundle", "frame", "frame_offset", "record_length")
    dealt = places.repartition("bundle", "frame").sortWithinPartitions(*places.columns)
    schema = T.StructType.fromDDL(f"{_PAGE}, payload binary, {_PLACE}")
    return dealt.mapInArrow(_fetch, schema)
