import io
import struct
from hashlib import sha1
from pathlib import Path

import pytest
import zstandard
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockweek.llm import warc, warc_format

SCHEMA = "page_id bigint, url string, html string, record_id string, bundle string, payload string"

LONG = "<p>ö&amp; " + "long page " * 200


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(3)


def pages():
    return [
        (1, "http://a/1", LONG),
        (9, "http://a/9", LONG),
        (4, None, LONG),
        (None, "http://a/none", LONG),
        (2, "http://a/2\r\nWARC-Type: x\r\n\r\n", "short"),
        (3, "http://a/3", "short"),
        (5, "", None),
        (6, " http://ö/%41  ", ""),
        (7, "u", "é" * 500),
        (8, "u", "é" * 500),
        (10, "u", "é" * 499),
        (11, "u", "é" * 499),
        (12, "u", "WARC/1.1\r\n\r\n" * 300_000),
        (13, "u", "repeated row " * 100),
        (13, "u", "repeated row " * 100),
        (None, None, "no ids at all " * 100),
        (None, None, "no ids at all " * 100),
        (14, "u", "\0\r\n\r\n" + "x" * 2000),
    ]


def expected(rows):
    out = []
    for i, url, html in rows:
        payload = (html or "").encode()
        ids = [j for j, _, other in rows if (other or "").encode() == payload]
        largest = max((j for j in ids if j is not None), default=None)
        again = len(payload) >= 1000 and i != largest
        out.append(
            (
                None if i is None else str(i),
                len(payload),
                sha1(payload).hexdigest(),
                "revisit" if again else "response",
                str(largest) if again else None,
                url,
                None if again else payload,
            )
        )
    return sorted(out, key=str)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload")


def held(rows):
    return sorted(
        (tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in rows), key=str
    )


@pytest.fixture(params=["broadcast", "shuffled", "small"])
def limits(request, monkeypatch):
    if request.param == "shuffled":
        monkeypatch.setattr(warc, "BROADCAST_BYTES", -1)
    if request.param == "small":
        monkeypatch.setattr(warc_format, "FRAME_BYTES", 3000)
        monkeypatch.setattr(warc_format, "BUNDLE_BYTES", 500)
        monkeypatch.setattr(warc, "READ_BYTES", 300)


def test_what_is_written_is_read_back(spark, limits, tmp_path):
    df = table(spark, pages())
    index = warc.write_warc(df, str(tmp_path / "out"))
    found = warc.read_warc(spark, index, payload=True)
    assert held(found.select(*COLUMNS).collect()) == expected(pages())
    if warc_format.FRAME_BYTES == 3000:
        assert index.select("bundle").distinct().count() > 3
        assert index.select("bundle", "frame").distinct().count() > 6
    places = [c for c in index.columns if c in ("record_id", "bundle", "frame", "frame_offset")]
    rows = [tuple(r) for r in found.select(*places).collect()]
    assert sorted(rows) == sorted(tuple(r) for r in index.select(*places).collect())
    responses = {r["record_id"] for r in found.filter("record_type = 'response'").collect()}
    assert {r[0] for r in found.select("refers_to_id").collect()} - {None} <= responses


def test_single_records_are_fetched_through_the_index(spark, limits, tmp_path):
    index = warc.write_warc(table(spark, pages()), str(tmp_path / "out"))
    everything = warc.read_warc(spark, index, payload=True)
    ids = [r[0] for r in index.select("record_id").collect()]
    wanted = spark.createDataFrame([(i,) for i in [*ids[::3], ids[0], "<urn:none>"]], "record_id string")
    found = warc.fetch_records(index, wanted)
    assert held(found.select(*COLUMNS).collect()) == held(
        everything.join(wanted.distinct(), "record_id").select(*COLUMNS).collect()
    )


def test_bundles_are_ordinary_zstandard_files(spark, tmp_path):
    warc.write_warc(table(spark, pages()), str(tmp_path / "out"))
    whole = b""
    for path in sorted(Path(tmp_path / "out").glob("*.warc.zst")):
        with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(path.read_bytes()), read_across_frames=True) as r:
            whole += r.read()
    kinds = [head["warc-type"] for _, head, _ in warc_format.records(whole)]
    assert kinds.count("response") + kinds.count("revisit") == len(pages())
    assert kinds[0] == "warcinfo"


def test_what_a_lost_task_left_is_not_read(spark, tmp_path):
    index = warc.write_warc(table(spark, pages()), str(tmp_path / "out"))
    (tmp_path / "out" / "bundle-000000-lost-0000.warc.zst").write_bytes(b"half a frame")
    assert warc.read_warc(spark, index).count() == len(pages())


def test_empty_table(spark, tmp_path):
    index = warc.write_warc(table(spark, []), str(tmp_path / "out"))
    assert index.count() == 0 and warc.read_warc(spark, index).collect() == []
    assert warc.fetch_records(index, index).collect() == []


def test_changed_bytes_are_noticed():
    page = warc_format.Page("1", "<urn:a>", "response", 3, sha1(b"abc").hexdigest(), None, None, "u", b"abc")
    record = warc_format.make_record(page, "2024-01-01T00:00:00Z")
    [(_, head, block)] = warc_format.records(record)
    assert warc_format.read_page(head, block) == page
    [(_, head, block)] = warc_format.records(record.replace(b"abc", b"abd"))
    with pytest.raises(ValueError, match="not what was written"):
        warc_format.read_page(head, block)
    with pytest.raises(ValueError, match="cut off"):
        list(warc_format.records(record[:-1]))


class Kept(io.BytesIO):
    def close(self):
        pass


@given(st.lists(st.binary(max_size=300), max_size=30))
def test_frames_by_the_table_at_the_end(parts):
    file = Kept()
    writer = warc_format.BundleWriter(file)
    size, warc_format.FRAME_BYTES = warc_format.FRAME_BYTES, 500
    try:
        places = [writer.add(p) for p in parts]
        writer.close()
    finally:
        warc_format.FRAME_BYTES = size
    data = file.getvalue()
    frames = warc_format.read_frames(file, len(data))
    for part, place in zip(parts, places, strict=True):
        frame = warc_format.read_frame(file, frames[place.frame])
        assert frame[place.offset : place.offset + place.length] == part
    assert struct.unpack("<I", data[-4:])[0] == 0x8F92EAB1
    assert sum(f.size for f in frames) == sum(map(len, parts))


@given(st.text())
def test_header_values_come_back(text):
    value = warc_format.header_value(text)
    assert "\r" not in value and "\n" not in value and value.strip(" \t") == value
    assert warc_format.read_value(value) == text


def test_ids_of_other_types(spark, tmp_path):
    df = table(spark, pages()).withColumn("page_id", F.concat(F.lit("p%\n"), "page_id"))
    found = warc.read_warc(spark, warc.write_warc(df, str(tmp_path / "out")))
    refers = {r["refers_to"] for r in found.filter("record_type = 'revisit'").collect()}
    assert refers == {"p%\n9", "p%\n8"}
