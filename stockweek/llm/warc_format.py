"""WARC records, and bundles of them as seekable Zstandard files, without Spark.

A bundle is a run of independent Zstandard frames, each holding whole records, and a
skippable frame at the end with the compressed and uncompressed size of every
frame. Any Zstandard reader can read it from the start; one that knows the table can
go to a frame straight away.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from hashlib import sha1
from typing import BinaryIO, NamedTuple

import zstandard

# Uncompressed bytes after which a frame ends. A larger record has a frame to itself.
FRAME_BYTES = 1 << 20

# Compressed bytes after which a bundle ends.
BUNDLE_BYTES = 1 << 28

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_ENTRY, _FOOTER = "<II", "<IBI"
_ENTRY_BYTES, _FOOTER_BYTES = struct.calcsize(_ENTRY), struct.calcsize(_FOOTER)

_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Place(NamedTuple):
    """Where a record is: the frame's number, and bytes inside the uncompressed frame."""

    frame: int
    offset: int
    length: int


class Frame(NamedTuple):
    """Where a frame is in its bundle, and its sizes."""

    number: int
    start: int
    packed: int
    size: int


class Page(NamedTuple):
    """What a record says of its page."""

    page_id: str | None
    record_id: str
    record_type: str
    payload_bytes: int
    payload_digest: str
    refers_to: str | None
    refers_to_id: str | None
    url: str | None
    payload: bytes | None


def record_id(*parts: object) -> str:
    """A URN that is the same for the same parts."""
    name = "\0".join(map(str, parts))
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, name).urn}>"


def header_value(value: str) -> str:
    """A value for one header line: what could end the line, ``%`` and spaces at the ends are escaped."""
    if value.isascii() and value.isprintable() and "%" not in value and value.strip(" ") == value:
        return value
    out = "".join(
        c if c.isprintable() and c != "%" else "".join(f"%{b:02X}" for b in c.encode()) for c in value
    )
    inner = out.strip(" ")
    lead = len(out) - len(out.lstrip(" "))
    return "%20" * lead + inner + "%20" * (len(out) - lead - len(inner))


def read_value(value: str) -> str:
    """The text that ``header_value`` made this of."""
    if "%" not in value:
        return value
    raw, out, at = value.encode(), bytearray(), 0
    while at < len(raw):
        if raw[at] == 0x25:
            out.append(int(raw[at + 1 : at + 3], 16))
            at += 3
        else:
            out.append(raw[at])
            at += 1
    return out.decode()


def make_record(page: Page, date: str) -> bytes:
    """A response with its payload, or a revisit with the header of the response only."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {page.payload_bytes}\r\n\r\n"
    ).encode()
    block = http + (page.payload or b"") if page.record_type == "response" else http
    fields = [
        ("WARC-Type", page.record_type),
        ("WARC-Record-ID", page.record_id),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if page.url is None else header_value(page.url)),
        ("WARC-Payload-Digest", f"sha1:{page.payload_digest}"),
        ("WARC-Profile", _REVISIT if page.record_type == "revisit" else None),
        ("WARC-Refers-To", page.refers_to_id),
        ("Page-ID", None if page.page_id is None else header_value(page.page_id)),
        ("Refers-To-Page-ID", None if page.refers_to is None else header_value(page.refers_to)),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"
    return b"".join((head.encode(), block, b"\r\n\r\n"))


def info_record(name: str, date: str) -> bytes:
    """The record that opens a bundle."""
    block = b"format: WARC File Format 1.1\r\n"
    head = (
        f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {record_id('info', name)}\r\n"
        f"WARC-Date: {date}\r\nWARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\n"
        f"Content-Length: {len(block)}\r\n\r\n"
    )
    return b"".join((head.encode(), block, b"\r\n\r\n"))


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    parts = (line.partition(":") for line in lines if line)
    return {name.lower(): value.strip(" \t") for name, _, value in parts}


def records(data: bytes) -> Iterator[tuple[int, dict[str, str], memoryview]]:
    """Of the records of a frame: the offset, the header fields by lower-case name, and the block."""
    at, view = 0, memoryview(data)
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if data[at : at + 5] != b"WARC/" or end < 0:
            raise ValueError(f"no record at byte {at}")
        fields = _fields(data[at:end])
        begin, size = end + 4, int(fields["content-length"])
        if data[begin + size : begin + size + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut off")
        yield at, fields, view[begin : begin + size]
        at = begin + size + 4


def read_page(fields: dict[str, str], block: memoryview) -> Page | None:
    """The page of a record; None for a record of another type. A wrong digest raises."""
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    raw = bytes(block[:4096])
    end = raw.find(b"\r\n\r\n")
    size = int(_fields(raw[:end])["content-length"])
    payload = None
    if kind == "response":
        payload = bytes(block[end + 4 :])
        if len(payload) != size or sha1(payload).hexdigest() != digest:
            raise ValueError(f"the payload of {fields['warc-record-id']} is not what was written")
    text = lambda name: None if name not in fields else read_value(fields[name])
    return Page(
        text("page-id"),
        fields["warc-record-id"],
        kind,
        size,
        digest,
        text("refers-to-page-id"),
        fields.get("warc-refers-to"),
        text("warc-target-uri"),
        payload,
    )


class BundleWriter:
    """Records put into frames of a file, one after the other."""

    def __init__(self, file: BinaryIO):
        self._file, self._sizes = file, []
        self._open, self._size, self.packed = [], 0, 0
        self._zstd = zstandard.ZstdCompressor(level=3)

    def add(self, record: bytes) -> Place:
        if self._open and self._size + len(record) > FRAME_BYTES:
            self._end_frame()
        place = Place(len(self._sizes), self._size, len(record))
        self._open.append(record)
        self._size += len(record)
        return place

    def _end_frame(self) -> None:
        packed = self._zstd.compress(b"".join(self._open))
        self._file.write(packed)
        self._sizes.append((len(packed), self._size))
        self._open, self._size = [], 0
        self.packed += len(packed)

    def close(self) -> None:
        """Write what is left, and the table of the frames."""
        if self._open:
            self._end_frame()
        table = b"".join(struct.pack(_ENTRY, *s) for s in self._sizes)
        table += struct.pack(_FOOTER, len(self._sizes), 0, SEEKABLE)
        self._file.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self._file.close()


def read_frames(file: BinaryIO, size: int) -> list[Frame]:
    """The frames of a bundle of ``size`` bytes, from the table at its end."""
    file.seek(max(0, size - _FOOTER_BYTES))
    tail = file.read(_FOOTER_BYTES)
    if len(tail) < _FOOTER_BYTES or struct.unpack(_FOOTER, tail)[2] != SEEKABLE:
        raise ValueError("the bundle has no table of frames")
    count, flags, _ = struct.unpack(_FOOTER, tail)
    width = _ENTRY_BYTES + (4 if flags & 0x80 else 0)  # other writers may add checksums
    file.seek(size - _FOOTER_BYTES - count * width)
    table = file.read(count * width)
    frames, start = [], 0
    for number in range(count):
        packed, length = struct.unpack_from(_ENTRY, table, number * width)
        frames.append(Frame(number, start, packed, length))
        start += packed
    return frames


def read_frame(file: BinaryIO, frame: Frame) -> bytes:
    """The records of one frame, nothing else of the bundle being read."""
    file.seek(frame.start)
    return zstandard.ZstdDecompressor().decompress(file.read(frame.packed), max_output_size=frame.size)
