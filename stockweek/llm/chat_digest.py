"""What a formatted conversation holds, read back from its text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from stockweek.llm.chat import read_turns, unescape

_FIELDS = {
    "conv_id": pa.int64(),
    "n_turns": pa.int64(),
    "turns_sha256": pa.string(),
    "loss_chars": pa.int64(),
    "loss_sha256": pa.string(),
    "formatted_chars": pa.int64(),
}


class _Digest:
    """Running digests of a conversation's pieces."""

    def __init__(self, conv: int | None):
        self._conv = conv
        self._start()

    def _start(self) -> None:
        self._turns = self._loss_chars = self._chars = 0
        self._all, self._loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, learned: str | None, restart: bool) -> None:
        if restart:
            self._start()
        for role, text in read_turns(piece):
            self._all.update(f"{role}\n{text}\n".encode())
            self._turns += 1
        self._chars += len(piece)
        if learned is not None:
            text = unescape(learned)
            self._loss.update(text.encode())
            self._loss_chars += len(text)

    def row(self) -> tuple:
        return (
            self._conv,
            self._turns,
            self._all.hexdigest(),
            self._loss_chars,
            self._loss.hexdigest(),
            self._chars,
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest, current = None, object()
    for batch in _and_none(batches):
        done = []
        columns = [c.to_pylist() for c in batch.columns] if batch else []
        for conv, piece, learned, restart in zip(*columns, strict=True):
            if conv != current:
                done += [digest.row()] if digest else []
                current, digest = conv, _Digest(conv)
            digest.add(piece, learned, restart)
        if batch is None and digest:
            done.append(digest.row())
        if done:
            arrays = [
                pa.array(c, t) for c, t in zip(zip(*done, strict=True), _FIELDS.values(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=list(_FIELDS))


def _and_none(batches):
    yield from batches
    yield None


def conversation_digests(pieces: DataFrame) -> DataFrame:
    """Counts and digests per conversation, from rows that are still in its order.

    ``pieces`` has conv_id, piece, the learned part of the piece, and restart.
    """
    return pieces.mapInArrow(
        _digests,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
    )
