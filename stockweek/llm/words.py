"""Tokens of many texts at once: byte classes, token borders and 64-bit token hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

from stockweek.llm.perfect_hash import mix

# Bytes worked on at a time; a longer text is taken in pieces cut between tokens.
SEGMENT = 1 << 18

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_powers = {}


def byte_classes(*ranges: tuple[int, int, int]) -> np.ndarray:
    """A table of byte classes from (first, last, class); all other bytes are class 0, gaps."""
    table = np.zeros(256, np.uint8)
    for first, last, kind in ranges:
        table[first : last + 1] = kind
    return table


#: Digits, letters (lower-cased first) and all that is not ASCII.
LETTERS_AND_DIGITS = byte_classes((0x30, 0x39, 1), (0x61, 0x7A, 1), (0x80, 0xFF, 1))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers.get("n", -1) < n:
        size = max(n, SEGMENT + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
        _powers["n"] = size
    return _powers["up"][:n], _powers["down"]


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges: equal bytes, equal hashes."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def _pieces(raw: bytes, classes: np.ndarray) -> Iterator[bytes]:
    """A long text in pieces that end in a gap."""
    at = 0
    while len(raw) - at > SEGMENT:
        size = SEGMENT
        while True:
            gaps = np.flatnonzero(classes[np.frombuffer(raw, np.uint8, min(size, len(raw) - at), at)] == 0)
            if len(gaps) or at + size >= len(raw):
                break
            size *= 2
        end = at + int(gaps[-1]) + 1 if len(gaps) else len(raw)
        yield raw[at:end]
        at = end
    yield raw[at:]


def segments(texts: Sequence[bytes], classes: np.ndarray) -> Iterator[tuple[bytes, list[int], list[int]]]:
    """Joined texts, the place of each in them, and its number; texts are one space apart."""
    parts, starts, owners, size = [], [], [], 0
    for number, raw in enumerate(texts):
        for piece in _pieces(raw, classes) if len(raw) > SEGMENT else (raw,):
            if parts and size + len(piece) > SEGMENT:
                yield b" ".join(parts), starts, owners
                parts, starts, owners, size = [], [], [], 0
            parts.append(piece)
            starts.append(size)
            owners.append(number)
            size += len(piece) + 1
    if parts:
        yield b" ".join(parts), starts, owners


def token_borders(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of one class, gaps left out."""
    change = np.flatnonzero(kinds[1:] != kinds[:-1]) + 1
    starts = np.concatenate([[0], change])
    ends = np.concatenate([change, [len(kinds)]])
    tokens = kinds[starts] != 0
    return starts[tokens], ends[tokens]


def hashed_tokens(
    texts: Sequence[bytes], classes: np.ndarray, fold: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of all tokens in order, in parts: the number of their text, and their hash.

    ``classes`` must make the space a gap. ``fold`` replaces bytes before they are
    classed and hashed.
    """
    if fold is not None:
        classes = classes[fold]
    for joined, starts, owners in segments(texts, classes):
        data = np.frombuffer(joined, np.uint8)
        if not len(data):
            continue
        begin, end = token_borders(classes[data])
        if fold is not None:
            data = fold[data]
        owner = np.array(owners)[np.searchsorted(starts, begin, side="right") - 1]
        yield owner, range_hashes(data, begin, end)
