"""Byte-level BPE encoding and decoding with a sentencepiece model made from a rank file.

The model is serialised straight from the vocabulary: each token's bytes are
mapped to one printable character apiece and become a piece, scored by its
negative rank, with no normalisation. The best-scored merge is then the merge of
lowest rank, and a piece's id is its rank. Texts are first cut by the
vocabulary's pattern; each match is encoded by itself.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from stockweek.llm.columns import TextWork, as_bytes, map_texts

# The largest vocabulary that is sent to every executor, in bytes of its file.
MAX_VOCABULARY_BYTES = 16 << 20

# A task remembers so many different pre-tokens, then starts afresh.
CACHE_ENTRIES = 125_000

# Bytes of texts that are cut into pre-tokens together; and pre-tokens or ids of a longer
# text that are worked on at a time.
GROUP_BYTES = 1 << 18
ROUND_TOKENS = 1 << 16


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from a file of lines ``base64 rank``; ranks must have no gaps."""
    with open(path, "rb") as file:
        data = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    pairs = [line.split() for line in data.splitlines() if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))) or len(set(ranks.values())) != len(ranks):
        raise ValueError(f"{path}: ranks are not 0..n-1, each with a token of its own")
    if missing := set(range(256)) - {t[0] for t in ranks.values() if len(t) == 1}:
        raise ValueError(f"{path}: no token for {len(missing)} of the 256 bytes")
    return [ranks[i] for i in range(len(ranks))]


# One character per byte, none of them a space or special to sentencepiece.
BYTE_CHARS = "".join(chr(0x4E00 + b) for b in range(256))


def _mapped(token: bytes) -> str:
    return token.decode("latin-1").translate(BYTE_CHARS)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | bytes | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model, as its protocol buffer, whose ids are the ranks.

    Fixed values are the buffer's field numbers: of the model (1 piece, 2 trainer,
    3 normaliser), a piece (1 text, 2 score, 3 kind: 1 normal, 2 unknown), the
    trainer (3 kind of model: 2 BPE, 4 size, 40 to 43 ids of special pieces) and
    the normaliser (1 name, 3 add a space, 4 drop spaces, 5 escape spaces).
    """
    pieces = [
        _field(1, _field(1, _mapped(t).encode()) + _field(2, float(-rank)))
        for rank, t in enumerate(tokens)
    ]
    unknown = _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    none = (1 << 64) - 1
    trainer = (
        _field(3, 2)
        + _field(4, len(tokens) + 1)
        + _field(40, len(tokens))
        + b"".join(_field(n, none) for n in (41, 42, 43))
    )
    normaliser = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return b"".join(pieces) + unknown + _field(2, trainer) + _field(3, normaliser)


class _Encoder:
    """Ids of pre-tokens, as little-endian 32-bit integers; new ones are encoded together."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self._model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(tokens))
        # A pre-token in the vocabulary is that token, whatever the merges say.
        self._whole = {t: struct.pack("<I", rank) for rank, t in enumerate(tokens)}
        self._pattern = regex.compile(pattern)
        self._known: dict[str, bytes] = {}

    def texts(self, texts: list[str]) -> list[bytes]:
        return self._ids([self._pattern.findall(t) for t in texts])

    def long_text(self, text: str) -> bytes:
        """The same for one text, which is never held as pre-tokens whole."""
        cut = (found[0] for found in self._pattern.finditer(text))
        ids = bytearray()
        while tokens := list(islice(cut, ROUND_TOKENS)):
            ids += self._ids([tokens])[0]
        return bytes(ids)

    def _ids(self, cut: list[list[str]]) -> list[bytes]:
        if len(self._known) >= CACHE_ENTRIES:
            self._known.clear()
        known = self._known
        if new := list(set().union(*cut).difference(known)):
            raw = [token.encode() for token in new]
            made = self._model.encode([_mapped(r) for r in raw], num_threads=1)
            whole = self._whole.get
            known.update(
                (token, whole(r) or struct.pack(f"<{len(ids)}I", *ids))
                for token, r, ids in zip(new, raw, made, strict=True)
            )
        return [b"".join(map(known.__getitem__, tokens)) for tokens in cut]


def _groups(texts: pa.Array) -> Iterator[list[str]]:
    """The texts in lists of about ``GROUP_BYTES``; a longer text stands alone."""
    group, size = [], 0
    for raw in texts:
        raw = raw.as_buffer() if raw.is_valid else b""
        n = len(raw) if isinstance(raw, bytes) else raw.size
        if group and size + n > GROUP_BYTES:
            yield group
            group, size = [], 0
        group.append(str(memoryview(raw), "utf-8"))
        size += n
    if group:
        yield group


def _encode_work(tokens, pattern: str) -> TextWork:
    encoder = _Encoder(tokens.value, pattern)

    def encode(group: list[str]) -> list[bytes]:
        # Group by group, the pre-tokens of all texts together; those of a long text in rounds.
        alone = len(group) == 1 and len(group[0]) > GROUP_BYTES // 4
        return [encoder.long_text(group[0])] if alone else encoder.texts(group)

    def work(texts: pa.Array) -> list[pa.Array]:
        found = [ids for group in _groups(texts) for ids in encode(group)]
        return [pa.array([len(ids) // 4 for ids in found], pa.int64()), pa.array(found, pa.binary())]

    return work


def _decode_work(tokens) -> TextWork:
    token = tokens.value.__getitem__

    def decode(raw: bytes) -> bytes:
        ids, out = np.frombuffer(raw, "<u4"), bytearray()
        for at in range(0, len(ids), ROUND_TOKENS):
            out += b"".join(map(token, ids[at : at + ROUND_TOKENS].tolist()))
        return bytes(out)

    def work(ids: pa.Array) -> list[pa.Array]:
        return [pa.array([decode(raw) for raw in as_bytes(ids)], pa.binary())]

    return work


def _round_trip_work(tokens, pattern: str) -> TextWork:
    encode, decode = _encode_work(tokens, pattern), _decode_work(tokens)

    def work(texts: pa.Array) -> list[pa.Array]:
        count, ids = encode(texts)
        return [count, ids, *decode(ids)]

    return work


class ByteBpe:
    """A byte-level vocabulary, sent to the executors once and used for both directions."""

    def __init__(self, df: DataFrame, path: str, pattern: str):
        self._tokens = df.sparkSession.sparkContext.broadcast(read_ranks(path))
        self._pattern = pattern

    def encode(self, df: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
        """``keep``, ``n_tokens`` and ``token_bytes``: the ids as little-endian 32-bit integers.

        Every row stays, repeated ones too. A null text is encoded as an empty
        one: no tokens. No special token is ever made from text. An empty table gives an
        empty result. A long text is held a few times over, as text, ids and output, but
        not as pre-tokens. A result replaces a kept column of its name.
        """
        make = partial(_encode_work, self._tokens, self._pattern)
        return map_texts(df, text, keep, "n_tokens bigint, token_bytes binary", make)

    def round_trip(
        self, df: DataFrame, text: str = "text", keep: tuple[str, ...] = ()
    ) -> DataFrame:
        """What ``encode`` gives, and ``decoded``: what ``decode`` makes of those ids, in one pass."""
        make = partial(_round_trip_work, self._tokens, self._pattern)
        fields = "n_tokens bigint, token_bytes binary, decoded binary"
        return map_texts(df, text, keep, fields, make)

    def decode(
        self, df: DataFrame, ids: str = "token_bytes", keep: tuple[str, ...] = ()
    ) -> DataFrame:
        """``keep`` and ``decoded``: the bytes that the ids stand for; null ids are none."""
        make = partial(_decode_work, self._tokens)
        return map_texts(df, ids, keep, "decoded binary", make, kind="binary")

