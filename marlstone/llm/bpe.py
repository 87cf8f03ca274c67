"""Byte-level BPE over Arrow batches: encoding with offsets, and decoding.

A rank file (one base64 token and its rank per line) becomes a vocabulary of
the tokenizers library: every byte is written as one printable character, and
each way to join two tokens into a third is a merge, in the order of ranks.
Texts are cut by the pattern; the library encodes each new piece once per
worker, and batches are put together from the pieces' ids by array operations.

Offsets come from the lengths of the tokens in bytes, mapped to characters; a
character that is split between tokens belongs to each of them.  Decoding
looks up the bytes of every id; only whole byte strings are read as UTF-8, so
split characters come back.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE

#: Most pieces and characters that a worker remembers between batches.
REMEMBER, REMEMBER_CHARS = 1 << 19, 1 << 24


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte.

    Fixed by the format: visible Latin-1 characters stand for themselves, the
    other bytes are numbered from 256 on.
    """
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Coder:
    """Pieces of text to ids and back, for one rank file and pattern."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.alphabet = byte_alphabet()
        spelled = {token: "".join(self.alphabet[b] for b in token) for token in ranks}
        merges = []
        for token in sorted(ranks, key=ranks.__getitem__):
            joins = [(token[:i], token[i:]) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
            joins.sort(key=lambda pair: max(ranks[pair[0]], ranks[pair[1]]))
            merges += [(spelled[a], spelled[b]) for a, b in joins]
        # A piece that is a token as a whole is taken as it is.
        self.library = Tokenizer(BPE(vocab={spelled[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
        self.pattern = regex.compile(pattern)
        self.token_length = byte_table(path).length
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.chars = 0
        self.ids = np.zeros(0, np.int32)
        self.bounds = np.zeros(1, np.int64)

    def learn(self, pieces: list[str]) -> None:
        """Encode the pieces that this worker has not met yet."""
        new = [p for p in dict.fromkeys(pieces) if p not in self.place]
        if not new:
            return
        written = ["".join(map(self.alphabet.__getitem__, p.encode())) for p in new]
        found = [e.ids for e in self.library.encode_batch_fast(written, add_special_tokens=False)]
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
        self.chars += sum(map(len, new))
        self.ids = np.concatenate([self.ids, *[np.array(x, np.int32) for x in found]])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum([len(x) for x in found])])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the offsets of each text among them."""
        if len(self.place) > REMEMBER or self.chars > REMEMBER_CHARS:
            self.forget()
        pieces: list[str] = []
        counts = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            pieces += self.pattern.findall(text)
            counts[i + 1] = len(pieces)
        self.learn(pieces)
        used = np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))
        begin, size = self.bounds[used], self.bounds[used + 1] - self.bounds[used]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])
        return self.ids[at], ends[counts]


class ByteTable:
    """The bytes of every id, the byte table reversed."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        by_id = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            by_id[rank] = token
        self.bytes = pa.array(by_id, pa.large_binary())
        self.length = np.array([len(t) for t in by_id], dtype=np.int64)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """Bytes of each stretch of ids."""
        if not len(ids):
            return pa.array([b""] * (len(bounds) - 1), pa.large_binary())
        # take() lays the tokens' bytes side by side, so only the offsets are new
        joined = self.bytes.take(pa.array(ids))
        ends = np.concatenate([[0], np.cumsum(self.length[ids])])[bounds]
        return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(ends.astype(np.int64)), joined.buffers()[2]])


@cache
def coder(path: str, pattern: str = public_tokenizers.PATTERN) -> Coder:
    """The worker's coder; built once, its memory of pieces stays with the worker."""
    return Coder(path, pattern)


@cache
def byte_table(path: str) -> ByteTable:
    return ByteTable(path)


def _char_offsets(texts: list[str], lengths: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last character of every token, within its text."""
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    char_of = np.cumsum((data & 0xC0) != 0x80)  # number of the character each byte belongs to, from 1
    ends = np.cumsum(lengths)
    first, past = char_of[ends - lengths] - 1, char_of[ends - 1]
    base = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]]) if texts else np.zeros(0, np.int64)
    shift = np.repeat(base, np.diff(bounds))
    return (first - shift).astype(np.int32), (past - shift).astype(np.int32)


def _encoder(path: str, pattern: str, text: str, offsets: bool, step: int = 512) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                texts = [t or "" for t in batch.column(text).to_pylist()]
                ids, bounds = own.encode(texts)
                listed = lambda x: pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(x))  # noqa: E731, B023
                made = [listed(ids.astype(np.int32))]
                if offsets:
                    made += map(listed, _char_offsets(texts, own.token_length[ids], bounds))
                kept = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != text]
                yield pa.RecordBatch.from_arrays([*kept, *made], [n for n in batch.schema.names if n != text] + ["ids", "starts", "stops"][: len(made)])

    return run


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", pattern: str = public_tokenizers.PATTERN, offsets: bool = True) -> DataFrame:
    """``doc_id`` and the array ``ids`` of each row; with ``offsets`` also ``starts`` and ``stops``.

    Offsets count characters, ends exclusive.  Null texts count as empty and
    have no ids; special strings inside texts are ordinary text.  Only ``id``
    and ``text`` are read, so other columns may have any name.
    """
    body = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(body.dtypes)["doc_id"]
    schema = f"doc_id {kind}, ids array<int>" + ", starts array<int>, stops array<int>" * offsets
    return body.mapInArrow(_encoder(path, pattern, "text", offsets), schema)


def _decoder(path: str, text: bool, step: int = 512) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = byte_table(path)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                lists = batch.column("ids")
                lengths = lists.value_lengths().fill_null(0).to_numpy()
                bounds = np.concatenate([[0], np.cumsum(lengths)])
                out = own.decode(lists.flatten().to_numpy(), bounds)
                made = [out.cast(pa.binary())]
                if text:
                    made.append(pa.array([x.decode("utf-8", "replace") for x in out.to_pylist()], pa.string()))
                kept = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "ids"]
                yield pa.RecordBatch.from_arrays([*kept, *made], [n for n in batch.schema.names if n != "ids"] + ["decoded", "decoded_text"][: len(made)])

    return run


def decode(encoded: DataFrame, path: str, text: bool = True) -> DataFrame:
    """Replace the column ``ids`` by ``decoded`` (bytes) and, with ``text``, ``decoded_text``.

    Null id arrays count as empty.  In ``decoded_text`` bytes that are no
    UTF-8, as at the edge of a cut sequence, become U+FFFD.
    """
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields if f.name != "ids")
    schema = f"{kept}, decoded binary" + ", decoded_text string" * text
    return encoded.mapInArrow(_decoder(path, text), schema)
