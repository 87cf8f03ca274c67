"""Language identification by a small convolutional network over bytes.

Filters of several widths slide over one-hot bytes of a window; each filter
keeps its largest response in the window, and a softmax layer over those gives
the language.  The network is trained here, in numpy, on windows cut from
labelled texts.  A text is cut into windows of fixed length from end to end;
its score is the softmax of the mean response of all its windows.

A response is a sum of one table entry per byte under the filter.  For
prediction the tables of two neighbouring bytes are added up beforehand, so a
filter of width four takes two look-ups.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .textbytes import buffers, slices

WIDTHS, FILTERS, WINDOW = (2, 3, 4), 16, 256
#: Windows that one language gives to the training at most, and those that a document offers.
#: Up to 1,000 Spark lets each task keep its own first rows of a language before anything is shuffled.
PER_LANGUAGE, PER_DOCUMENT = 900, 8
UNKNOWN = "und"


@dataclass(frozen=True)
class Network:
    """``filters[w]`` is (w, 256, FILTERS); ``dense`` and ``bias`` lead to ``languages``."""

    languages: tuple[str, ...]
    filters: dict[int, np.ndarray]
    dense: np.ndarray
    bias: np.ndarray


def windows(data: np.ndarray, offsets: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All windows (n, size) of every text, the last filled with blanks, and each one's text."""
    count = -(-np.diff(offsets) // size)
    text_of = np.repeat(np.arange(len(count)), count)
    first = offsets[:-1][text_of] + size * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    at = first[:, None] + np.arange(size)
    inside = at < offsets[1:][text_of][:, None]
    return np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else np.uint8(32), np.uint8(32)), text_of


def _responses(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Responses (n, places, FILTERS) of the filters of one width to windows ``x``."""
    places = x.shape[1] - len(table) + 1
    out = np.zeros((len(x), places, table.shape[2]), dtype=np.float32)
    for j, entries in enumerate(table):
        out += entries[x[:, j : j + places]]
    return out


def train(x: np.ndarray, y: np.ndarray, languages: tuple[str, ...], steps: int = 600, batch: int = 64, rate: float = 0.01, seed: int = 7) -> Network:
    """Fit by ``steps`` gradient steps (Adam) on the cross-entropy; the same input gives the same network."""
    rng = np.random.default_rng(seed)
    filters = {w: rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    weights = [*filters.values(), rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32)]
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in weights]
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1 if len(x) else 1):
        if not len(order):
            order = rng.permutation(len(x))
        rows, order = order[:batch], order[batch:]
        for p, (m, v), g in zip(weights, moment, _gradients(x[rows], y[rows], weights), strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(languages, filters, weights[-2], weights[-1])


def _gradients(x: np.ndarray, y: np.ndarray, weights: list[np.ndarray]) -> list[np.ndarray]:
    tables, dense, bias = weights[:-2], weights[-2], weights[-1]
    pooled, best = [], []
    for table in tables:
        found = _responses(x, table)
        best.append(found.argmax(axis=1))
        pooled.append(np.take_along_axis(found, best[-1][:, None], axis=1)[:, 0])
    raw = np.concatenate(pooled, axis=1)
    hidden = np.maximum(raw, 0)
    wrong = softmax(hidden @ dense + bias)
    wrong[np.arange(len(y)), y] -= 1
    wrong /= len(y)
    back = (wrong @ dense.T) * (raw > 0)
    out = []
    for k, table in enumerate(tables):
        grad, own = np.zeros_like(table), back[:, k * FILTERS : (k + 1) * FILTERS]
        # Only the place with the largest response has a part in it.
        for j in range(len(table)):
            under = np.take_along_axis(x, best[k] + j, axis=1)
            np.add.at(grad[j], (under, np.arange(FILTERS)), own)
        out.append(grad)
    return [*out, hidden.T @ wrong, wrong.sum(axis=0)]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Reader:
    """The network with its tables for pairs of bytes."""

    def __init__(self, net: Network):
        self.net = net
        pair = lambda a, b: (a[:, None] + b[None]).reshape(65536, -1)
        # Per width: (offset, table over pairs) and, for odd widths, (offset, table over bytes).
        self.pairs = {w: [(j, pair(t[j], t[j + 1])) for j in range(0, w - 1, 2)] for w, t in net.filters.items()}
        self.last = {w: t[w - 1] if w % 2 else None for w, t in net.filters.items()}

    def responses(self, x: np.ndarray) -> np.ndarray:
        """Output responses (n, languages) of windows."""
        two = x[:, :-1].astype(np.uint16) << 8 | x[:, 1:]
        pooled = []
        for w, tables in self.pairs.items():
            places = x.shape[1] - w + 1
            found = None
            for j, table in tables:
                part = table.take(two[:, j : j + places].ravel(), axis=0)
                found = part if found is None else np.add(found, part, out=found)
            if self.last[w] is not None:
                found += self.last[w].take(x[:, w - 1 : w - 1 + places].ravel(), axis=0)
            pooled.append(found.reshape(len(x), places, -1).max(axis=1))
        return np.maximum(np.concatenate(pooled, axis=1), 0) @ self.net.dense + self.net.bias

    def scores(self, data: np.ndarray, offsets: np.ndarray, step: int = 64) -> np.ndarray:
        """Softmax (texts, languages) of the mean response over each text's windows."""
        size, n = WINDOW, len(offsets) - 1
        total, seen = np.zeros((n, len(self.net.languages))), np.zeros(n)
        # Some texts at a time, and a very long one in stretches of windows.
        for a, b in _stretches(offsets, size * 16 * step):
            part = np.concatenate([[a], offsets[(offsets > a) & (offsets < b)], [b]])
            x, text_of = windows(data[a:b], part - a)
            text = np.searchsorted(offsets, part[:-1], "right") - 1
            for at in range(0, len(x), step):
                np.add.at(total, text[text_of[at : at + step]], self.responses(x[at : at + step]))
            np.add.at(seen, text[text_of], 1)
        return softmax(total / np.maximum(seen, 1)[:, None])


def _stretches(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cut all texts into stretches of about ``most`` bytes; inside a text only at whole windows."""
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        k = int(np.searchsorted(offsets, at, "right")) - 1
        inside = int(offsets[k + 1]) - at
        if inside > most:
            stop = at + most
        else:
            stop = int(offsets[np.searchsorted(offsets, at + most, "right") - 1])
        yield at, stop
        at = stop


def training_rows(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """At most ``per_language`` different windows of each language, those with the smallest hashes.

    ``labelled`` has ``text`` and ``lang``; texts without letters are left out.
    A text offers ``PER_DOCUMENT`` windows at places that its hash names; copies
    offer the same ones, which count once.

    How many different texts a language has tells about where its smallest
    hashes end, so a few more windows than are taken leave the tasks.
    """
    known = labelled.where(F.col("lang").isNotNull() & has_letter(F.col("text")))
    texts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).collect()}
    cuts = [F.lit(x) for lang, n in texts.items() for x in (lang, min(2**64 - 1, 2**65 * per_language // (PER_DOCUMENT * max(1, n))) - 2**63)]
    cut = F.create_map(*cuts)[F.col("lang")] if cuts else F.lit(0)
    room = F.greatest(F.length("text") - WINDOW // 2, F.lit(1))
    offered = known.select("lang", "text", cut.alias("cut"), F.explode(F.sequence(F.lit(1), F.lit(PER_DOCUMENT))).alias("k"))
    chosen = offered.withColumn("h", F.xxhash64("k", "text")).where(F.col("h") <= F.col("cut"))
    part = F.substring("text", (F.lit(1) + F.pmod(F.xxhash64("text", "k"), room)).cast("int"), F.lit(WINDOW))
    parts = chosen.select("lang", "h", part.alias("part")).groupBy("lang", "h").agg(F.min("part").alias("part"))
    by = Window.partitionBy("lang").orderBy("h")
    return parts.withColumn("place", F.row_number().over(by)).where(F.col("place") <= per_language).select("lang", "part")


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Network:
    """Network for the languages in ``labelled`` (``text``, ``lang``); what is collected is bounded by ``per_language`` windows each."""
    rows = sorted((r["lang"], r["part"]) for r in training_rows(labelled, per_language).collect())
    languages = tuple(sorted({lang for lang, _ in rows}))
    cut = [part.encode()[:WINDOW] for _, part in rows]
    offsets = np.cumsum([0, *map(len, cut)])
    x, _ = windows(np.frombuffer(b"".join(cut), dtype=np.uint8), offsets)
    y = np.array([languages.index(lang) for lang, _ in rows], dtype=np.int64)
    return train(x, y, languages)


@lru_cache(maxsize=1)
def _reader(key: str, shared: Broadcast) -> Reader:
    return Reader(shared.value)


def predict(docs: DataFrame, net: Network, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of each row.

    ``und`` with score 0 where the text is null, empty or has no letter, and
    where the network knows no language.  Only ``id`` and ``text`` are read,
    so other columns may have any name.
    """
    body = docs.select(F.col(id).alias("doc_id"), F.when(has_letter(F.col(text)), F.col(text)).alias("text"))
    if not net.languages:
        return body.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared, key = docs.sparkSession.sparkContext.broadcast(net), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(key, shared)
        for batch in slices(batches, "text"):
            data, offsets = buffers(batch.column("text"))
            scores = reader.scores(data, offsets)
            best = scores.argmax(axis=1)
            known = np.diff(offsets) > 0
            names = [reader.net.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            top = np.where(known, scores[np.arange(len(best)), best], 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(top)], ["doc_id", "lang_pred", "score"])

    return body.mapInArrow(run, f"doc_id {dict(body.dtypes)['doc_id']}, lang_pred string, score double")


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
