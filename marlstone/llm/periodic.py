"""Runs of repeated word sequences, by recompression.

The words of many texts are one sequence of symbols (a word of another text is
another symbol).  Block compression replaces every stretch of one symbol by a
symbol for it and its length, pair compression every pair whose halves a hash
puts on different sides; in turns they make a run-length grammar.  Both decide
by neighbours only, so equal stretches are compressed alike, and how far two
places go on alike is read off the grammar in a few steps per level, without a
suffix array.

A run of period q and length max(``least``, 2 q) or more has a place i, a
multiple of max(q, ``least`` - q), where the words i and i + q are inside it and
equal: n / q places for each q, n log n in all.  The grammar tells how far each
extends both ways.  All steps are numpy over whole batches of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb

#: Words that a run must have, twice its period if that is more.
LEAST = 12
#: Places tried at a time.
_PLACES = 1 << 20

RUN = "struct<start:bigint,length:bigint,period:bigint>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Grammar:
    """Levels of a sequence of symbols, one behind the other in flat arrays.

    ``symbol``: equal within a level if and only if the stretches are equal;
    ``up``: the symbol above, -1 on the last level; ``down``: the first symbol
    below, -1 on level 0, the next symbol's gives the end; ``after`` and
    ``before``: equal symbols from here to the end (beginning) of its block.
    """

    def __init__(self, symbols: np.ndarray):
        # A symbol of its own at both ends stops every comparison.
        first = np.concatenate([[0], symbols.astype(np.int64) + 1, [int(symbols.max(initial=-1)) + 2]])
        level, distinct = first, len(np.unique(first))
        found, ups, downs, afters, befores = [level], [], [np.full(len(level) + 1, -1)], [], []
        base, seed = 0, 0
        blocks = True
        while distinct < len(level):
            begins = _blocks(level) if blocks else _pairs(level, seed)
            seed += 1
            if len(begins) < len(level):
                ends = np.append(begins[1:], len(level))
                second = ends - begins if blocks else np.where(ends - begins == 2, level[ends - 1] + 1, 0)
                codes, names = pd.factorize(level[begins] * (int(second.max()) + 1) + second)
                above, here = base + len(level) + 1, np.arange(len(level))
                parent = np.repeat(np.arange(len(begins)), ends - begins)
                ups.append(np.append(above + parent, -1))
                afters.append(np.append(ends[parent] - here if blocks else np.ones(len(level), np.int64), 1))
                befores.append(np.append(here - begins[parent] + 1 if blocks else np.ones(len(level), np.int64), 1))
                downs.append(np.append(base + begins, base + len(level)))
                base, level, distinct = above, codes.astype(np.int64), len(names)
                found.append(level)
            blocks = not blocks
        last = len(level) + 1
        self.symbol = np.concatenate([np.append(x, -1) for x in found])
        self.up = np.concatenate([*ups, np.full(last, -1)])
        self.down = np.concatenate(downs)
        self.after = np.concatenate([*afters, np.ones(last, np.int64)])
        self.before = np.concatenate([*befores, np.ones(last, np.int64)])

    def ahead(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many symbols are equal from ``x`` and ``y`` on (different places)."""
        return self._compare(x + 1, y + 1, forward=True)

    def behind(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many symbols are equal before ``x`` and ``y``, going backwards."""
        return self._compare(x, y, forward=False)

    def _compare(self, x: np.ndarray, y: np.ndarray, forward: bool) -> np.ndarray:
        symbol, up, down = self.symbol, self.up, self.down
        edge = (lambda p: down[p]) if forward else (lambda p: down[p + 1] - 1)
        out, open_, start = np.zeros(len(x), np.int64), np.arange(len(x)), x
        while len(open_):
            equal = symbol[x] == symbol[y]
            above_x, above_y = up[x], up[y]
            # Both begin a symbol of the next level, and it is the same: nothing in it needs a look.
            rise = equal & (above_x >= 0) & (edge(above_x) == x) & (edge(above_y) == y) & (symbol[above_x] == symbol[above_y])
            if forward:
                step = np.minimum(self.after[x], self.after[y])
            else:
                step = -np.minimum(self.before[x], self.before[y])
            ended = ~equal & (down[x] < 0)
            out[open_[ended]] = np.abs(x[ended] - start[ended])
            next_x = np.where(rise, above_x, np.where(equal, x + step, edge(x)))
            next_y = np.where(rise, above_y, np.where(equal, y + step, edge(y)))
            on = ~ended
            x, y, open_, start = next_x[on], next_y[on], open_[on], start[on]
        return out


def _blocks(level: np.ndarray) -> np.ndarray:
    """Where the stretches of one symbol begin."""
    return np.flatnonzero(np.concatenate([[True], level[1:] != level[:-1]]))


def _pairs(level: np.ndarray, seed: int) -> np.ndarray:
    """Where pairs and single symbols begin: a pair is a symbol of one side before one of the other."""
    side = (tb.mix(level.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))) & np.uint64(1)).astype(bool)
    one, other = side[:-1] & ~side[1:], ~side[:-1] & side[1:]
    paired = one if one.sum() >= other.sum() else other
    return np.flatnonzero(~np.concatenate([[False], paired]))


def _places(bounds: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, place in the whole sequence and period of all candidates, some at a time."""
    sizes = np.diff(bounds)
    periods = np.where(sizes >= least, sizes // 2, 0)
    ends = np.cumsum(periods)
    at, total = 0, int(ends[-1]) if len(ends) else 0
    while at < total:
        # The pairs of a text and a period from number ``at`` on, as many as have few enough places.
        some = np.arange(at, min(total, at + _PLACES // 4))
        text = np.searchsorted(ends, some, "right")
        period = some - (ends[text] - periods[text]) + 1
        apart = np.maximum(period, least - period)
        count = (sizes[text] - 1 - period) // apart + 1
        upto = max(1, int(np.searchsorted(np.cumsum(count), _PLACES, "right")))
        text, period, apart, count = text[:upto], period[:upto], apart[:upto], count[:upto]
        number = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        yield np.repeat(text, count), np.repeat(bounds[:-1][text], count) + number * np.repeat(apart, count), np.repeat(period, count)
        at += upto


def runs_of(symbols: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and end (places in the whole sequence) and period of every run, by start, then period.

    ``symbols`` of different texts must differ; text k has those from
    ``bounds[k]`` to ``bounds[k + 1]``.
    """
    grammar = None
    parts = []
    for text, place, period in _places(bounds, least):
        # Half of ``least`` words in a row agree with those a period on, so the next or the last do.
        near = np.flatnonzero(symbols[place] == symbols[place + period])
        place, period, text = place[near], period[near], text[near]
        far = np.minimum(place + period + 1, len(symbols) - 1)
        beside = (symbols[place + 1] == symbols[far]) | (place > 0) & (symbols[place - 1] == symbols[place + period - 1])
        place, period, text = place[beside], period[beside], text[beside]
        if not len(place):
            continue
        grammar = grammar or Grammar(symbols)
        start = place - grammar.behind(place, place + period)
        end = place + period + grammar.ahead(place, place + period)
        long = end - start >= np.maximum(least, 2 * period)
        parts.append(np.unique(np.stack([start, end, period, text], axis=1)[long], axis=0))
    if not parts:
        return (np.zeros(0, np.int64),) * 4
    # A stretch is found with its smallest period and with multiples of it: the smallest stays.
    found = np.unique(np.concatenate(parts), axis=0)
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[new]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return found[:, 3], found[:, 0], found[:, 1], found[:, 2]


_IS_WORD = tb.table(tb.BLANKS)


def _words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts, and their offsets by text."""
    data, offsets = tb.buffers(column)
    starts, ends = tb.word_places(data, offsets, _IS_WORD)
    letters = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(letters), pa.py_buffer(data[_IS_WORD[data]].tobytes())])
    return words, tb.per_text(starts, offsets)


def _found(column: pa.Array, least: int):
    """Of a column of texts: offsets of their words, offsets of their runs, the runs, and the texts less what repeats."""
    words, bounds = _words(column)
    sizes = np.diff(bounds)
    names = words.dictionary_encode()
    own = np.repeat(np.arange(len(sizes)), sizes) * max(1, len(names.dictionary)) + names.indices.to_numpy()
    symbols = pd.factorize(own)[0].astype(np.int64)
    text, start, end, period = runs_of(symbols, bounds, least)
    marks = np.zeros(len(symbols) + 1, dtype=np.int64)
    np.add.at(marks, start + period, 1)
    np.add.at(marks, end, -1)
    kept = np.cumsum(marks)[:-1] == 0
    of_text = np.concatenate([[0], np.cumsum(tb.summed(kept.astype(np.int64), bounds))])
    lists = pa.ListArray.from_arrays(pa.array(of_text.astype(np.int32)), words.filter(pa.array(kept)))
    collapsed = pc.binary_join(lists, " ")
    by_text = np.searchsorted(text, np.arange(len(sizes) + 1), "left")
    spans = pa.StructArray.from_arrays([pa.array(start - bounds[text]), pa.array(end - start), pa.array(period)], fields=list(_RUN))
    return sizes, pa.ListArray.from_arrays(pa.array(by_text.astype(np.int32)), spans), collapsed


def _finder(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.slices(batches, "text"):
            sizes, runs, collapsed = _found(batch.column("text"), least)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes), runs, collapsed], ["doc_id", "n_words", "runs", "collapsed"])

    return run


def find(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` and ``collapsed`` of each row.

    A run is a stretch of words with smallest period q, of max(``least``, 2 q)
    words or more, that no neighbouring word goes on; ``runs`` has start (word
    number from 0), length and period, by start, then period.  ``collapsed``
    are the words, one blank between them, without those that a run contains
    after its first q.

    Rows stand for themselves: nulls and repeats among ids do no harm.  Null,
    empty and blank texts have no words, no runs and an empty ``collapsed``.
    Only ``id`` and ``text`` are read, so other columns may have any name.  Of
    texts about a megabyte is worked on at a time, one text at least: memory
    follows the longest text.
    """
    if least < 3:
        raise ValueError("a run has three words at least")
    body = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    kind = body.schema["doc_id"].dataType.simpleString()
    return body.mapInArrow(_finder(least), f"doc_id {kind}, n_words bigint, runs array<{RUN}>, collapsed string")


def collapse(docs: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """The rows with what repeats taken out of ``text``; null stays null, other columns are passed on.

    Texts without a run are passed on as they are, blanks and all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.slices(batches, text):
            at = batch.schema.get_field_index(text)
            _, runs, collapsed = _found(batch.column(at), least)
            changed = pc.greater(runs.value_lengths(), 0)
            yield batch.set_column(at, text, pc.if_else(changed, collapsed, batch.column(at).cast(pa.string())))

    return docs.mapInArrow(run, docs.schema)
