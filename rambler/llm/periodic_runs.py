"""Periodic runs in texts: a dictionary of basic factors, over many texts at once in numpy.

A run is a stretch of consecutive words with smallest period p, at least ``least`` words and ``times``
periods long, that no neighbouring word extends.  Words become numbers; the factor of 2 ** k words that
begins at a word is named by the pair of its halves' names, and equal names mean equal factors.

Let 2 ** k lie in [p, 2 p).  Inside a run of period p the next occurrence of a factor of this length is
exactly p words on (a nearer one would give the run a smaller period), and both lie within 2 * 2 ** k
words.  So at every length, successors no farther than the length form arithmetic progressions; where
consecutive factors have successors at the same distance, that distance is a period of the stretch from
the first factor to the last successor's end.  The stretch is extended word by word while the period
holds, and stretches that come from several lengths are told apart by (start, end): the smallest period
stays.

A factor that occurs once in its text is dropped, and with it all longer ones that begin there, so prose
leaves the dictionary after two or three lengths.  A text's runs span it, so a text is one task's work;
texts are joined to batches of ``BATCH_BYTES``, and a longer one is a batch of its own.  Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rambler.llm.common import texts

BATCH_BYTES = 1 << 21
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
# Space and U+0009 to U+000D separate words.
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte begins and ends of all words of the texts ``data[offsets[i] : offsets[i + 1]]``, and each text's number of words."""
    inside = np.concatenate([[False], _IS_WORD[data], [False]])     # inside[1 + i] tells of byte i
    cut = np.zeros(len(data) + 1, bool)     # where a text begins, or the last one ends
    cut[offsets] = True
    begins = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    return begins, ends, np.diff(np.searchsorted(begins, offsets))


def number_words(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words, and for no others."""
    offsets = np.concatenate([[0], np.cumsum(ends - begins)])
    packed = data[_spread(begins, ends - begins)]
    words = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(packed)])
    return np.asarray(words.dictionary_encode().indices, dtype=np.int64)


def _spread(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places begins[i], begins[i] + 1, ... of all ranges, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - lengths), lengths)


def _rename(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each key: a name (a small number), the place of its next occurrence (-1: none), and whether it is repeated."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    names = np.empty(len(keys), np.int64)
    names[order] = np.concatenate([[0], np.cumsum(~same)])
    following = np.full(len(keys), -1, np.int64)
    following[order[:-1][same]] = order[1:][same]
    repeated = following >= 0
    repeated[order[1:][same]] = True
    return names, following, repeated


def find_runs(words: np.ndarray, counts: np.ndarray, least: int = 24, times: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and periods of all runs of texts whose numbered words stand one after another; starts ascend."""
    first = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)
    none = np.zeros(0, np.int64)
    at = _spread(first[counts >= least], counts[counts >= least])      # places of the factors still in the dictionary
    if not len(at):
        return none, none, none
    names = text[at] * (words.max() + 1) + words[at]
    limit = (first + counts)[text]      # where a place's text ends
    longest = counts.max() // times     # period
    found, length = [], 1
    while len(at):
        names, following, repeated = _rename(names)
        gaps = np.where(following >= 0, at[following] - at, 0)
        near = np.flatnonzero((gaps > 0) & (gaps <= length))
        if len(near):
            begin, gap = at[near], gaps[near]
            new = np.concatenate([[True], (np.diff(begin) != 1) | (np.diff(gap) != 0)])
            last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(near) - 1]])
            found.append((begin[new], begin[last] + gap[new] + length, gap[new]))
        if length >= 2 * longest:
            break
        # a longer factor is a pair of neighbours that are both repeated
        at, names = at[repeated], names[repeated]
        right = np.searchsorted(at, at + length)
        right[right == len(at)] = 0
        whole = (at[right] == at + length) & (at + 2 * length <= limit[at])
        names = names[whole] * (names.max() + 1 if len(names) else 1) + names[right[whole]]
        at = at[whole]
        length *= 2
    if not found:
        return none, none, none
    start, end, period = (np.concatenate(x) for x in zip(*found))
    start, end = _extend(words, first[text[start]], limit[start], start, end, period)
    long = end - start >= np.maximum(least, times * period)
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    fresh = np.concatenate([[True], (np.diff(start) != 0) | (np.diff(end) != 0)]) if len(start) else np.zeros(0, bool)
    return start[fresh], end[fresh], period[fresh]


def _extend(words, low, high, start, end, period) -> tuple[np.ndarray, np.ndarray]:
    """Move starts and ends outward, within [low, high), as long as the period holds."""
    start, end = start.copy(), end.copy()
    left = right = np.arange(len(start))
    while len(left):
        left = left[start[left] > low[left]]
        left = left[words[start[left] - 1] == words[start[left] - 1 + period[left]]]
        start[left] -= 1
    while len(right):
        right = right[end[right] < high[right]]
        right = right[words[end[right]] == words[end[right] - period[right]]]
        end[right] += 1
    return start, end


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The (start, length, period) of greatest exact length / period; ties: smallest start, then period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def _batch_results(data: np.ndarray, offsets: np.ndarray, least: int, times: int):
    """Per text: number of words, runs, best run; and the collapsed texts as offsets and bytes."""
    begins, ends, counts = split_words(data, offsets)
    numbers = number_words(data, begins, ends)
    start, end, period = find_runs(numbers, counts, least, times)
    last = np.cumsum(counts)
    kept = np.ones(len(begins), bool)
    if len(start):      # what follows a run's first period goes
        change = np.zeros(len(begins) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, end, -1)
        kept = np.cumsum(change[:-1]) == 0
    lengths = (ends - begins)[kept]
    out = np.full(int((lengths + 1).sum()), 0x20, np.uint8)     # every word, and a space after it
    to = np.cumsum(lengths + 1) - (lengths + 1)
    out[_spread(to, lengths)] = data[_spread(begins[kept], lengths)]
    sizes = np.concatenate([[0], np.cumsum(lengths + 1)])
    word_ends = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], last])]
    runs = [[] for _ in counts]
    for i, s, e, p in zip(np.searchsorted(last, start, side="right").tolist(), start.tolist(), end.tolist(), period.tolist()):
        runs[i].append((s - int(last[i] - counts[i]), e - s, p))
    runs = [sorted(r, key=lambda x: (x[0], x[2])) for r in runs]
    return counts, runs, sizes[word_ends], out


def periodic_runs(docs: DataFrame, least: int = 24, times: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, runs, best, collapsed)``, one row for each row of ``docs``.

    ``runs`` are (start, length, period) in words, by start, then period; ``best`` is the one of greatest
    length / period (null without a run).  ``collapsed`` has the words joined by one space, without those
    that lie in a run after its first period.  A null, empty or blank text has no words and no runs.  Null
    and repeated ids are rows like others; other columns aren't read; an empty table gives no rows.
    ``times`` is 3 at least: a shorter run may not hold two occurrences of a factor of its period's length.
    """
    if times < 3:
        raise ValueError("times must be 3 or more")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            text = whole.column("text").cast(pa.large_string())
            _, offsets, data = text.buffers()
            offsets = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
            data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
            a = 0
            while a < len(text):
                b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + BATCH_BYTES, side="right")) - 1)
                counts, runs, cuts, out = _batch_results(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], least, times)
                bodies = [out[x : max(x, y - 1)].tobytes().decode() for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                as_rows = [[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs]
                best = [best_run(found) for found in runs]
                yield pa.record_batch([whole.column("doc").slice(a, b - a), pa.array(counts.astype(np.int64)), pa.array(as_rows, pa.list_(_RUN)),
                                       pa.array([r and dict(zip(("start", "length", "period"), r)) for r in best], _RUN), pa.array(bodies, pa.string())],
                                      names=["doc", "n_words", "runs", "best", "collapsed"])
                a = b

    kind = docs.schema[id_col].dataType.simpleString()
    run = "struct<start: long, length: long, period: long>"
    return (texts(docs, id_col, text_col).mapInArrow(work, f"doc {kind}, n_words long, runs array<{run}>, best {run}, collapsed string")
            .withColumnRenamed("doc", id_col))
