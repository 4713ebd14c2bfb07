"""Periodic runs of words by recursive frequency splitting.

A run with period q repeats its first q words at least once more, so each of its words occurs at least
twice within it. A word that occurs once in a segment is therefore in no run of it and splits it; the
counts within the parts are lower, so the parts are split again until every word left occurs twice
in its part or the part is too short. All segments of a batch of texts are split together, with one count over
(segment, word) per level. Few words survive. The surviving segments are scanned by lag: a run of
period q spans a multiple of q, so only every q-th word is compared with the word q further on, and matches are
extended to both sides.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import without

MIN_LENGTH = 12
#: Bytes of text whose words are split together.
BATCH_BYTES = 4 << 20

_DDL = "struct<runs: array<struct<start: long, length: long, period: long>>, collapsed: string>"
_RUN = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])


def surviving_segments(
    words: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_length: int = MIN_LENGTH
) -> list[tuple[int, int]]:
    """The parts ``[start, end)`` of the given segments in which every word occurs at least twice."""
    survivors, kinds = [], int(words.max(initial=0)) + 1
    while True:
        long = ends - starts >= min_length
        starts, ends = starts[long], ends[long]
        if not len(starts):
            return survivors
        lengths = ends - starts
        segment = np.repeat(np.arange(len(starts)), lengths)
        places = np.arange(len(segment)) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
        _, kind, counts = np.unique(
            segment * kinds + words[places], return_inverse=True, return_counts=True
        )
        rare = counts[kind] < 2
        splits = np.bincount(segment[rare], minlength=len(starts)) > 0
        survivors += zip(starts[~splits].tolist(), ends[~splits].tolist(), strict=True)
        kept = splits[segment] & ~rare
        places, segment = places[kept], segment[kept]
        new = np.ones(len(places), dtype=bool)
        new[1:] = (np.diff(places) > 1) | (np.diff(segment) > 0)
        last = np.roll(new, -1)
        if len(last):
            last[-1] = True
        starts, ends = places[new], places[last] + 1


def _supported(words: np.ndarray, at: np.ndarray, lag: np.ndarray | int, reach: int) -> np.ndarray:
    """Whether the ``reach`` places before or after each match also match at the lag."""
    n = len(words)
    right, left = at + lag + reach < n, at >= reach
    for step in range(1, reach + 1):
        a = np.minimum(at + step, n - 1)
        right &= words[a] == words[np.minimum(a + lag, n - 1)]
        b = np.maximum(at - step, 0)
        left &= words[b] == words[b + lag]
    return right | left


def _anchors(words: np.ndarray, min_length: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(lag, places)`` in increasing lag: multiples of the lag where the word repeats at the lag.

    A run has at least max(min_length, 2 lag) - lag matches in a row, one of them at a multiple of the
    lag, with half of the others on one of its sides.
    """
    n = len(words)
    root = isqrt(n)

    def reach(lag: int) -> int:
        return min((max(min_length, 2 * lag) - lag) // 2, 4)

    for lag in range(1, min(root, n // 2) + 1):
        at = np.flatnonzero(words[: n - lag : lag] == words[lag::lag]) * lag
        if len(at):
            at = at[_supported(words, at, lag, reach(lag))]
        if len(at):
            yield lag, at
    low = root + 1
    while low <= n // 2:  # large lags have few multiples: all lags of an octave at a time
        high = min(2 * low, n // 2 + 1)
        lags, places = [], []
        for k in range((n - 1) // low):
            top = min(high, (n - 1) // (k + 1) + 1)
            here = words[k * low : k * (top - 1) + 1 : k] if k else words[0]
            there = words[(k + 1) * low : (k + 1) * (top - 1) + 1 : k + 1]
            lag = np.flatnonzero(here == there) + low
            lags.append(lag)
            places.append(k * lag)
        lag, at = np.concatenate(lags), np.concatenate(places)
        good = _supported(words, at, lag, reach(low))
        lag, at = lag[good], at[good]
        order = np.lexsort((at, lag))
        lag, at = lag[order], at[order]
        cuts = np.flatnonzero(np.diff(lag)) + 1
        if len(lag):
            for lags_, at_ in zip(np.split(lag, cuts), np.split(at, cuts), strict=True):
                yield int(lags_[0]), at_
        low = high


def _matches(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading values are equal, compared in growing pieces."""
    done, step, n = 0, 16, min(len(a), len(b))
    while done < n:
        differ = a[done : min(done + step, n)] != b[done : min(done + step, n)]
        if differ.any():
            return done + int(differ.argmax())
        done += len(differ)
        step *= 2
    return n


def runs_of(words: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of at least ``min_length`` words and two periods.

    A stretch that repeats at a multiple of its smallest period is one run: the places within a run
    found at a smaller lag are left out at the multiples of that lag.
    """
    found, known = [], defaultdict(list)
    for lag, places in _anchors(words, min_length):
        for start, end in known.pop(lag, ()):
            places = places[(places < start) | (places + lag >= end)]
        end = 0
        for at in places.tolist():
            if at + lag < end:
                continue
            end = at + lag + _matches(words[at:], words[at + lag :])
            start = at - _matches(words[:at][::-1], words[lag : at + lag][::-1])
            if end - start >= max(min_length, 2 * lag):
                found.append((start, end - start, lag))
                for multiple in range(2 * lag, (end - start) // 2 + 1, lag):
                    known[multiple].append((start, end))
    return sorted(found, key=lambda run: (run[0], run[2]))


def scan(texts: pa.Array, min_length: int = MIN_LENGTH) -> pa.Array:
    """Runs and collapsed text of each text, words as runs without white space."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, ends = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)  # blanks at the ends leave empty words
    flat = flat.filter(pa.array(real))
    ends = np.concatenate([[0], np.cumsum(real)])[ends].astype(np.int64)
    words = flat.dictionary_encode().indices.to_numpy().astype(np.int64)

    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    kept = np.ones(len(words), dtype=bool)
    for start, end in sorted(surviving_segments(words, ends[:-1], ends[1:], min_length)):
        doc = int(np.searchsorted(ends, start, side="right")) - 1
        for at, length, period in runs_of(words[start:end], min_length):
            runs[doc].append((start + at - int(ends[doc]), length, period))
            kept[start + at + period : start + at + length] = False
    places = np.concatenate([[0], np.cumsum(kept)])[ends]
    collapsed = pc.binary_join(
        pa.ListArray.from_arrays(pa.array(places, pa.int32()), flat.filter(pa.array(kept))), " "
    )
    rows = [[dict(zip(_RUN.names, r, strict=True)) for r in some] for some in runs]
    return pa.StructArray.from_arrays(
        [pa.array(rows, pa.list_(_RUN)), collapsed], names=["runs", "collapsed"]
    )


def periodic_runs(text: Column, min_length: int = MIN_LENGTH) -> Column:
    """A struct of ``runs`` and ``collapsed`` for each text."""

    def convert(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            parts, start, size = [], 0, 0
            lengths = pc.fill_null(pc.binary_length(array), 0).to_pylist()
            for i, n in enumerate(lengths):
                if i > start and size + n > BATCH_BYTES:
                    parts.append(scan(array[start:i], min_length))
                    start, size = i, 0
                size += n
            parts.append(scan(array[start:], min_length))
            yield pa.concat_arrays(parts)

    convert.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(convert, _DDL)(text)


def find_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with ``runs`` (start, length and period in words, by start, then period) and ``collapsed``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch with smallest period q of at least
    ``min_length`` and 2 q words that no neighbouring word extends. ``collapsed`` holds the words
    that no run has after its first q words, joined by one blank.

    One row per input row, repeated rows and NULL keys included. A NULL, empty or blank text has no runs and
    an empty ``collapsed``. Texts of any length are scanned whole. Columns of these names in ``docs`` are
    replaced, others kept. An empty table gives an empty result.
    """
    rest = without(docs, ["runs", "collapsed"])
    names = [F.col(f"r.`{c.replace('`', '``')}`") for c in rest.columns]
    # The row travels as one value beside the result, so no column can clash.
    both = docs.select(
        F.struct(*[rest[f"`{c.replace('`', '``')}`"] for c in rest.columns]).alias("r"),
        periodic_runs(F.col(text), min_length).alias("found"),
    )
    return both.select(*names, "found.runs", "found.collapsed")
