"""Runs of bytes, and filters of fixed size over 64-bit hashes, for counts of words and phrases."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a filter: 8 MB, whatever it holds.
FILTER_BITS = 1 << 26


def run_bounds(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every maximal run of bytes ``inside``, and per row the index of its first run, one more for
    the end. Rows are cut apart."""
    opens = np.zeros(len(inside) + 1, bool)
    opens[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | opens[1:-1]
    starts = np.flatnonzero(starts)
    stops = opens
    stops[:-1] |= ~inside
    stops[-1] = True
    stops = np.flatnonzero(stops)
    ends = stops[np.searchsorted(stops, starts, "right")]
    return starts, ends, np.searchsorted(starts, offsets)


def _places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bit places of each hash."""
    hashes = hashes.view(np.uint64)
    with np.errstate(over="ignore"):
        other = hashes * np.uint64(0x9E3779B97F4A7C15)
    return hashes % np.uint64(FILTER_BITS), (other >> np.uint64(20)) % np.uint64(FILTER_BITS)


def contains(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter may hold; it says no only of those it does not hold."""
    out = np.ones(len(hashes), bool)
    for place in _places(hashes):
        out &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


def filter_of(df: DataFrame, hashes: Callable[[pd.DataFrame], np.ndarray]) -> np.ndarray:
    """A filter of FILTER_BITS bits that holds ``hashes`` of all rows: each task fills one of its own, they are joined word by
    word, and the words, 8 MB at most, come to the driver."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = np.zeros(FILTER_BITS // 64, np.uint64)
        for frame in frames:
            for place in _places(hashes(frame)):
                np.bitwise_or.at(own, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
        at = np.flatnonzero(own)
        for part in np.array_split(at, len(at) // 50_000 + 1):
            yield pd.DataFrame({"at": part.astype(np.int64), "bits": own[part].view(np.int64)})

    joined = df.mapInPandas(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
    words = np.zeros(FILTER_BITS // 64, np.int64)
    words[joined["at"].to_numpy()] = joined["bits"].to_numpy()
    return words.view(np.uint8)
