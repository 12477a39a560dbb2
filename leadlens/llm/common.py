"""What several operators share: checkpoints, Arrow batch sizes, byte views of text columns, words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words: space, tab, line feed, vertical tab, form feed, return.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
BATCH_BYTES = 4 << 20


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Keeps an Arrow batch near 4 MB of rows, so that a worker's memory does not follow the
    length of the texts. A setting of the session's own is left alone."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder beside the warehouse's tables."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared").rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores put before it until no column has it."""
    while name.lower() in {x.lower() for x in taken}:
        name = "_" + name
    return name


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def remainder(doc_id: Column | str, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``; NULL for a NULL id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % mod


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each row's begin, one more for the end. NULL is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if not len(column) or data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def in_parts(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The batches cut into parts of about ``most`` bytes of ``column``; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word, and per row the index of its first word, one more for the end.
    Rows are cut apart even without white space between them."""
    inside = ~_IS_SPACE[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    starts_row = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[starts_row] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[starts_row[starts_row > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers, in place."""
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x2545F4914F6CDD1D
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    if not _POWERS or len(_POWERS["up"]) < n:
        n = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words: differences of one running polynomial sum over all bytes."""
    up, down = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * up[: len(data)], out=total[1:])
        hashes = (total[ends] - total[starts]) * down[starts]
        hashes += (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(hashes)


def windows(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width``-word windows of each row and each row's first window, one more for the end.
    A row of fewer words has one window of them all; a row without words has none."""
    counts = np.diff(first)
    sizes = np.where(counts == 0, 0, np.maximum(counts - width + 1, 1))
    begins = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(begins[-1]) - np.repeat(begins[:-1] - first[:-1], sizes)
    ends = np.repeat(first[1:], sizes)
    hashes = np.zeros(len(at), np.uint64)
    padded = np.concatenate((words, np.zeros(width, np.uint64)))
    with np.errstate(over="ignore"):
        for k in range(width):
            factor = np.uint64(pow(_BASE, 2 * k + 1, 1 << 64))
            hashes += np.where(at + k < ends, padded[at + k] + np.uint64(k + 1), np.uint64(0)) * factor
    return mix(hashes), begins
