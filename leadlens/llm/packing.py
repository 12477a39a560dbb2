"""Packing token sequences with bounded-space online packing.

Each partition keeps a fixed number of open windows. A document's whole windows of ``length`` ids are cut off at
once; the rest goes where it leaves the least room. When it fits nowhere, the fullest window is emitted: if its room
is at least ``least_cut`` ids, it is first filled with the head of the document. At the end the partitions' open
windows, some per partition, are merged by the same rule, in rounds that take many partitions' windows to a task
until one round makes no fewer tasks.

Rows: a NULL text is empty and yields one piece, the end id. Repeated rows are packed each for itself. Other
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.llm.common import bound_batches, checkpointed, in_parts, utf8, word_hashes

LENGTH = 2048
OPEN_WINDOWS = 16
LEAST_CUT = 32
END_ID = 1
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, open boolean"
#: Places for cached runs, of 14 bytes each, and ids held for them; a full cache is emptied.
SLOTS, HELD = 1 << 20, 1 << 22
_tokenizers: dict[str, RunCache] = {}

# Kinds of bytes: white space, letters (ASCII, and Latin-1 as two bytes), digits, marks, and what else there is. An
# apostrophe or the beginning of a special token is left to the tokenizer.
_SPACE, _LETTER, _DIGIT, _MARK, _ELSE = range(5)
_KIND = np.full(256, _ELSE, np.uint8)
_KIND[list(b" \t\n\r")] = _SPACE
_KIND[[*range(65, 91), *range(97, 123), 0xC3]] = _LETTER
_KIND[range(48, 58)] = _DIGIT
_KIND[list(b"!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~")] = _MARK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# How a vocabulary must normalise and split texts so that runs can be encoded one by one.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def by_runs(path: str) -> bool:
    """Whether the tokenizer in the file drops white space and case, cuts texts into runs of letters or marks and single
    digits, and encodes each run for itself, its last token ending in ``</w>``."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    normalizer, splitter, model = made.get("normalizer") or {}, made.get("pre_tokenizer") or {}, made["model"]
    split, *more = splitter.get("pretokenizers") or [{}]
    return (
        normalizer.get("normalizers") == NORMALIZERS
        and (split.get("type"), split.get("pattern"), split.get("behavior"), split.get("invert")) == ("Split", {"Regex": SPLIT}, "Removed", True)
        and [(x["type"], x.get("add_prefix_space"), x.get("use_regex")) for x in more] == [("ByteLevel", False, False)]
        and (model.get("type"), model.get("end_of_word_suffix"), model.get("dropout")) == ("BPE", "</w>", None)
    )


class RunCache:
    """The ids of runs of letters, of marks, and of single digits, by 64-bit hash. For a tokenizer that encodes such runs
    one by one: a text's ids are its runs' ids in a row. Texts with other bytes go to the tokenizer as they are, and so
    do all texts if it splits them otherwise."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.by_runs = Tokenizer.from_file(path), by_runs(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 2, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.empty()

    def empty(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.starts, self.sizes = np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int16)
        self.held, self.n_held = np.zeros(HELD, np.uint32), 0

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text; NULL is empty."""
        if not self.by_runs:
            return self.encoded(column)
        data, offsets = utf8(column)
        kinds = _KIND[data]
        follows = np.zeros(len(data), bool)  # the second byte of a Latin-1 letter
        follows[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        kinds[follows] = _LETTER
        alone = (data == 0xC3) & ~np.append(follows[1:], False)
        kinds[alone] = _ELSE
        full = np.flatnonzero(np.diff(offsets))
        other = np.zeros(len(column), bool)
        if len(full):
            other[full] = np.maximum.reduceat(kinds, offsets[full]) == _ELSE
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(column)
        rest = np.flatnonzero(other)
        if len(rest):
            for i, found in zip(rest, self.encoded(column.take(pa.array(rest))), strict=True):
                out[i] = found
            kinds[np.repeat(other, np.diff(offsets))] = _SPACE
        lower = _LOWER[data]
        lower[follows & (data <= 0x9E)] += 32
        begins = np.ones(len(data), bool)
        begins[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)
        begins[offsets[full]] = True
        edges = np.append(np.flatnonzero(begins), len(data))
        real = kinds[edges[:-1]] != _SPACE
        starts, ends = edges[:-1][real], edges[1:][real]
        ids, at = self.runs(lower, starts, ends)
        bounds = at[np.searchsorted(starts, offsets)]
        for i in np.flatnonzero(~other):
            out[i] = ids[bounds[i] : bounds[i + 1]]
        return out

    def encoded(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text, by the tokenizer."""
        texts = [text or "" for text in column.to_pylist()]
        return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def runs(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the runs in a row, and where each run's begin, one more for the end."""
        hashes = word_hashes(data, starts, ends) | np.uint64(1)
        unique, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        slots = (unique >> np.uint64(44)).astype(np.int64)
        if self.n_held + len(data) > HELD:
            self.empty()
        known = self.keys[slots] == unique
        begin, size = self.starts[slots].astype(np.int64), self.sizes[slots].astype(np.int64)
        held = self.held
        if new := np.flatnonzero(~known).tolist():
            raw = data.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]
            some = [self.learn(texts[k : k + 1000]) for k in range(0, len(texts), 1000)]
            fresh = np.concatenate([ids for ids, _ in some])
            sizes = np.concatenate([n for _, n in some])
            if self.n_held + len(fresh) > HELD:  # one text alone may be longer than the cache
                held = np.concatenate((self.held[: self.n_held], fresh))
            else:
                held[self.n_held : self.n_held + len(fresh)] = fresh
            size[new], begin[new] = sizes, self.n_held + np.cumsum(sizes) - sizes
            if held is self.held:
                short = np.array(new)[sizes < 1 << 15]
                self.keys[slots[short]], self.starts[slots[short]], self.sizes[slots[short]] = unique[short], begin[short], size[short]
                self.n_held += len(fresh)
        sizes = size[which]
        at = np.concatenate(([0], np.cumsum(sizes)))
        return held[np.arange(at[-1]) + np.repeat(begin[which] - at[:-1], sizes)], at

    def learn(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of new runs and how many each has: encoded as one text, cut at the tokens that end a run."""
        ids = np.array(self.tokenizer.encode(" ".join(runs), add_special_tokens=False).ids, np.uint32)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(runs):
            raise ValueError("the vocabulary does not end each run of letters or marks with </w>")
        return ids, np.diff(ends, prepend=0)


def tokens(path: str) -> RunCache:
    """The worker's tokenizer for ``path``, kept between tasks."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _tokenizers:
        _tokenizers[path] = RunCache(path)
    return _tokenizers[path]


class Windows:
    """Open windows by fill, at most ``most``; ``place`` says which window takes an item and what was emitted."""

    def __init__(self, length: int, most: int) -> None:
        self.length, self.most = length, most
        self.fills: list[tuple[int, int]] = []  # (fill, window), ascending
        self.next = 0

    def open(self, fill: int) -> int:
        window, self.next = self.next, self.next + 1
        if fill < self.length:
            insort(self.fills, (fill, window))
        return window

    def best(self, size: int) -> tuple[int, int] | None:
        """The fullest window with room for ``size``, taken out."""
        at = bisect_left(self.fills, (self.length - size + 1, -1)) - 1
        return self.fills.pop(at) if at >= 0 else None

    def put(self, fill: int, window: int) -> None:
        if fill < self.length:
            insort(self.fills, (fill, window))

    def fullest(self) -> tuple[int, int] | None:
        """The window to emit if as many are open as may be."""
        return self.fills.pop() if len(self.fills) >= self.most else None


def cut(windows: Windows, size: int, least_cut: int) -> Iterator[tuple[int, int, int, int]]:
    """Places a document of ``size`` ids: (start, length, window, offset) of its pieces."""
    start = 0
    while size - start >= windows.length:
        yield start, windows.length, windows.open(windows.length), 0
        start += windows.length
    while start < size:
        rest = size - start
        if found := windows.best(rest):
            fill, window = found
            windows.put(fill + rest, window)
            yield start, rest, window, fill
            return
        if (emitted := windows.fullest()) is None:
            yield start, rest, windows.open(rest), 0
            return
        fill, window = emitted
        if (room := windows.length - fill) >= least_cut:
            yield start, room, window, fill
            start += room


def pack_partitions(docs: DataFrame, path: str, length: int, most: int, least_cut: int) -> DataFrame:
    """Pieces of every document; ``open`` marks those in windows left open at their partition's end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, windows = tokens(path), Windows(length, most)
        base = TaskContext.get().partitionId() << 40
        waiting: dict[int, list[tuple]] = {}  # pieces of windows that are still open
        for batch in in_parts(batches, "text"):
            out = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), cache.encode(batch.column(1)), strict=True):
                size = len(ids) + 1
                packed = ids.astype("<u4").tobytes() + END_ID.to_bytes(4, "little")
                for start, n, window, offset in cut(windows, size, least_cut):
                    crc = zlib.crc32(packed[4 * start : 4 * (start + n)])
                    waiting.setdefault(window, []).append((doc_id, start, n, crc, size, base | window, offset))
            still = {w for _, w in windows.fills}
            for window in [w for w in waiting if w not in still]:
                out += waiting.pop(window)
            yield frame(out, False)
        yield frame([p for pieces in waiting.values() for p in pieces], True)

    def frame(pieces: list[tuple], still_open: bool) -> pa.RecordBatch:
        columns = list(zip(*pieces, strict=True)) if pieces else [[]] * 7
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns] + [pa.array([still_open] * len(pieces), pa.bool_())], PIECES.replace(" long", "").replace(" boolean", "").split(", "))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


MOVES = "window long, fill long, to long, shift long, open boolean"


def merge_round(windows: DataFrame, length: int, most: int, tasks: int, last: bool) -> DataFrame:
    """Packs windows (window, fill) into each other, in ``tasks`` tasks: which window each goes to and how far it is
    shifted there. ``open``: the target may still take more in another round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, target, waiting = Windows(length, most), {}, {}
        for batch in batches:
            out = []
            for window, fill in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = bins.best(fill)
                if found is None:
                    bins.fullest()
                    at, shift = bins.open(fill), 0
                    target[at] = window  # a window keeps the name of the first put into it
                else:
                    shift, at = found
                    bins.put(shift + fill, at)
                waiting.setdefault(at, []).append((window, fill, target[at], shift))
            still = {w for _, w in bins.fills}
            for at in [w for w in waiting if w not in still]:
                out += waiting.pop(at)
            yield frame(out, False)
        yield frame([x for moved in waiting.values() for x in moved], not last)

    def frame(moves: list[tuple], still_open: bool) -> pa.RecordBatch:
        columns = list(zip(*moves, strict=True)) if moves else [[]] * 4
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns] + [pa.array([still_open] * len(moves), pa.bool_())], MOVES.replace(" long", "").replace(" boolean", "").split(", "))

    dealt = windows.select("window", "fill").repartitionByRange(tasks, F.xxhash64("window"))
    return dealt.sortWithinPartitions(F.desc("fill"), "window").mapInArrow(run, MOVES)


def pack(docs: DataFrame, path: str, length: int = LENGTH, most: int = OPEN_WINDOWS, least_cut: int = LEAST_CUT, per_task: int = 8000) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) in sequences of at most ``length`` ids."""
    bound_batches(docs.sparkSession)
    pieces = checkpointed(pack_partitions(docs, path, length, most, least_cut))
    names = [f.split()[0] for f in PIECES.split(", ")][:-1]
    done = pieces.filter(~F.col("open")).select(*names)
    left = pieces.filter("open").select(*names)
    # Where each open window ends up: (window, to, shift). A round takes per_task windows to a task.
    windows = left.groupBy(F.col("sequence_id").alias("window")).agg(F.sum("length").alias("fill"))
    n = windows.count()
    moves, tasks = None, -(-n // per_task)
    while n:
        last = tasks <= 1
        moved = checkpointed(merge_round(windows, length, max(most, 256), max(1, tasks), last))
        if moves is None:
            moves = moved.select("window", "to", "shift")
        else:
            step = moved.select(F.col("window").alias("by"), F.col("to").alias("next"), F.col("shift").alias("more"))
            joined = moves.join(step, moves["to"] == step["by"], "left")
            moves = joined.select("window", F.coalesce("next", "to").alias("to"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"))
        windows = moved.filter("open").groupBy(F.col("to").alias("window")).agg(F.sum("fill").alias("fill"))
        rest = 0 if last else -(-windows.count() // per_task)
        if last or rest >= tasks:
            break
        tasks = rest
    if moves is None:
        return done
    moves = moves.withColumnRenamed("window", "sequence_id")
    merged = left.join(moves, "sequence_id").withColumn("sequence_id", F.col("to")).withColumn("offset", F.col("offset") + F.col("shift"))
    return done.unionByName(merged.select(*names))


def packing(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The query: pieces of all documents, tokenized with the vocabulary at ``path``."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return pack(docs, path)
