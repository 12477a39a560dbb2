"""Language identification by prediction by partial matching over bytes.

Per language a context tree holds how often each byte followed each context of 0 to 3 bytes. A byte's
code length under a language comes from the longest known context: with n followers seen, d of them
different, a byte seen c times costs log2((n + d) / c) bits; any other costs the escape, log2((n + d) / d),
and is coded in the next shorter context, at last as one of 256 equal bytes. The counts are frozen after
training, so a code length depends on at most four bytes: each run of four bytes is looked up once a task.

Rows: a text that is NULL or has no letter is ``und`` with score 0. Before a text's first byte stands a
mark of its own. Ties go to the language first in order. Without any training row every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.llm.common import bound_batches, free_name, in_parts, remainder, utf8

ORDER = 3
#: Code lengths of a block of positions, and those that a task holds, whatever the number of languages: 4 and 32 MB.
BLOCK, HELD = 1 << 20, 1 << 23


@dataclass
class Sparse:
    """Values by (key, language), only those there are: sorted keys, and for key i the entries from ``at[i]`` to ``at[i + 1]``."""

    keys: np.ndarray
    at: np.ndarray
    language: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, language: np.ndarray, value: np.ndarray) -> Sparse:
        """From entries in order of their keys."""
        unique, first = np.unique(keys, return_index=True)
        return cls(unique, np.append(first, len(keys)), language.astype(np.uint16), value.astype(np.float32))

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The entries of the wanted keys: place in ``wanted``, language, value."""
        if not len(self.keys):
            return np.zeros(0, np.int64), self.language, self.value
        slot = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        n = np.where(self.keys[slot] == wanted, self.at[slot + 1] - self.at[slot], 0)
        entry = np.arange(n.sum()) + np.repeat(self.at[slot] - (np.cumsum(n) - n), n)
        return np.repeat(np.arange(len(wanted)), n), self.language[entry], self.value[entry]


@dataclass
class ContextTrees:
    """For each order, the bits of an escape by context and those of a byte by context and byte, of the languages that know
    the context. Contexts are their bytes as one number. The size is that of the different four-byte runs of the sample."""

    languages: list[str]
    escapes: list[Sparse]
    bits: list[Sparse]


def sample(docs: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` labelled rows of each language, all if it has fewer: those with the smallest hashes
    of their ids. Only the language column is counted; texts are read for the chosen rows alone."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()  # a row for each language
    if not counts:
        return labelled.select("lang", "text").limit(0)
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, rows / r["n"]))])
    draw = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    return labelled.filter(draw < share[F.col("lang")]).select("lang", "text")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Four bytes as one number and their count, per language and part of a batch."""
    for batch in in_parts(batches, "text"):
        data, offsets = utf8(batch.column(1))
        langs = batch.column(0).to_numpy(zero_copy_only=False)
        codes, names = np.unique(langs.astype(str), return_inverse=True)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        found, n = np.unique(names[row].astype(np.int64) << 32 | _grams(data, offsets), return_counts=True)
        yield pa.record_batch([pa.array(codes[found >> 32]), pa.array(found & 0xFFFFFFFF), pa.array(n)], ["lang", "gram", "n"])


def _grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each byte and the three before it in its row as one number; before a row's first stand zeros."""
    grams = data.astype(np.uint32)
    for back in range(1, ORDER + 1):
        before = np.zeros(len(data), np.uint32)
        before[back:] = data[: max(0, len(data) - back)]
        for k in range(back):
            at = offsets[:-1] + k
            before[at[at < offsets[1:]]] = 0
        grams |= before << np.uint32(8 * back)
    return grams


def fit(docs: DataFrame, sample_rows: int = 400, least: int = 2) -> ContextTrees:
    """Trees from a sample of about ``sample_rows`` labelled rows a language. Contexts of two or three bytes seen
    fewer than ``least`` times are pruned. The model has an entry for each context and follower that a language
    has seen, none for those that it has not, so its size is bounded by the sample's."""
    bound_batches(docs.sparkSession)
    counts = sample(docs, sample_rows).mapInArrow(_count, "lang string, gram long, n long")
    rows = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow().combine_chunks()
    found = rows["lang"].unique().to_pylist()
    languages = sorted(found)
    grams, n = rows["gram"].to_numpy(), rows["n"].to_numpy()
    name = rows["lang"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(rows) else np.zeros(0, int)
    name = np.array([languages.index(x) for x in found], np.int64)[name]  # both list the languages as they come
    trees = ContextTrees(languages, [], [])
    real = grams & 0xFF != 0  # byte 0 is the mark before a text
    grams, n, many = grams[real], n[real], max(1, len(languages))
    for order in range(ORDER + 1):
        # Entries (context, byte, language) with their counts, then (context, language) with the sums of theirs.
        entries, which = np.unique((grams & ((1 << 8 * (order + 1)) - 1)) * many + name[real], return_inverse=True)
        seen = np.bincount(which, n, len(entries))
        pair, language = entries // many, entries % many
        contexts, which, distinct = np.unique((pair >> 8) * many + language, return_inverse=True, return_counts=True)
        total = np.bincount(which, seen, len(contexts))
        known = total >= (least if order >= 2 else 1)
        kept = known[which]
        trees.bits.append(Sparse.of(pair[kept], language[kept], np.log2((total + distinct)[which[kept]] / seen[kept])))
        trees.escapes.append(Sparse.of(contexts[known] // many, contexts[known] % many, np.log2((total + distinct)[known] / distinct[known])))
    return trees


def bits_of(trees: ContextTrees, grams: np.ndarray) -> np.ndarray:
    """Code lengths of the last bytes of ``grams`` under each language: from the shortest context up, a byte seen in
    a context costs its bits there, any other the context's escape more than in the shorter one."""
    bits = np.full((len(grams), len(trees.languages)), 8.0, np.float32)  # at last all bytes are equal
    for order in range(ORDER + 1):
        pair = grams & ((1 << 8 * (order + 1)) - 1)
        row, language, escape = trees.escapes[order].find(pair >> 8)
        bits[row, language] += escape
        row, language, value = trees.bits[order].find(pair)
        bits[row, language] = value
    return bits


class CodeLengths:
    """A task's code lengths of the four-byte runs that it has met; when there is no room for more, it begins anew."""

    def __init__(self, trees: ContextTrees) -> None:
        self.trees, self.many = trees, len(trees.languages)
        self.block = max(1, BLOCK // self.many)
        self.rows = np.empty((max(1, HELD // self.many), self.many), np.float32)
        self.grams, self.place = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def places(self, grams: np.ndarray) -> np.ndarray:
        """Where in ``rows`` the code lengths of different ``grams``, in ascending order, are."""
        new = grams[~np.isin(grams, self.grams, assume_unique=True)]
        if len(self.grams) + len(new) > len(self.rows):
            self.grams, self.place, new = self.grams[:0], self.place[:0], grams
        if len(new):
            first = len(self.grams)
            self.rows[first : first + len(new)] = bits_of(self.trees, new)
            at = np.searchsorted(self.grams, new)
            self.grams = np.insert(self.grams, at, new)
            self.place = np.insert(self.place, at, np.arange(first, first + len(new)))
        return self.place[np.searchsorted(self.grams, grams)]

    def of_rows(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each row under each language, in blocks that are the shorter, the more languages there are."""
        bits = np.zeros((len(offsets) - 1, self.many))
        grams = _grams(data, offsets)
        full = np.flatnonzero(np.diff(offsets))
        for at in range(0, len(data), self.block):
            end = min(len(data), at + self.block)
            different, which = np.unique(grams[at:end], return_inverse=True)
            each = self.rows[self.places(different.astype(np.int64))[which]]
            lo, hi = np.searchsorted(offsets[full], at, "right") - 1, np.searchsorted(offsets[full], end, "left")
            rows = full[lo:hi]
            bits[rows] += np.add.reduceat(each, np.maximum(offsets[rows] - at, 0), axis=0, dtype=np.float64)
        return bits


NAMES = ("lang_pred", "score", "bits_per_byte")


def predict(docs: DataFrame, trees: ContextTrees, text: str = "text", names: tuple[str, str, str] = NAMES) -> DataFrame:
    """``docs`` with three columns more, called ``names``: the language, the score (posterior of the language, all
    being equally likely before) and the bits per byte under it. Columns of these names are replaced."""
    bound_batches(docs.sparkSession)
    added = dict(zip(names, ("string", "double", "double"), strict=True))
    docs = docs.drop(*added)
    letter = free_name("has_letter", docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(trees)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        names = np.array([*trees.languages, "und"], dtype=object)
        lengths = CodeLengths(trees) if trees.languages else None
        for batch in in_parts(batches, text):
            data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
            letters = batch.column(batch.schema.get_field_index(letter)).to_numpy(zero_copy_only=False).astype(bool)
            if lengths:
                bits = lengths.of_rows(data, offsets)
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(bits)), best]
                score = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
            else:
                best, least, score = (np.zeros(len(letters), t) for t in (int, float, float))
                letters = np.zeros(len(letters), bool)
            columns = [batch.column(i) for i, f in enumerate(batch.schema) if f.name != letter]
            columns.append(pa.array(names[np.where(letters, best, len(names) - 1)], pa.string()))
            columns.append(pa.array(np.where(letters, score, 0.0)))
            columns.append(pa.array(np.where(letters, least / np.maximum(np.diff(offsets), 1), 0.0)))
            yield pa.RecordBatch.from_arrays(columns, names=[*(f.name for f in batch.schema if f.name != letter), *added])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), *(f"{k} {v}" for k, v in added.items())])
    has = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return docs.withColumn(letter, has).mapInArrow(run, schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows that may be learned from: those whose crc32(doc_id as text) mod 4 is not 2."""
    return docs.filter(remainder("doc_id", 4) != 2)


def language_id(docs: DataFrame) -> DataFrame:
    """The query: one row per document with held_out, lang_pred and score."""
    trees = fit(training_rows(docs))
    scored = predict(docs.select("doc_id", "text"), trees)
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte")


def known_language(docs: DataFrame, trees: ContextTrees | None = None, most_bits: float = 8.0, least_bytes: int = 100) -> DataFrame:
    """The rows of ``docs``, columns unchanged, whose text has a letter and which the best language codes in fewer
    than ``most_bits`` bits a byte, that is better than no model at all. Texts under ``least_bytes`` are too short
    to reject for their code length."""
    trees = trees or fit(training_rows(docs))
    names = tuple(free_name(x, docs.columns) for x in NAMES)
    scored = predict(docs, trees, names=names)
    coded = (F.col(names[2]) < most_bits) | (F.octet_length("text") < least_bytes)
    return scored.filter((F.col(names[0]) != "und") & coded).select(*docs.columns)
