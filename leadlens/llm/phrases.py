"""Phrase collocations by best-first branch-and-bound growth.

Texts (A-Z in lower case) are cut into pieces at ``.,;:!?`` and line breaks, pieces into words at spaces and tabs. Per
language, with f the number of occurrences of a word sequence inside pieces: a phrase of two or three words with
a = f >= 10 is a candidate. Cutting it after k words gives l = f(first part), r = f(rest) and floor(1000000 a a / (l r));
its score is that of the worst cut. A pair inside a candidate of three words with at least half its count is dropped.

Growth goes by level. Words are counted first, then pairs of words of ten occurrences or more. A pair w x is the prefix of
phrases that score at most 1000000 f(w x) / f(w), as a <= f(w x) and r >= a, and its count bounds what ends in it the same
way: w y x at most 1000000 f(y x) / f(x). The frontier of a language are its pairs by these bounds. Growth takes the best
of them first: all with bounds of at least a threshold, which is the score that the language's 4,000th best pair reaches, and
those that contain a pair scoring as high (they decide whether it is dropped). Every phrase that scores the threshold or more is then known. If fewer
than 2,000 of them survive, the language is not settled: its threshold goes on to the 16,000th pair, and so on down to 0. Ties at the threshold are
all grown.

Tasks sift words and pairs by filters of fixed size (8 MB), which may let through what joins on the exact counts take out
later, and keep nothing back. Counts are summed in the task before they are shuffled. Words are told apart by 64-bit
hashes of language and word. Products are made in 38 digits.

Rows: a NULL or empty text has no words; a NULL language is ``und``. Repeated rows count as often as they stand there.
Texts of any length are read whole. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.llm.common import bound_batches, checkpointed, in_parts, mix, utf8, word_hashes
from leadlens.llm.grams import contains, filter_of, run_bounds

LEAST, TOP, SHARE = 10, 2000, 50
#: The threshold is first the score of this many best pairs a language, then of four times as many, and so on.
FIRST_REACH, GROWTH = 2 * TOP, 4
#: Sequences and words that a task holds before it sums them.
_SEQUENCES, _WORDS = 1 << 20, 1 << 17

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
_APART = _BREAK.copy()
_APART[list(b"\x20\x09")] = True


def _salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Words:
    """The words of a batch of (text, lang): bytes in lower case, bounds, hashes of language and word, row, and whether the
    next word stands in the same piece."""

    def __init__(self, batch: pa.RecordBatch):
        data, offsets = utf8(batch.column(0))
        self.starts, self.ends, first = run_bounds(~_APART[data], offsets)
        self.data = _LOWER[data]
        self.langs = ["und" if x is None else x for x in batch.column(1).to_pylist()]
        salts = np.array([_salt(x) for x in self.langs], np.uint64)
        self.row = np.repeat(np.arange(batch.num_rows), np.diff(first))
        self.hashes = mix(word_hashes(self.data, self.starts, self.ends) ^ salts[self.row])
        broken = np.concatenate(([0], np.cumsum(_BREAK[data])))
        self.joined = np.zeros(len(self.starts), bool)
        self.joined[:-1] = (self.row[1:] == self.row[:-1]) & (broken[self.starts[1:]] == broken[self.ends[:-1]])


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(first.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + second.view(np.uint64))


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, hash (h) and occurrences (f) of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, bytes], list[int]] = {}

        def out() -> pa.RecordBatch:
            langs, words = zip(*held, strict=True) if held else ((), ())
            hashes, counts = zip(*held.values(), strict=True) if held else ((), ())
            columns = [pa.array(langs, pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(hashes, pa.int64()), pa.array(counts, pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["lang", "word", "h", "f"])

        for batch in in_parts(batches, "text", 1 << 20):
            words = Words(batch)
            hashes, one, counts = np.unique(words.hashes, return_index=True, return_counts=True)
            whole = words.data.tobytes()
            langs = [words.langs[i] for i in words.row[one]]
            for lang, s, e, h, n in zip(langs, words.starts[one].tolist(), words.ends[one].tolist(), hashes.view(np.int64).tolist(), counts.tolist(), strict=True):
                held.setdefault((lang, whole[s:e]), [h, 0])[1] += n
            if len(held) >= _WORDS:
                yield out()
        yield out()

    rows = docs.select("text", "lang").mapInArrow(run, "lang string, word string, h long, f long")
    return rows.groupBy("lang", "word", "h").agg(F.sum("f").alias("f"))


def sequence_counts(docs: DataFrame, width: int, chosen: Callable[[Words], np.ndarray], least: int = LEAST) -> DataFrame:
    """h1 .. and a: hashes and occurrences of the sequences of ``width`` words that begin at the ``chosen`` words of a batch."""
    names = [f"h{k}" for k in range(1, width + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> Iterator[pa.RecordBatch]:
            rows = np.concatenate([np.zeros((width, 0), np.uint64), *held], axis=1)
            held.clear()
            key = rows[0]
            for other in rows[1:]:
                key = pair_hash(key, other)
            _, one, counts = np.unique(key, return_index=True, return_counts=True)
            for s in range(0, len(one), 1 << 17):
                part = one[s : s + (1 << 17)]
                columns = [pa.array(h[part].view(np.int64)) for h in rows] + [pa.array(counts[s : s + (1 << 17)].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "a"])

        for batch in in_parts(batches, "text", 1 << 20):
            words = Words(batch)
            at = np.flatnonzero(chosen(words))
            held.append(np.stack([words.hashes[at + k] for k in range(width)]))
            if sum(x.shape[1] for x in held) >= _SEQUENCES:
                yield from out()
        yield from out()

    schema = ", ".join(f"{x} long" for x in [*names, "a"])
    counted = docs.select("text", "lang").mapInArrow(run, schema).groupBy(*names).agg(F.sum("a").alias("a"))
    return counted.where(F.col("a") >= least)


def pair_counts(docs: DataFrame, words: DataFrame, least: int = LEAST) -> DataFrame:
    """Pairs of neighbouring words of ``words``."""
    known = docs.sparkSession.sparkContext.broadcast(filter_of(words.select("h"), lambda t: t["h"].to_numpy()))  # 8 MB

    def chosen(words: Words) -> np.ndarray:
        frequent = contains(known.value, words.hashes)
        out = words.joined & frequent
        out[:-1] &= frequent[1:]
        return out

    return sequence_counts(docs, 2, chosen, least)


def triple_counts(docs: DataFrame, pairs: DataFrame, least: int = LEAST) -> DataFrame:
    """Sequences of three words that begin with a pair whose ``prefix`` holds and end with one whose ``suffix`` holds, or contain
    one whose ``inside`` holds."""
    spark = docs.sparkSession
    of = {name: pairs.where(name).select("h1", "h2") for name in ("prefix", "suffix", "inside")}
    known = {name: spark.sparkContext.broadcast(filter_of(some, lambda t: pair_hash(t["h1"].to_numpy(), t["h2"].to_numpy()))) for name, some in of.items()}

    def chosen(words: Words) -> np.ndarray:
        out = words.joined.copy()
        out[:-1] &= words.joined[1:]
        at = np.flatnonzero(out)
        first, second = pair_hash(words.hashes[at], words.hashes[at + 1]), pair_hash(words.hashes[at + 1], words.hashes[at + 2])
        inside = known["inside"].value
        out[at] = contains(known["prefix"].value, first) & contains(known["suffix"].value, second) | contains(inside, first) | contains(inside, second)
        return out

    return sequence_counts(docs, 3, chosen, least)


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)), in whole numbers of 38 digits."""
    return F.expr(f"(CAST(1000000 AS DECIMAL(38, 0)) * {a} * {a}) div (CAST({left} AS DECIMAL(38, 0)) * {right})")


def thresholds(pairs: DataFrame, reach: int) -> DataFrame:
    """lang and threshold: a score that at least ``reach`` pairs of the language reach, 0 if it has fewer. Scores are counted in
    2,001 steps, so a language has as many rows at most."""
    steps = pairs.groupBy("lang", F.expr("score div 500").alias("step")).agg(F.count("*").alias("n"))
    down = Window.partitionBy("lang").orderBy(F.desc("step"))
    upto = steps.select("lang", "step", F.sum("n").over(down).alias("upto"))
    return upto.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("upto") >= reach, F.col("step") * 500)), F.lit(0)).alias("threshold"))


def grown(docs: DataFrame, pairs: DataFrame, words: DataFrame, wanted: DataFrame, least: int, share: int) -> DataFrame:
    """lang, threshold, h1, h2, h3 (NULL for a pair), a, l, r, score of the surviving phrases that reach the ``threshold`` of their language in ``wanted``."""
    pairs = pairs.join(wanted, "lang")
    bounded = pairs.select(
        "h1", "h2",
        F.expr("1000000 * a >= threshold * l").alias("prefix"), F.expr("1000000 * a >= threshold * r").alias("suffix"), F.expr("score >= threshold").alias("inside"),
    )
    triples = checkpointed(triple_counts(docs, bounded, least))
    holders = triples.select("h1", "h2", "a").union(triples.select("h2", "h3", "a")).groupBy("h1", "h2").agg(F.max("a").alias("longest"))
    kept = pairs.where("score >= threshold").join(holders, ["h1", "h2"], "left")
    kept = kept.where(f"longest IS NULL OR 100 * longest < {share} * a")
    two = kept.select("lang", "threshold", "h1", "h2", F.lit(None).cast("long").alias("h3"), "a", "l", "r", "score")
    ends = pairs.select("lang", "threshold", "h1", "h2", F.col("a").alias("f12"), F.col("l").alias("f1"))
    starts = pairs.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("f23"), F.col("r").alias("f3"))
    cuts = triples.join(ends, ["h1", "h2"]).join(starts, ["h2", "h3"])
    cuts = cuts.select(
        "lang", "threshold", "h1", "h2", "h3", "a",
        F.least(  # ties go to the first cut
            F.struct(score("a", "f1", "f23").alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.col("f23").alias("r")),
            F.struct(score("a", "f12", "f3").alias("score"), F.lit(2).alias("k"), F.col("f12").alias("l"), F.col("f3").alias("r")),
        ).alias("cut"),
    )
    three = cuts.where("cut.score >= threshold").select("lang", "threshold", "h1", "h2", "h3", "a", "cut.l", "cut.r", "cut.score")
    return two.union(three)


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, share: int = SHARE, reach: int = FIRST_REACH) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` surviving phrases of each language."""
    bound_batches(docs.sparkSession)
    every = checkpointed(word_counts(docs))
    totals = checkpointed(every.groupBy("lang").agg(F.sum("f").alias("n")))
    words = checkpointed(every.where(F.col("f") >= least))
    pairs = pair_counts(docs, words, least)
    pairs = pairs.join(words.select("lang", F.col("h").alias("h1"), F.col("f").alias("l")), "h1")
    pairs = pairs.join(words.select(F.col("h").alias("h2"), F.col("f").alias("r")), "h2")
    pairs = checkpointed(pairs.select("lang", "h1", "h2", "a", "l", "r", score("a", "l", "r").alias("score")))
    left, settled = checkpointed(thresholds(pairs, reach)), []
    while True:
        found = checkpointed(grown(docs, pairs, words, left, least, share))
        alive = found.groupBy("lang").agg(F.count("*").alias("alive"))
        state = left.join(alive, "lang", "left").select("lang", "threshold", F.expr(f"threshold = 0 OR coalesce(alive, 0) >= {top}").alias("settled"))
        state = checkpointed(state)
        settled.append(found.join(state.where("settled").select("lang"), "lang", "left_semi"))
        if not state.where("NOT settled").head(1):
            break
        reach *= GROWTH
        left = checkpointed(thresholds(pairs.join(state.where("NOT settled").select("lang"), "lang", "left_semi"), reach))
    out = settled[0]
    for more in settled[1:]:
        out = out.union(more)
    for k in (1, 2, 3):
        out = out.join(words.select(F.col("h").alias(f"h{k}"), F.col("word").alias(f"w{k}")), f"h{k}", "left")
    out = out.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    ranked = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = out.select("*", F.row_number().over(ranked).cast("long").alias("rank")).where(F.col("rank") <= top)
    return out.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


PHRASES_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
cut AS (SELECT doc, lang, regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]') AS pieces FROM texts),
pieces AS (SELECT doc, lang, unnest(range(1, len(pieces) + 1)) AS piece, unnest(pieces) AS text FROM cut),
split AS (SELECT doc, lang, piece, regexp_extract_all(text, '[^\x20\x09]+') AS words FROM pieces),
words AS (SELECT doc, lang, piece, unnest(range(1, len(words) + 1)) AS place, unnest(words) AS w1 FROM split),
follows AS (SELECT lang, w1, lead(w1) OVER w AS w2, lead(w1, 2) OVER w AS w3 FROM words WINDOW w AS (PARTITION BY doc, piece ORDER BY place)),
ones AS (SELECT lang, w1, count(*) AS f FROM follows GROUP BY ALL),
twos AS (SELECT lang, w1, w2, count(*) AS f FROM follows WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
threes AS (SELECT lang, w1, w2, w3, count(*) AS f FROM follows WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, sum(f) AS n FROM ones GROUP BY lang),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM twos t JOIN ones x ON x.lang = t.lang AND x.w1 = t.w1 JOIN ones y ON y.lang = t.lang AND y.w1 = t.w2
  WHERE NOT EXISTS (SELECT 1 FROM threes h WHERE h.lang = t.lang AND h.w1 = t.w1 AND h.w2 = t.w2 AND 100 * h.f >= 50 * t.f)
    AND NOT EXISTS (SELECT 1 FROM threes h WHERE h.lang = t.lang AND h.w2 = t.w1 AND h.w3 = t.w2 AND 100 * h.f >= 50 * t.f)
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f
  FROM threes t JOIN ones x ON x.lang = t.lang AND x.w1 = t.w1 JOIN twos y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f
  FROM threes t JOIN twos x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN ones y ON y.lang = t.lang AND y.w1 = t.w3),
scored AS (SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM cuts),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst)
SELECT ranked.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
