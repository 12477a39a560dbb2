r"""Quality rules, in DataFrame functions only: base rules on repetition and length, and the divergence of a document's
histograms from those of the languages.

For every document two histograms are counted: characters by class, and words by the common words of the languages, the
rest being one bin. A language's common words are the ``LISTED`` most frequent words with a letter in all documents with
its label, ties by the word; its reference is the sum over the same documents. Both are made for every label. A document
that is long enough is kept if the nearest reference is near on each histogram, by Jensen-Shannon distance (the
square root of the divergence in bits, 0 to 1). A histogram of too few characters or words is not judged. Without any
labelled document nothing is judged. The driver gets a row for each label and ``LISTED`` words of each; the work a row grows
with the number of labels.

Rows: a NULL text has no words. Words are cut at ASCII white space and compared with their case. Repeated rows are
judged each for itself; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.llm.common import bound, checkpointed

SPACE = r"[\x20\x09-\x0D]"
WINDOW = 8
LEAST_WORDS = 20
REPEATED_PERCENT = 30
#: Classes taken out of the text one after another; what is left is the last class.
CLASSES = {"lower": "[a-z]+", "space": SPACE + "+", "upper": "[A-Z]+", "digit": "[0-9]+", "mark": r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+", "other": ""}
SYMBOLS = "[#*$%&|<>]+"
#: Common words of a language.
LISTED = 20
JUDGED_CHARS, JUDGED_WORDS = 400, 100
MOST_CHARS, MOST_WORDS = 0.26, 0.36


def repeated_words(words: Column) -> Column:
    """How many words stand in windows of eight that occur twice or more."""

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def positions(hashes: Column) -> Column:
        by_hash = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(pairs: Column) -> Column:
            same = F.filter(pairs, lambda x, k: F.coalesce(F.get(pairs, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(pairs, k + 1)["h"] == x["h"], F.lit(False)))
            return F.array_sort(F.transform(same, lambda x: x["i"]))

        return bound(by_hash, twice)

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(bound(positions(hashes), covered))

    def of(w: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(w) - (WINDOW - 1))
        return F.when(F.size(w) <= WINDOW, F.lit(0)).otherwise(bound(F.transform(at, lambda i: F.xxhash64(F.slice(w, i, WINDOW))), count))

    return bound(words, of)


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def common_words(docs: DataFrame, listed: int = LISTED) -> list[str]:
    """The most frequent words of each label, in one list in order. Words are counted before the shuffle and each task
    passes on its best alone, so that no task orders a label's whole vocabulary."""
    words = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.explode(split_words(F.col("text"))).alias("word"))
    counts = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("word").rlike(r"\p{L}"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    best = counts.withColumn("place", place).filter(F.col("place") <= listed)
    return sorted({r["word"] for r in best.select("word").collect()}, key=str.encode)


def times_found(words: Column, listed: list[str]) -> Column:
    """How often each word of ``listed``, which is in order, stands in ``words``, and how many other words there are: the
    words found are sorted once, each listed one added to them, and the places where a new word begins are apart by its count
    and one."""
    if not listed:
        return F.array(F.size(words).cast("long"))

    def differences(begins: Column) -> Column:
        return F.zip_with(F.slice(begins, 2, len(listed)), F.slice(begins, 1, len(listed)), lambda b, a: (b - a - 1).cast("long"))

    def begins(found: Column) -> Column:
        new = F.filter(F.transform(found, lambda x, i: F.when((i == 0) | (F.get(found, i - 1) != x), i)), lambda i: i.isNotNull())
        return F.concat(new, F.array(F.size(found)))

    def counted(found: Column) -> Column:
        rest = (F.size(words) - (F.size(found) - len(listed))).cast("long")
        return F.concat(bound(begins(found), differences), F.array(rest))

    found = F.concat(F.filter(words, lambda w: w.isin(listed)), F.array(*[F.lit(w) for w in listed]))
    return bound(F.sort_array(found), counted)


def statistics(docs: DataFrame, listed: list[str]) -> DataFrame:
    """doc_id, lang, the base counts, ``chars`` and ``common``: the two histograms, in order of CLASSES and of ``listed``
    and the other words. One pass over the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split("t0", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    rows = docs.select("doc_id", "lang", text.alias("t0"))
    rows = rows.select("*", split_words(F.col("t0")).alias("words"), lines.alias("lines"))
    names = list(CLASSES)
    for i, name in enumerate(names[:-1]):
        rows = rows.withColumn(f"t{i + 1}", F.regexp_replace(f"t{i}", CLASSES[name], ""))
    sizes = [F.length(f"t{i}") for i in range(len(names))]
    chars = F.array(*[(a - b).cast("long") for a, b in zip(sizes, [*sizes[1:], F.lit(0)], strict=True)])
    digits_out = f"t{names.index('digit') + 1}"
    spaces_out = f"t{names.index('space') + 1}"
    return rows.select(
        "doc_id",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        (F.length("t0") - (F.length("t1") - F.length(spaces_out))).cast("long").alias("word_chars"),
        (F.length(digits_out) - F.length(F.regexp_replace(digits_out, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        chars.alias("chars"),
        times_found(F.col("words"), listed).alias("common"),
    )


def references(rows: DataFrame, n_listed: int) -> list[tuple[list[float], list[float]]]:
    """Shares of each language's characters and words, over all documents labelled with it."""
    sums = [F.sum(F.col("chars")[i]).alias(f"c{i}") for i in range(len(CLASSES))]
    sums += [F.sum(F.col("common")[i]).alias(f"w{i}") for i in range(n_listed + 1)]
    found = rows.filter(F.col("lang").isNotNull()).groupBy("lang").agg(*sums).orderBy("lang").collect()
    pairs = [[[float(r[f"{k}{i}"]) for i in range(n)] for k, n in (("c", len(CLASSES)), ("w", n_listed + 1))] for r in found]
    return [tuple([v / sum(x) for v in x] for x in pair) for pair in pairs if all(sum(x) for x in pair)]


def distance(counts: Column, total: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance of a histogram from a reference."""
    shares = F.array(*[F.lit(v) for v in reference])

    def part(n: Column, q: Column) -> Column:
        return bound(n / total, lambda p: _half(p, p + q) + _half(q, p + q))

    whole = F.aggregate(F.zip_with(counts, shares, part), F.lit(0.0), lambda a, b: a + b)
    return F.sqrt(F.greatest(whole, F.lit(0.0)))


def _half(p: Column, both: Column) -> Column:
    return F.when(p > 0, 0.5 * p * F.log2(2 * p / both)).otherwise(F.lit(0.0))


def judged(docs: DataFrame, most_chars: float = MOST_CHARS, most_words: float = MOST_WORDS) -> DataFrame:
    """The statistics with char_distance and word_distance (of the nearest language; NULL if too short), base_failed
    and kept."""
    docs = docs.select("doc_id", "text", docs["lang"] if "lang" in docs.columns else F.lit(None).cast("string").alias("lang"))
    listed = common_words(docs)
    rows = checkpointed(statistics(docs, listed))
    n_chars = F.aggregate("chars", F.lit(0).cast("long"), lambda a, b: a + b)
    near = references(rows, len(listed))
    rows = rows.withColumn("n_chars", n_chars)
    least = lambda columns: F.array_min(F.array(*columns)) if columns else F.lit(None).cast("double")
    char_distance = least([distance(F.col("chars"), F.col("n_chars"), c) for c, _ in near])
    word_distance = least([distance(F.col("common"), F.col("n_words"), w) for _, w in near])
    rows = rows.withColumn("char_distance", F.when(F.col("n_chars") >= JUDGED_CHARS, char_distance))
    rows = rows.withColumn("word_distance", F.when(F.col("n_words") >= JUDGED_WORDS, word_distance))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    far = F.coalesce(F.col("char_distance") > most_chars, F.lit(False)) | F.coalesce(F.col("word_distance") > most_words, F.lit(False))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & ~far)


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def quality_rules(docs: DataFrame) -> DataFrame:
    """The query: the base counts, base_failed and kept of every document."""
    return judged(docs).select(*COLUMNS)


def _sql() -> str:
    take = lambda t, regex: f"regexp_replace({t}, '{regex}', '', 'g')"
    names = list(CLASSES)
    texts = ", ".join(f"{take(f't{i}', CLASSES[n])} AS t{i + 1}" for i, n in enumerate(names[:-1]))
    chars = ", ".join([f"length(t{i}) - length(t{i + 1})" for i in range(len(names) - 1)] + [f"length(t{len(names) - 1})"])
    spaces_out, digits_out = names.index("space") + 1, names.index("digit") + 1
    return f"""
WITH a AS (SELECT row_number() OVER () AS k, doc_id, lang, coalesce(text, '') AS t0 FROM documents),
b AS (SELECT *, {texts}, list_filter(regexp_split_to_array(t0, '{SPACE}+'), lambda x: x <> '') AS words,
  list_filter(string_split(t0, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM a),
c AS (SELECT lang, w, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, w) AS place
  FROM (SELECT lang, unnest(words) AS w FROM b WHERE lang IS NOT NULL) WHERE regexp_matches(w, '\\p{{L}}') GROUP BY lang, w),
e AS (SELECT coalesce(list(DISTINCT w ORDER BY w), []) AS listed FROM c WHERE place <= {LISTED}),
v AS (SELECT k, unnest(range(1, len(words) - 6)) AS i, words FROM b),
h AS (SELECT k, i, array_to_string(words[i:i + 7], ' ') AS w FROM v),
o AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, w) AS n FROM h) WHERE n > 1),
r AS (SELECT k, sum(least(8, coalesce(nxt - i, 8))) AS n FROM (SELECT k, i, lead(i) OVER (PARTITION BY k ORDER BY i) AS nxt FROM o) GROUP BY k),
s AS (SELECT k, doc_id, lang, CAST(len(words) AS BIGINT) AS n_words, length(t0) - (length(t1) - length(t{spaces_out})) AS word_chars,
  length(t{digits_out}) - length({take(f't{digits_out}', SYMBOLS)}) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
  [{chars}] AS chars, length(t0) AS n_chars,
  list_concat(list_transform(listed, lambda w: len(list_filter(words, lambda x: x = w))),
    [len(list_filter(words, lambda x: NOT list_contains(listed, x)))]) AS common FROM b LEFT JOIN r USING (k) CROSS JOIN e),
u AS (SELECT k, lang, 0 AS kind, unnest(range(1, len(chars) + 1)) AS i, unnest(chars) AS n FROM s
  UNION ALL SELECT k, lang, 1, unnest(range(1, len(common) + 1)), unnest(common) FROM s),
q AS (SELECT lang, kind, i, sum(n) / sum(sum(n)) OVER (PARTITION BY lang, kind) AS q FROM u
  WHERE lang IN (SELECT lang FROM s GROUP BY lang HAVING sum(n_words) > 0) GROUP BY lang, kind, i),
d AS (SELECT k, kind, min(d) AS d FROM (
  SELECT k, kind, q.lang, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN 0.5 * p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN 0.5 * q * log2(2 * q / (p + q)) ELSE 0 END))) AS d
  FROM (SELECT k, kind, i, n / sum(n) OVER (PARTITION BY k, kind) AS p, sum(n) OVER (PARTITION BY k, kind) AS total FROM u) x
  JOIN q USING (kind, i) WHERE total > 0 GROUP BY k, kind, q.lang) GROUP BY k, kind)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed, NOT failed
  AND NOT (n_chars >= {JUDGED_CHARS} AND coalesce(c.d, 0) > {MOST_CHARS}) AND NOT (n_words >= {JUDGED_WORDS} AND coalesce(w.d, 0) > {MOST_WORDS}) AS kept
FROM (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED_PERCENT} * n_words AS failed FROM s) s
LEFT JOIN (SELECT k, d FROM d WHERE kind = 0) c USING (k) LEFT JOIN (SELECT k, d FROM d WHERE kind = 1) w USING (k)
"""


QUALITY_SQL = _sql()
