r"""Secret scans with a trigram index, in DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived: what every match must contain, as an
OR of ANDs. The index holds a posting (trigram, document) for each trigram that any rule asks for, of the text in
lower case. A document is a candidate of a rule if it stands in all postings of one AND; candidates alone are
verified with the regular expression. A rule without mandatory trigrams, such as ``[0-9a-f]{16,}``, scans every text.

Matches are leftmost and non-overlapping for each rule; those whose tested group is too short are dropped. Positions
are code points, the end exclusive. Rows: a NULL text is empty. Rows that share an id are candidates together and
verified each for itself; rows without an id are always verified. Repeated rows give repeated results.
"""

from __future__ import annotations

import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm.common import bound, checkpointed, free_name

#: Candidate ids that may be broadcast: two numbers each, 16 MB.
SMALL_IDS = 1_000_000
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """Matches of ``regex`` whose ``group`` has ``least`` characters at least."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1


BASE_RULES = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),  # the runs of [0-9a-f]+ that are long enough
)
# What stands between the lines of a key: white space, also escaped, quotes and comment marks.
_GAP = r"(?:\\[nrt]|[\s\"'\\>#*|,;]|\+(?=\s))"
_LINE_END = r"(?=[\"'`<](?![A-Za-z])|[,;]*+[\x20\t]*+(?:[\r\n\\]|\Z))"
# A long run of base64, or a whole line of it that is no plain word.
_KEY_LINE = rf"(?:[A-Za-z0-9+/]{{16,}}+={{0,2}}+|(?=[A-Za-z0-9+/]*[0-9+/=]|[A-Za-z]*[a-z][A-Z])[A-Za-z0-9+/]++={{0,2}}+{_LINE_END})"
_LAST_LINE = rf"(?:{_GAP}++(?:[A-Za-z0-9+/]++={{0,2}}+|={{1,2}}+){_LINE_END})?+"
#: A private key whole: from its first line to its END line, or, without one, over the header fields and base64 lines that follow.
KEY_BLOCK = Rule(
    "private_key",
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:[^-]|-(?!----))*+-----END [A-Z ]*PRIVATE KEY-----"
    rf"|(?:{_GAP}*+(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+(?:(?:{_GAP}++{_KEY_LINE})++{_LAST_LINE})?+)",
)
MORE_RULES = (
    KEY_BLOCK,
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_app", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES
#: What is taken out of texts: keys first, before other rules cut into their bodies.
TAKEN_OUT = (KEY_BLOCK, *[r for r in RULES if r is not KEY_BLOCK])


def _strings(items: list) -> set[str] | None:
    """All strings, in lower case, that a piece of a regular expression can match; None if too many."""
    found = {""}
    for op, value in items:
        if op is parser.LITERAL:
            some = {chr(value).lower()}
        elif op is parser.IN and all(o is parser.LITERAL for o, _ in value):
            some = {chr(v).lower() for _, v in value}
        elif op is parser.BRANCH:
            parts = [_strings(list(x)) for x in value[1]]
            some = None if None in parts else set().union(*parts)
        elif op is parser.SUBPATTERN:
            some = _strings(list(value[3]))
        elif op is parser.MAX_REPEAT and value[1] <= 2:
            once = _strings(list(value[2]))
            some = None if once is None else {"".join(x) for n in range(value[0], value[1] + 1) for x in product(once, repeat=n)}
        else:
            some = None
        if some is None or len(found) * len(some) > MOST_STRINGS:
            return None
        found = {a + b for a, b in product(found, some)}
    return found


Query = frozenset[frozenset[str]]  # an OR of ANDs of trigrams; an empty AND is true
EVERYTHING: Query = frozenset({frozenset()})


def _simple(query: set[frozenset[str]]) -> Query:
    """Without ANDs that ask for more than another does."""
    return frozenset(x for x in query if not any(y < x for y in query))


def _query(items: list) -> Query:
    """What every match of a sequence contains: the trigrams of its literal stretches."""
    query, stretch = EVERYTHING, {""}

    def both(a: Query, b: set[frozenset[str]]) -> Query:
        joined = _simple({x | y for x, y in product(a, b)})
        return joined if len(joined) <= MOST_STRINGS else a

    def close() -> None:
        nonlocal query, stretch
        query = both(query, {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in stretch})
        stretch = {""}

    for item in items:
        some = _strings([item])
        if some is not None and len(some) * len(stretch) <= MOST_STRINGS:
            stretch = {a + b for a, b in product(stretch, some)}
            continue
        close()
        op, value = item
        if some is not None:
            stretch = some
        elif op is parser.SUBPATTERN:
            query = both(query, set(_query(list(value[3]))))
        elif op is parser.BRANCH:
            query = both(query, set().union(*(_query(list(x)) for x in value[1])))
        elif op is parser.MAX_REPEAT and value[0] >= 1:
            query = both(query, set(_query(list(value[2]))))
    close()
    return query


def trigram_query(regex: str) -> Query:
    """The trigrams that every match of ``regex`` must contain in lower case: an OR of ANDs."""
    return _simple(set(_query(list(parser.parse(regex)))))


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The index: a row (trigram, doc_id) for each of ``trigrams`` that a text contains, in lower case."""
    lower = F.lower(F.col("text"))
    rows = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", lower.alias("lower"))
    held = F.array_compact(F.array(*[F.when(F.contains(F.col("lower"), F.lit(t)), F.lit(t)) for t in trigrams]))
    return rows.select("doc_id", F.explode(held).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(id, rules): the documents that satisfy a rule's query, the rules as a bit mask. Rules without a query are in
    nobody's mask."""
    spark = docs.sparkSession
    clauses = [(i, j, t, len(c)) for i, r in enumerate(rules) for j, c in enumerate(sorted(map(sorted, trigram_query(r.regex)))) for t in c]
    asked = sorted({t for _, _, t, _ in clauses})
    if not asked:
        return docs.select(F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("rules")).limit(0)
    table = spark.createDataFrame(clauses, "rule int, clause int, trigram string, size int")
    met = postings(docs, asked).join(F.broadcast(table), "trigram")  # a row for each trigram of a rule
    full = met.groupBy("doc_id", "rule", "clause", "size").agg(F.count_distinct("trigram").alias("n")).filter("n = size")
    return full.groupBy(F.col("doc_id").alias("id")).agg(F.expr("bit_or(shiftleft(1L, rule))").alias("rules"))


BLOCK = 128


def running(lengths: Column) -> Column:
    """The running sums of an array, in blocks, so that an array of any length takes little more than linear time."""

    def summed(x: Column) -> Column:
        return F.aggregate(x, F.array(F.lit(0).cast("long")), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))

    def joined(blocks: Column) -> Column:
        ahead = summed(F.transform(blocks, lambda x: F.element_at(x, -1)))
        moved = F.zip_with(blocks, F.slice(ahead, 1, F.size(blocks)), lambda x, o: F.transform(F.slice(x, 2, F.size(x) - 1), lambda v: v + o))
        return F.flatten(moved)

    def cut(x: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.greatest(F.size(x), F.lit(1)) - 1) / BLOCK).cast("int"))
        return F.transform(starts, lambda b: summed(F.slice(x, b * BLOCK + 1, F.lit(BLOCK))))

    return bound(lengths, lambda x: bound(cut(x), joined))


def _spans(text: Column, i: int, rule: Rule) -> Column:
    """The spans of rule ``i`` in ``text``: matches and the pieces between them give the positions."""
    matches = F.transform(F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0)), F.length)
    tested = F.transform(F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)), F.length)
    pieces = F.transform(F.split(text, rule.regex, -1), F.length)

    def span(z: Column) -> Column:
        return F.struct(z["s"].alias("start"), F.lit(i).alias("rule"), (z["s"] + z["m"]).alias("end"), z["g"].alias("g"))

    def placed(x: Column) -> Column:
        steps = F.zip_with(x["p"], F.concat(F.array(F.lit(0)), x["m"]), lambda p, m: p + m)
        zipped = F.arrays_zip(F.slice(running(steps), 1, F.size(x["m"])).alias("s"), x["m"].alias("m"), x["g"].alias("g"))
        return F.transform(F.filter(F.transform(zipped, span), lambda z: z["g"] >= rule.least), lambda z: F.struct(z["start"], z["rule"], z["end"]))

    return bound(F.struct(pieces.alias("p"), matches.alias("m"), tested.alias("g")), placed)


def find(docs: DataFrame, rules: tuple[Rule, ...] = RULES, name: str = "spans") -> DataFrame:
    """``docs`` with ``name``: an array of (start, rule, end) in order of start, then rule."""
    full = [trigram_query(r.regex) == EVERYTHING for r in rules]
    found = checkpointed(candidates(docs, rules))
    if found.count() <= SMALL_IDS:
        found = F.broadcast(found)
    taken = [*docs.columns, name, "id", "rules"]
    mask = free_name("mask", taken)
    found = found.withColumnRenamed("rules", mask).withColumnRenamed("id", key := free_name("key", [*taken, mask]))
    rows = docs.join(found, F.col("doc_id") == F.col(key), "left").drop(key)
    text = F.coalesce(F.col("text"), F.lit(""))
    matched = []
    for i, rule in enumerate(rules):
        wanted = F.lit(True) if full[i] else F.col("doc_id").isNull() | (F.coalesce(F.col(mask), F.lit(0)).bitwiseAND(F.lit(1 << i)) != 0)
        matched.append(free_name(f"found_{i}", [*taken, mask]))
        rows = rows.withColumn(matched[-1], F.when(wanted & F.regexp_like(text, F.lit(rule.regex)), _spans(text, i, rule)))
    empty = F.expr("CAST(array() AS ARRAY<STRUCT<start: BIGINT, rule: INT, end: BIGINT>>)")
    every = F.array_sort(F.concat(*[F.coalesce(F.col(c), empty) for c in matched]))
    return rows.select(*docs.columns, every.alias(name))


def listed(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["rule"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _equal_to(i: int):
    return lambda x: x == i


def secrets(docs: DataFrame, more: tuple[Rule, ...] = MORE_RULES) -> DataFrame:
    """The query: per document the counts and checksum of the base rules' spans, and all spans."""
    rules = BASE_RULES + more
    rows = find(docs.select("doc_id", "text"), rules)
    counts = [F.size(F.filter(F.transform("spans", lambda s: s["rule"]), _equal_to(i))).cast("long").alias(f"n_{r.kind}") for i, r in enumerate(BASE_RULES)]
    base = listed(F.filter("spans", lambda s: s["rule"] < len(BASE_RULES)), rules)
    return rows.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), listed(F.col("spans"), rules).alias("spans"))


def _redacted(rule: Rule):
    def body(text: Column) -> Column:
        found = F.arrays_zip(
            F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0)).alias("m"), F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)).alias("g")
        )
        shown = F.transform(found, lambda z: F.when(F.length(z["g"]) >= rule.least, F.lit(f"[{rule.kind}]")).otherwise(z["m"]))
        joined = F.zip_with(F.split(text, rule.regex, -1), shown, lambda piece, m: F.concat(piece, F.coalesce(m, F.lit(""))))
        return F.array_join(joined, "")

    return body


def without_secrets(docs: DataFrame, rules: tuple[Rule, ...] = TAKEN_OUT) -> DataFrame:
    """``docs``, columns unchanged, with each match replaced by its kind in brackets; n_chars follows the text.
    Rules are applied one after another. Of a private key the whole block is a match."""
    spans = free_name("spans", docs.columns)
    rows = find(docs, rules, spans)
    text = F.col("text")
    for rule in rules:
        text = bound(text, _redacted(rule))
    rows = rows.withColumn("text", F.when(F.size(spans) > 0, text).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)


# The SQL's own statement of kinds, expressions, tested groups and least lengths. The expressions of this dialect can't look
# ahead, so of a key without an END line it states the header and the long base64 lines, without fields and short lines.
_SQL_RULES = (
    ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
    (
        "private_key",
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:-{0,4}[^-])*-----END [A-Z ]*PRIVATE KEY-----|(?:\s+[A-Za-z0-9+/]{16,}={0,2})*)",
        0,
        1,
    ),
    ("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 1),
    ("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("chat_app", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
)


def _sql() -> str:
    """The same in DuckDB: for each expression the pieces around its matches give the positions."""
    parts = []
    for i, (_, regex, group, _) in enumerate(_SQL_RULES):
        regex = regex.replace("'", "''")
        parts.append(
            f"SELECT k, {i} AS rule, unnest(list_zip(list_transform(range(1, len(m) + 1), lambda i: CAST(coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0) "
            f"+ coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT)), m, g)) AS z "
            f"FROM (SELECT k, regexp_split_to_array(text, '{regex}') AS p, regexp_extract_all(text, '{regex}') AS m, regexp_extract_all(text, '{regex}', {group}) AS g FROM d)"
        )
    kinds = ", ".join(f"'{kind}'" for kind, *_ in _SQL_RULES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({' UNION ALL '.join(parts)}),
s AS (SELECT k, rule, z[1] AS b, z[1] + length(z[2]) AS e FROM f WHERE length(z[3]) >= [{', '.join(str(least) for *_, least in _SQL_RULES)}][rule + 1]),
t AS (SELECT k, rule, b, concat_ws(':', [{kinds}][rule + 1], b, e) AS x FROM s),
g AS (SELECT k, count(*) FILTER (WHERE rule = 0) AS n_assign, count(*) FILTER (WHERE rule = 1) AS n_access, count(*) FILTER (WHERE rule = 2) AS n_hex,
  string_agg(x, ',' ORDER BY b, rule) FILTER (WHERE rule < 3) AS base, string_agg(x, ',' ORDER BY b, rule) AS spans FROM t GROUP BY k)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (k)
"""


SECRETS_SQL = _sql()
