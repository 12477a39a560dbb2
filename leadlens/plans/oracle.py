"""The registered queries once more as plain SQL, for comparison in another engine.

Column order tables and the like are generated from the dictionary; everything else is written
out independently of the DataFrame code.
"""

from __future__ import annotations

from leadlens.dictionary import CONTACTS, INSIGHT_COLUMNS, SCAN_THRESHOLDS

_CONTACTS = """
lines AS (SELECT l_orderkey, count(*) AS n_lines, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey),
hist AS (
  SELECT *, row_number() OVER w - 1 AS n_prev, lag(o_orderdate) OVER w AS prev_date, lag(o_orderstatus) OVER w AS prev_status,
    year(o_orderdate) * 12 + month(o_orderdate) AS ym
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey, o_orderstatus)),
contacts AS (
  SELECT CAST(o_orderkey AS BIGINT) AS id,
    CAST(18 + (o_custkey * 7 + c_nationkey) % 65 AS DOUBLE) AS age,
    CASE WHEN o_orderkey % 41 = 0 THEN 'unknown' ELSE lower(c_mktsegment) END AS job,
    CASE c_nationkey % 3 WHEN 0 THEN 'single' WHEN 1 THEN 'married' ELSE 'divorced' END AS marital,
    CASE o_custkey % 8 WHEN 0 THEN 'unknown' WHEN 1 THEN 'illiterate' WHEN 2 THEN 'basic.4y' WHEN 3 THEN 'basic.6y'
      WHEN 4 THEN 'basic.9y' WHEN 5 THEN 'high.school' WHEN 6 THEN 'professional.course' ELSE 'university.degree' END AS education,
    CASE WHEN o_custkey % 9 < 2 THEN 'unknown' ELSE 'no' END AS "default",
    CASE WHEN o_custkey % 25 = 0 THEN 'unknown' WHEN o_custkey % 2 = 0 THEN 'yes' ELSE 'no' END AS housing,
    CASE WHEN o_custkey % 27 = 0 THEN 'unknown' WHEN o_custkey % 6 = 0 THEN 'yes' ELSE 'no' END AS loan,
    CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM') THEN 'cellular' ELSE 'telephone' END AS contact,
    lower(strftime(o_orderdate, '%b')) AS month,
    lower(strftime(o_orderdate, '%a')) AS day_of_week,
    CAST(date_diff('day', o_orderdate, last_ship) AS DOUBLE) AS duration,
    CAST(coalesce(n_lines, 1) AS DOUBLE) AS campaign,
    CAST(coalesce(date_diff('day', prev_date, o_orderdate), 999) AS DOUBLE) AS pdays,
    CAST(n_prev AS DOUBLE) AS previous,
    CASE prev_status WHEN 'F' THEN 'success' WHEN 'O' THEN 'failure' WHEN 'P' THEN 'failure' ELSE 'nonexistent' END AS poutcome,
    CAST((ym * 7) % 45 AS DOUBLE) / 10 - 3 AS emp_var_rate,
    CAST((ym * 11) % 25 AS DOUBLE) / 10 + 92 AS cons_price_index,
    CAST((ym * 13) % 110 AS DOUBLE) / 10 - 46 AS cons_conf_index,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST((ym * 17) % 37 AS DOUBLE) / 10 + CAST(0.8 AS DOUBLE) END AS lending_rate3m,
    CAST(4950 + (ym * 19) % 281 AS DOUBLE) AS nr_employed,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL
      WHEN o_orderstatus = 'F' AND (prev_status = 'F' OR coalesce(n_lines, 1) <= 2) THEN 'yes' ELSE 'no' END AS subscribe
  FROM hist JOIN customer ON o_custkey = c_custkey LEFT JOIN lines ON o_orderkey = l_orderkey)"""

_TIED = "s AS (SELECT CAST(l_returnflag = 'R' AS INT) AS label, round(l_discount * 10, 6) AS score FROM lineitem)"
_FINE = """s AS (SELECT CAST(l_returnflag = 'R' AS INT) AS label,
  l_extendedprice / ((SELECT max(l_extendedprice) FROM lineitem) + 1) AS score FROM lineitem)"""
_HIST = """h AS (SELECT score, count(*) FILTER (label = 1) AS tp, count(*) FILTER (label <> 1) AS fp FROM s GROUP BY score),
c AS (SELECT *, CAST(sum(tp) OVER w AS BIGINT) AS cum_tp, CAST(sum(fp) OVER w AS BIGINT) AS cum_fp,
  CAST(sum(tp) OVER () AS BIGINT) AS p, CAST(sum(fp) OVER () AS BIGINT) AS n FROM h WINDOW w AS (ORDER BY score DESC))"""

_KEEP = "contact IN ('cellular') AND age BETWEEN 30 AND 60"


def _q(column: str) -> str:
    return f'"{column}"'


def _s(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


def _contacts(sql: str, *parts: str) -> str:
    return _with(_CONTACTS, *parts) + sql


def _ranked(scores: str, sql: str, *parts: str) -> str:
    return _with(scores, _HIST, *parts) + sql


def _union(selects) -> str:
    return "\nUNION ALL\n".join(selects)


def _pairs(columns, source: str, extra: str = "") -> str:
    """(column, value) pairs of the named columns as a CTE body."""
    parts = [f"SELECT {extra}{_s(c)} AS \"column\", {_q(c)} AS value FROM {source} WHERE {_q(c)} IS NOT NULL" for c in columns]
    return _union(parts)


_ORDERS = ", ".join(f"({_s(c)}, {_s(v)}, {i})" for c, order in CONTACTS.orders.items() for i, v in enumerate(order))
_DECLARED = f"declared(col, val, pos) AS (VALUES {_ORDERS})"
_IS_DECLARED = "(\"column\" IN (" + ", ".join(_s(c) for c in CONTACTS.orders) + "))"


def _domain(columns) -> str:
    return _contacts(
        f"""SELECT k."column", value, n, row_number() OVER (PARTITION BY k."column"
          ORDER BY coalesce(pos, 1000000), CASE WHEN {_IS_DECLARED} THEN 0 ELSE -n END, value) - 1 AS position
        FROM k LEFT JOIN declared ON k."column" = col AND value = val""",
        _DECLARED,
        f'k AS (SELECT "column", value, count(*) AS n FROM ({_pairs(columns, "contacts")}) GROUP BY 1, 2)',
    )


def _segments(columns, source: str, target: str, positive: str) -> str:
    pairs = _pairs(columns, source, f"CAST({target} AS VARCHAR) AS label, ")
    return f"""g AS (SELECT "column", value, count(label) AS n, count(*) FILTER (label = {_s(positive)}) AS n_pos,
      CAST(count(*) FILTER (label = {_s(positive)}) AS DOUBLE) / nullif(count(label), 0) AS rate FROM ({pairs}) GROUP BY 1, 2)"""


_RATE_ORDER = f"""SELECT g.*, row_number() OVER (PARTITION BY g."column" ORDER BY coalesce(pos, 999),
    CASE WHEN {_IS_DECLARED} THEN NULL ELSE rate END DESC NULLS LAST, value) - 1 AS position
  FROM g LEFT JOIN declared ON g."column" = col AND value = val"""


def _histogram(source: str, column: str, prefix: str = "", label: str = "") -> str:
    extra = f", {label} AS label" if label else ""
    return f"""WITH {prefix} b AS (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM {source}),
    w AS (SELECT lo, (hi - lo) / 40 AS w FROM b),
    r AS (SELECT CAST(least(floor(({column} - lo) / w), 39) AS BIGINT) AS bin, lo AS low, w{extra}
      FROM {source}, w WHERE {column} IS NOT NULL {f"AND {label} IS NOT NULL" if label else ""})
    SELECT bin, low + bin * w AS lo, low + (bin + 1) * w AS hi{", label" if label else ""}, count(*) AS n
    FROM r GROUP BY bin, low, w{", label" if label else ""}"""


def _quantile_bins(source: str, column: str, bins: int, label: str, positive: str, prefix: str = "") -> str:
    fractions = ", ".join(f"CAST({i / bins!r} AS DOUBLE)" for i in range(bins + 1))
    return f"""WITH {prefix} q AS (SELECT unnest(quantile_cont(CAST({column} AS DOUBLE), [{fractions}])) AS e FROM {source}),
    e AS (SELECT DISTINCT round(e, 9) AS e FROM q),
    bounds AS (SELECT row_number() OVER (ORDER BY e) - 1 AS bin, e AS lo, lead(e) OVER (ORDER BY e) AS hi FROM e),
    b AS (SELECT * FROM bounds WHERE hi IS NOT NULL)
    SELECT bin, lo, hi, count({label}) AS n, count(*) FILTER ({label} = {_s(positive)}) AS n_pos,
      CAST(count(*) FILTER ({label} = {_s(positive)}) AS DOUBLE) / nullif(count({label}), 0) AS rate
    FROM (SELECT CAST({column} AS DOUBLE) AS x, CAST({label} AS VARCHAR) AS {label} FROM {source}) t
    JOIN b ON (x > lo OR (bin = 0 AND x >= lo)) AND (x <= hi OR (bin = (SELECT max(bin) FROM b) AND x > lo))
    GROUP BY bin, lo, hi"""


def _all_quantiles() -> str:
    tenths = ", ".join(f"CAST({k / 10!r} AS DOUBLE)" for k in range(11))
    return _union(
        [
            f"""SELECT {_s(c)} AS "column", unnest([{tenths}]) AS fraction, round(unnest(quantile_cont(CAST({c} AS DOUBLE), [{tenths}])), 9) AS value FROM contacts"""
            for c in CONTACTS.numerics
        ]
    )


def _all_quantile_bins() -> str:
    parts = [f"SELECT {_s(c)} AS \"column\", * FROM ({_quantile_bins('contacts', c, 8, 'subscribe', 'yes')})" for c in CONTACTS.numerics]
    return _contacts(_union([p.replace("WITH  q AS", "WITH q AS") for p in parts]))


def _correlations() -> str:
    names = [*CONTACTS.numerics, "one", "subscribe"]
    values = {c: _q(c) for c in names}
    values["one"] = "CAST(1 AS DOUBLE)"
    values["subscribe"] = "CASE WHEN subscribe = 'yes' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    parts = []
    for a in names:
        for b in names:
            if "one" in (a, b):
                r = "CASE WHEN count(*) < 0 THEN 0::DOUBLE END"
            else:
                r = f"round(corr({values[a]}, {values[b]}), 3) + CAST(0 AS DOUBLE)"
            parts.append(f"SELECT {_s(a)} AS x, {_s(b)} AS y, {r} AS r FROM contacts")
    return _union(parts)


def _missing() -> str:
    parts = []
    for i, c in enumerate((*CONTACTS.categoricals, *CONTACTS.numerics)):
        kind = "categorical" if c in CONTACTS.categoricals else "numeric"
        gap = f"{_q(c)} = 'unknown'" if kind == "categorical" else f"{_q(c)} IS NULL"
        parts.append(
            f"""SELECT {_s(c)} AS "column", {_s(kind)} AS kind, count(*) FILTER ({gap}) AS n_missing,
              CAST(count(*) FILTER ({gap}) AS DOUBLE) / count(*) AS share, count(*) FILTER ({_q(c)} IS NULL) AS n_null,
              CAST({i} AS BIGINT) AS dictionary_position FROM contacts"""
        )
    return _union(parts)


def _dictionary() -> str:
    parts = []
    for i, c in enumerate(CONTACTS.columns):
        title, meaning = CONTACTS.descriptions[c]
        parts.append(
            f"""SELECT CAST({i} AS BIGINT) AS position, {_s(c)} AS "column", {_s(title)} AS title, {_s(meaning)} AS meaning,
              count(*) AS n_rows, count(*) FILTER ({_q(c)} IS NULL) AS n_null FROM contacts"""
        )
    return _union(parts)


def _audit() -> str:
    rules = {
        "age_17_to_100": "age < 17 OR age > 100",
        "month_known": "month NOT IN (" + ", ".join(map(_s, CONTACTS.orders["month"])) + ")",
        "day_of_week_known": "day_of_week NOT IN ('mon', 'tue', 'wed', 'thu', 'fri')",
        "campaign_at_least_1": "campaign < 1",
        "previous_not_negative": "previous < 0",
        "subscribe_known": "subscribe NOT IN ('yes', 'no')",
    }
    rules |= {f"{c}_not_null": f"{_q(c)} IS NULL" for c in ("id", *CONTACTS.numerics, *CONTACTS.categoricals)}
    return _union(f"SELECT {_s(r)} AS rule, count(*) FILTER ({bad}) AS n_violations FROM contacts" for r, bad in rules.items())


def _conformed() -> str:
    """The contact table as text with the planted cells."""
    planted = {
        "age": """CASE id % 40 WHEN 0 THEN 'NaN' WHEN 1 THEN ' ' || CAST(CAST(age AS INT) AS VARCHAR) || ' ' WHEN 2 THEN '12d'
          WHEN 3 THEN 'x' WHEN 4 THEN '1e2' WHEN 5 THEN 'None' WHEN 6 THEN NULL ELSE CAST(age AS VARCHAR) END""",
        "job": """CASE id % 50 WHEN 0 THEN 'NA' WHEN 1 THEN '  ' || job || chr(9) WHEN 2 THEN '   ' WHEN 3 THEN 'null'
          WHEN 4 THEN NULL WHEN 5 THEN '' ELSE job END""",
        "subscribe": "CASE WHEN id % 30 < 10 THEN ' ' || upper(subscribe) || ' ' ELSE subscribe END",
    }
    cells = ", ".join(f"{planted.get(c, f'CAST({_q(c)} AS VARCHAR)')} AS {_q(c)}" for c in CONTACTS.columns)
    return f"raw AS (SELECT {cells} FROM contacts)"


_TOKENS = "('', 'NA', 'null', 'NaN', 'None')"


def _present(c: str) -> str:
    return f"CASE WHEN {_q(c)} IN {_TOKENS} THEN NULL ELSE {_q(c)} END"


def _clean(c: str) -> str:
    if c == "id":
        return "CAST(id AS BIGINT) AS id"
    if c == "subscribe":
        return f"lower(trim({_present(c)}, ' \t')) AS subscribe"
    if c in CONTACTS.numerics:
        return f"TRY_CAST({_present(c)} AS DOUBLE) AS {_q(c)}"
    return f"coalesce(trim({_present(c)}, ' \t'), 'unknown') AS {_q(c)}"


_POSITIVE = "subscribe = 'yes'"

# Stated here again, so that a wrong edge, label or list in the features shows up as a difference.
_FLAGS = ("is_ever_contacted", "is_high_frequency", "was_previous_success", "contact_cellular")
_CATEGORICAL = ["job", "marital", "education", "default", "housing", "loan", "contact", "month", "day_of_week", "poutcome", "age_bucket"]
_NUMERIC = [
    "age", "campaign", "pdays", "previous", "emp_var_rate", "cons_price_index", "cons_conf_index", "lending_rate3m", "nr_employed", *_FLAGS,
]


def _share(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'n/a' ELSE printf('%.2f%%', {x} * 100) END"


def _insight_report() -> str:
    """The findings with their texts; metrics as key=value in order of the keys."""
    columns = list(INSIGHT_COLUMNS)
    return f"""SELECT CAST(seq AS BIGINT) AS seq, kind, category, level, title, content, metrics FROM (
    SELECT 0 AS seq, 'overall' AS kind, 'business' AS category, 'info' AS level, 'Overall positive rate' AS title,
      n_pos || ' of ' || n || ' rows are positive, a rate of ' || {_share('rate')} || '.' AS content,
      'positives=' || n_pos || ', rate=' || {_share('rate')} || ', rows=' || n AS metrics
      FROM (SELECT count(*) AS n, count(*) FILTER ({_POSITIVE}) AS n_pos,
        round(CAST(count(*) FILTER ({_POSITIVE}) AS DOUBLE) / count(subscribe), 4) AS rate FROM contacts) WHERE n > 0
    UNION ALL SELECT 1, 'unknown', 'quality', CASE WHEN share > 0.1 THEN 'warn' ELSE 'info' END, 'Most unknown values: ' || "column",
      "column" || ' is unknown in ' || {_share('share')} || ' of the rows; keep it as a level of its own or compare an imputation.',
      'column=' || "column" || ', share=' || {_share('share')} FROM u WHERE share > 0
    UNION ALL SELECT 2, 'sentinel', 'quality', 'suggest', 'pdays uses 999 for people never called before',
      {_share('share')} || ' of the rows carry the marker; derive a yes/no feature and do not read it as days.', 'share=' || {_share('share')}
      FROM (SELECT CAST(count(*) FILTER (pdays = 999) AS DOUBLE) / count(*) AS share, count(*) AS n FROM contacts) WHERE n > 0
    UNION ALL SELECT list_position({columns}, c) + 2, 'segment', 'business', 'info', c || ' separates the rate',
      'highest ' || best || ', lowest ' || worst || ': ' || CASE WHEN wr > 0 THEN printf('%.1f times', br / wr) ELSE 'an unbounded factor' END || '.',
      'best=' || best || ', worst=' || worst
      FROM (SELECT *, bv || ' ' || {_share('br')} AS best, wv || ' ' || {_share('wr')} AS worst FROM (
        SELECT "column" AS c, first(value ORDER BY rate DESC, value) AS bv, max(rate) AS br, first(value ORDER BY rate, value) AS wv, min(rate) AS wr
        FROM g WHERE n >= 30 GROUP BY 1 HAVING count(*) >= 2))
    UNION ALL SELECT 7, 'leakage', 'modeling', 'warn', 'duration is known only after the call',
      'Leave it out of any model used before the call. Mean ' || p || ' for positives, ' || r || ' for the rest.', 'mean_positive=' || p || ', mean_rest=' || r
      FROM (SELECT coalesce(printf('%.0f', avg(duration) FILTER (subscribe = 'yes')), 'n/a') AS p,
        coalesce(printf('%.0f', avg(duration) FILTER (subscribe = 'no')), 'n/a') AS r, count(*) AS n FROM contacts) WHERE n > 0
    UNION ALL SELECT 8, 'correlation', 'feature', 'suggest', 'Numerics most correlated with the outcome',
      string_agg("column" || ' ' || printf('%+.3f', r), ', ' ORDER BY rank), string_agg("column" || '=' || printf('%+.3f', r), ', ' ORDER BY "column")
      FROM ({_top_correlations()}) HAVING count(*) > 0
    UNION ALL SELECT 9, 'over_contact', 'business', 'suggest', 'Rate after 6 or more calls: ' || direction,
      {_share('rate_high')} || ' with 6 or more calls, ' || {_share('rate_low')} || ' with fewer; set a limit on calls accordingly.',
      'direction=' || direction || ', rate_high=' || {_share('rate_high')} || ', rate_low=' || {_share('rate_low')} FROM ({_insight_rates()})
      WHERE EXISTS (SELECT 1 FROM contacts WHERE campaign >= 6))"""


def _unknown_share() -> str:
    parts = [
        f"SELECT {_s(c)} AS \"column\", {i} AS place, CAST(count(*) FILTER ({_q(c)} = 'unknown') AS DOUBLE) / count(*) AS share FROM contacts"
        for i, c in enumerate(CONTACTS.categoricals)
    ]
    return f"u AS (SELECT * FROM ({_union(parts)}) ORDER BY share DESC, place LIMIT 1)"


_FLAG_SQL = {
    "is_ever_contacted": "CASE WHEN pdays IS NOT DISTINCT FROM 999 THEN 0 ELSE 1 END",
    "is_high_frequency": "CASE WHEN campaign >= 6 THEN 1 ELSE 0 END",
    "was_previous_success": "CASE WHEN poutcome = 'success' THEN 1 ELSE 0 END",
    "contact_cellular": "CASE WHEN contact = 'cellular' THEN 1 ELSE 0 END",
}


def _age_bucket(age: str) -> str:
    ranges = ((0, 30, "<=30"), (30, 45, "31-45"), (45, 60, "46-60"), (60, 200, ">60"))
    return "CASE " + " ".join(f"WHEN {age} > {lo} AND {age} <= {hi} THEN {_s(name)}" for lo, hi, name in ranges) + " ELSE 'nan' END"


_FEATURES = "f AS (SELECT *, " + ", ".join(f"{sql} AS {c}" for c, sql in _FLAG_SQL.items()) + f", {_age_bucket('age')} AS age_bucket FROM contacts)"


def _mapping() -> str:
    categorical, numeric = _CATEGORICAL, _NUMERIC
    used = {*categorical, *numeric}
    derived = {
        "is_ever_contacted": "reached by an earlier campaign", "is_high_frequency": "called often in the running campaign",
        "was_previous_success": "earlier campaign succeeded", "contact_cellular": "called on a mobile line",
        "age_bucket": "age in four ranges",
    }
    one_hot = "one-hot, unseen ignored"
    rows = [("target", "subscribe", CONTACTS.title("subscribe"), "no=0, yes=1", False)]
    rows += [("dropped", "id", CONTACTS.title("id"), "identifier, no input", False)]
    rows += [("dropped", "duration", CONTACTS.title("duration"), "known after the event", False)]
    rows += [("numeric", c, CONTACTS.title(c), "standardised", c in used) for c in CONTACTS.numerics]
    rows += [("categorical", c, CONTACTS.title(c), one_hot, True) for c in CONTACTS.categoricals]
    rows += [("derived", c, t, one_hot if c == "age_bucket" else "0/1, standardised", True) for c, t in derived.items()]
    rows += [("model_categorical", c, CONTACTS.title(c), one_hot, True) for c in categorical]
    rows += [("model_numeric", c, CONTACTS.title(c), "standardised", True) for c in numeric]
    parts = []
    for i, (section, field, title, treatment, model) in enumerate(rows):
        gap = f"{_q(field)} IS NULL"
        if field in CONTACTS.categoricals:
            gap += f" OR {_q(field)} = 'unknown'"
        if field == "age_bucket":
            gap = "age_bucket = 'nan'"
        parts.append(
            f"""SELECT {_s(section)} AS section, CAST({i} AS BIGINT) AS position, {_s(field)} AS field, {_s(title)} AS title,
              {_s(treatment)} AS treatment, {str(model).lower()} AS in_model, count(*) FILTER ({gap}) AS n_missing FROM f"""
        )
    return _union(parts)


def _first_round(leaves: int = 4) -> str:
    """Best leaf first: each split takes the leaf, input and threshold of the greatest gain; children are numbered by the splits."""
    inputs = ["campaign", "previous", "CASE WHEN contact = 'cellular' THEN 1.0 ELSE 0.0 END"]
    x = ", ".join(f"CAST({e} AS DOUBLE) AS x{i}" for i, e in enumerate(inputs))
    worth = "power({0}.g, 2) / ({0}.h + 1)"
    parts = [
        f"b0 AS (SELECT {x}, 0.5 - CAST(subscribe = 'yes' AS INT) AS g, 0.25 AS h, 0 AS node FROM contacts WHERE subscribe IS NOT NULL)",
        "v AS (" + _union([f"SELECT DISTINCT {i} AS input, x{i} AS value FROM b0" for i in range(3)]) + ")",
        "e AS (SELECT * FROM (SELECT input, (value + lead(value) OVER (PARTITION BY input ORDER BY value)) / 2 AS threshold FROM v) WHERE threshold IS NOT NULL)",
    ]
    for k in range(leaves - 1):
        sums = _union(
            [f"SELECT b.node, e.input, e.threshold, CAST(sum(b.g) AS DOUBLE) AS g, CAST(sum(b.h) AS DOUBLE) AS h FROM b{k} b JOIN e ON e.input = {i} AND b.x{i} <= e.threshold GROUP BY ALL" for i in range(3)]
        )
        chosen = " ".join(f"WHEN input = {i} THEN x{i}" for i in range(3))
        parts += [
            f"t{k} AS (SELECT node, CAST(sum(g) AS DOUBLE) AS g, CAST(sum(h) AS DOUBLE) AS h FROM b{k} GROUP BY node)",
            f"l{k} AS ({sums})",
            f"""s{k} AS (SELECT l.node, l.input, l.threshold FROM l{k} l JOIN t{k} t USING (node)
              WHERE l.h > 0 AND t.h - l.h > 0
              ORDER BY {worth.format('l')} + power(t.g - l.g, 2) / (t.h - l.h + 1) - {worth.format('t')} DESC, l.node, l.input, l.threshold LIMIT 1)""",
            f"""b{k + 1} AS (SELECT x0, x1, x2, g, h, CASE WHEN b.node <> s.node THEN b.node
              WHEN CASE {chosen} END <= threshold THEN {2 * k + 1} ELSE {2 * k + 2} END AS node FROM b{k} b, s{k} s)""",
        ]
    inner = [f"SELECT node, input, {2 * k + 1} AS yes, {2 * k + 2} AS no, threshold, CAST(NULL AS DOUBLE) AS value FROM s{k}" for k in range(leaves - 1)]
    leaf = f"SELECT node, NULL, NULL, NULL, NULL, round(-sum(g) / (sum(h) + 1) * CAST(0.1 AS DOUBLE), 9) FROM b{leaves - 1} GROUP BY node"
    rows = _union([*inner, leaf])
    wide = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ("node", "input", "yes", "no"))
    return _contacts(f"SELECT {wide}, CAST(threshold AS DOUBLE) AS threshold, CAST(value AS DOUBLE) AS value FROM ({rows})", *parts)


def _newton_steps(steps: int = 3) -> str:
    """Newton steps of two scaled inputs and an intercept; the three equations are solved by determinants."""
    parts = [
        """p AS (SELECT k AS fold, CAST(c AS DOUBLE) AS c FROM (SELECT unnest(range(3)) AS k), (SELECT unnest([0.1, 1.0, 10.0]) AS c))""",
        """t AS (SELECT id % 3 AS own, campaign AS a, previous AS b, CAST(subscribe = 'yes' AS INT) AS y FROM contacts WHERE subscribe IS NOT NULL)""",
        """st AS (SELECT k AS fold, avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb, count(*) AS n, sum(y) AS n1
          FROM t JOIN (SELECT unnest(range(3)) AS k) ON own <> k GROUP BY k)""",
        """z AS (SELECT fold, (a - ma) / sa AS a, (b - mb) / sb AS b, y, CAST(n AS DOUBLE) / (2 * CASE WHEN y = 1 THEN n1 ELSE n - n1 END) AS w
          FROM t JOIN st ON own <> fold)""",
        "c0 AS (SELECT fold, c, CAST(0 AS DOUBLE) AS b1, CAST(0 AS DOUBLE) AS b2, CAST(0 AS DOUBLE) AS b0 FROM p)",
    ]
    for k in range(steps):
        parts += [
            f"m{k} AS (SELECT q.*, a, b, w, y, 1 / (1 + exp(-(b0 + b1 * a + b2 * b))) AS p FROM c{k} q JOIN z USING (fold))",
            f"""h{k} AS (SELECT fold, c, b1, b2, b0, sum(w * p * (1 - p) * a * a) + 1 / c AS h11, sum(w * p * (1 - p) * a * b) AS h12,
              sum(w * p * (1 - p) * a) AS h13, sum(w * p * (1 - p) * b * b) + 1 / c AS h22, sum(w * p * (1 - p) * b) AS h23, sum(w * p * (1 - p)) AS h33,
              sum(w * (p - y) * a) + b1 / c AS g1, sum(w * (p - y) * b) + b2 / c AS g2, sum(w * (p - y)) AS g3 FROM m{k} GROUP BY fold, c, b1, b2, b0)""",
            f"""d{k} AS (SELECT *, h11 * (h22 * h33 - h23 * h23) - h12 * (h12 * h33 - h23 * h13) + h13 * (h12 * h23 - h22 * h13) AS det FROM h{k})""",
            f"""c{k + 1} AS (SELECT fold, c,
              b1 - (g1 * (h22 * h33 - h23 * h23) - h12 * (g2 * h33 - h23 * g3) + h13 * (g2 * h23 - h22 * g3)) / det AS b1,
              b2 - (h11 * (g2 * h33 - h23 * g3) - g1 * (h12 * h33 - h23 * h13) + h13 * (h12 * g3 - g2 * h13)) / det AS b2,
              b0 - (h11 * (h22 * g3 - g2 * h23) - h12 * (h12 * g3 - g2 * h13) + g1 * (h12 * h23 - h22 * h13)) / det AS b0 FROM d{k})""",
        ]
    return _contacts(
        f"SELECT fold, c, round(b1, 8) + 0.0 AS campaign, round(b2, 8) + 0.0 AS previous, round(b0, 8) + 0.0 AS intercept FROM c{steps}", *parts
    )


_BOOTSTRAP = """
trees AS (SELECT unnest(range(25)) AS tree),
t AS (SELECT CAST(('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8)) AS BIGINT) AS r, CAST(subscribe = 'yes' AS BIGINT) AS label FROM contacts WHERE subscribe IS NOT NULL),
u AS (SELECT tree, label, (r % 2147483647 + (tree + 1) * 1000003 + 42 * 7919) % 2147483647 AS u FROM t, trees),
v AS (SELECT tree, label, u, (u * u + 48271 * u) % 2147483647 AS v FROM u),
lots AS (SELECT tree, label, (v * v + 69621 * u) % 2147483647 % 1000000 AS lot FROM v),
sizes AS (
  SELECT tree, label, sum(CAST(lot >= 367879 AS INT) + CAST(lot >= 735759 AS INT) + CAST(lot >= 919699 AS INT) + CAST(lot >= 981012 AS INT)
    + CAST(lot >= 996340 AS INT) + CAST(lot >= 999406 AS INT) + CAST(lot >= 999917 AS INT) + CAST(lot >= 999990 AS INT) + CAST(lot >= 999999 AS INT)) AS n
  FROM lots GROUP BY ALL)"""


def _evidence(names: dict[str, str]) -> str:
    """Weights of the levels of columns given as SQL."""
    values = _union([f"SELECT {_s(name)} AS coding, {sql} AS value, subscribe = 'yes' AS won FROM contacts WHERE subscribe IS NOT NULL" for name, sql in names.items()])
    return f"""n AS (SELECT coding, value, count(*) FILTER (won) AS n_pos, count(*) FILTER (NOT won) AS n_neg FROM ({values}) GROUP BY ALL),
    sh AS (SELECT *, (n_pos + 0.5::DOUBLE) / (sum(n_pos) OVER w + 0.5::DOUBLE * count(*) OVER w) AS sp,
      (n_neg + 0.5::DOUBLE) / (sum(n_neg) OVER w + 0.5::DOUBLE * count(*) OVER w) AS sn FROM n WINDOW w AS (PARTITION BY coding))"""


_HELD_OUT = """
l AS (SELECT id % 3 AS own, 'default' AS "column", "default" AS value, subscribe = 'yes' AS won FROM contacts WHERE subscribe IS NOT NULL
  UNION ALL SELECT id % 3, 'poutcome', poutcome, subscribe = 'yes' FROM contacts WHERE subscribe IS NOT NULL),
n AS (SELECT "column", value, k AS fold, count(*) FILTER (won AND own <> k) AS n_pos, count(*) FILTER (NOT won AND own <> k) AS n_neg
  FROM l, (SELECT unnest(range(3)) AS k) GROUP BY ALL),
sh AS (SELECT *, (n_pos + 0.5::DOUBLE) / (sum(n_pos) OVER w + 0.5::DOUBLE * count(*) OVER w) AS sp,
  (n_neg + 0.5::DOUBLE) / (sum(n_neg) OVER w + 0.5::DOUBLE * count(*) OVER w) AS sn FROM n WINDOW w AS (PARTITION BY "column", fold))"""


def _feature_columns() -> str:
    """The model's columns in order; numbers that the table holds as doubles, flags as 32-bit integers."""
    strings = [*CONTACTS.categoricals, "age_bucket"]
    numbers = [c for c in CONTACTS.numerics if c != "duration"]
    names = [*[(c, "string") for c in strings], *[(c, "double") for c in numbers], *[(c, "int") for c in _FLAGS]]
    return _union(
        [
            f"SELECT CAST({i} AS BIGINT) AS position, {_s(c)} AS feature, {_s(t)} AS type, count(DISTINCT {_q(c)}) AS \"distinct\", count(*) - count({_q(c)}) AS n_missing FROM f"
            for i, (c, t) in enumerate(names)
        ]
    )


_SPLIT = """t AS (SELECT *, count(*) OVER () AS total, count(*) OVER (PARTITION BY subscribe) AS own FROM contacts WHERE subscribe IS NOT NULL),
sizes AS (SELECT DISTINCT subscribe AS label, own, ceil(round(total * CAST(0.2 AS DOUBLE), 9)) AS wanted,
  own * ceil(round(total * CAST(0.2 AS DOUBLE), 9)) / total AS exact FROM t),
spare AS (SELECT *, row_number() OVER (ORDER BY exact - floor(exact) DESC, label) AS place,
  wanted - sum(floor(exact)) OVER () AS extra FROM sizes),
cut AS (SELECT label, floor(exact) + CASE WHEN place <= extra THEN 1 ELSE 0 END AS n_test FROM spare)"""


def _metrics(threshold: float) -> str:
    return f"""m AS (SELECT count(*) FILTER (score < {threshold} AND label <> 1) AS tn, count(*) FILTER (score >= {threshold} AND label <> 1) AS fp,
      count(*) FILTER (score < {threshold} AND label = 1) AS fn, count(*) FILTER (score >= {threshold} AND label = 1) AS tp FROM s)"""


_RATES = """CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS precision, CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall,
  CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0) AS f1, CAST(tp + tn AS DOUBLE) / nullif(tp + tn + fp + fn, 0) AS accuracy,
  tn, fp, fn, tp"""


def _benefit(thresholds) -> str:
    rows = ", ".join(f"({i}, CAST({t!r} AS DOUBLE))" for i, t in enumerate(thresholds))
    return f"""b AS (SELECT CAST(position AS BIGINT) AS position, threshold, count(*) FILTER (score >= threshold) AS called,
        count(*) FILTER (score >= threshold AND label = 1) AS tp, count(*) AS n, count(*) FILTER (label = 1) AS p
      FROM s, (VALUES {rows}) v(position, threshold) GROUP BY 1, 2),
    o AS (SELECT position, threshold, called, coalesce(CAST(called AS DOUBLE) / nullif(n, 0), 0) AS call_rate, tp,
      coalesce(CAST(tp AS DOUBLE) / nullif(called, 0), 0) AS precision, coalesce(CAST(tp AS DOUBLE) / nullif(p, 0), 0) AS recall,
      called * CAST(10 AS DOUBLE) AS cost, tp * CAST(100 AS DOUBLE) AS revenue, CAST(tp * 100 - called * 10 AS DOUBLE) AS net,
      CAST(p * 100 - n * 10 AS DOUBLE) AS baseline_net, CAST(tp * 100 - called * 10 - (p * 100 - n * 10) AS DOUBLE) AS lift_vs_all FROM b)"""


_AUC = "1 - sum(CAST(tp AS DOUBLE) * (cum_fp - fp / CAST(2 AS DOUBLE))) / (CAST(max(p) AS DOUBLE) * max(n))"
_AP = "sum(CAST(tp AS DOUBLE) * cum_tp / (cum_tp + cum_fp)) / max(p)"
_F1 = "CAST(2 * cum_tp AS DOUBLE) / (cum_tp + cum_fp + p)"
_BEST_F1 = f"SELECT score AS threshold, {_F1} AS f1 FROM c ORDER BY round({_F1}, 12) DESC, score LIMIT 1"
_CURVE = """SELECT score AS threshold, CAST(cum_tp AS DOUBLE) / (cum_tp + cum_fp) AS precision, CAST(cum_tp AS DOUBLE) / p AS recall FROM c
UNION ALL SELECT CAST(NULL AS DOUBLE), CAST(1 AS DOUBLE), CAST(0 AS DOUBLE)"""
_GAIN = """SELECT part, n, n_pos, CAST(n_pos AS DOUBLE) / n AS rate, cum_n, cum_pos, CAST(cum_pos AS DOUBLE) / p AS gain,
  (CAST(cum_pos AS DOUBLE) / p) / (CAST(cum_n AS DOUBLE) / total) AS lift
FROM (SELECT part, n, n_pos, CAST(sum(n) OVER (ORDER BY part) AS BIGINT) AS cum_n, CAST(sum(n_pos) OVER (ORDER BY part) AS BIGINT) AS cum_pos, p, total
  FROM (SELECT CAST(floor(CAST((cum_tp + cum_fp - tp - fp) * 10 AS DOUBLE) / (p + n)) AS BIGINT) + 1 AS part, CAST(sum(tp + fp) AS BIGINT) AS n,
    CAST(sum(tp) AS BIGINT) AS n_pos, max(p) AS p, max(p + n) AS total FROM c GROUP BY 1))"""


def _insight_rates() -> str:
    return """SELECT count(*) FILTER (campaign >= 6) AS n_high, avg(CASE WHEN campaign >= 6 THEN y END) AS rate_high,
      avg(CASE WHEN campaign >= 6 THEN NULL ELSE y END) AS rate_low,
      CASE WHEN avg(CASE WHEN campaign >= 6 THEN y END) < avg(CASE WHEN campaign >= 6 THEN NULL ELSE y END) THEN 'lower'
        WHEN avg(CASE WHEN campaign >= 6 THEN y END) > avg(CASE WHEN campaign >= 6 THEN NULL ELSE y END) THEN 'higher' ELSE 'equal' END AS direction
    FROM (SELECT campaign, CASE subscribe WHEN 'yes' THEN CAST(1 AS DOUBLE) WHEN 'no' THEN CAST(0 AS DOUBLE) END AS y FROM contacts)
    HAVING count(*) FILTER (campaign >= 6) > 0"""


def _top_correlations() -> str:
    parts = [
        f"SELECT {_s(c)} AS \"column\", {i} AS place, corr({_q(c)}, CASE subscribe WHEN 'yes' THEN CAST(1 AS DOUBLE) WHEN 'no' THEN CAST(0 AS DOUBLE) END) AS r FROM contacts"
        for i, c in enumerate(CONTACTS.numerics)
    ]
    return f"""SELECT row_number() OVER (ORDER BY round(abs(r), 9) DESC, place) AS rank, "column", round(r, 6) AS r
      FROM ({_union(parts)}) QUALIFY rank <= 3"""


def _lift() -> str:
    return _contacts(
        """SELECT b."column", b.value AS best_value, b.rate AS best_rate, w.value AS worst_value, w.rate AS worst_rate,
          b.rate / nullif(w.rate, 0) AS lift, w.rate = 0 AS worst_rate_is_zero
        FROM r b JOIN r w ON b."column" = w."column" WHERE b.top = 1 AND w.low = 1 AND b.groups >= 2""",
        _segments(INSIGHT_COLUMNS, "contacts", "subscribe", "yes"),
        """r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY rate DESC, value) AS top,
          row_number() OVER (PARTITION BY "column" ORDER BY rate, value) AS low, count(*) OVER (PARTITION BY "column") AS groups
          FROM g WHERE n >= 30)""",
    )


def _described(name: str, where: str, labelled: bool) -> str:
    if labelled:
        counts = f"""count(*) FILTER ({_POSITIVE}) AS n_pos, count(*) FILTER (subscribe = 'no') AS n_neg,
          round(CAST(count(*) FILTER ({_POSITIVE}) AS DOUBLE) / nullif(count(*) FILTER (subscribe IN ('yes', 'no')), 0), 4) AS positive_rate"""
    else:
        counts = "CAST(NULL AS BIGINT) AS n_pos, CAST(NULL AS BIGINT) AS n_neg, CAST(NULL AS DOUBLE) AS positive_rate"
    return f"""SELECT {_s(name)} AS dataset, count(*) AS n_rows, CAST({22 if labelled else 21} AS BIGINT) AS n_columns,
      {str(labelled).lower()} AS has_target, {counts} FROM contacts WHERE {where}"""


def _kpis(keep: str) -> str:
    return f"""SELECT count(*) AS n_total, count(*) FILTER ({keep}) AS n_kept,
      CAST(count(*) FILTER ({keep}) AS DOUBLE) / count(*) AS keep_ratio, count(*) FILTER (({keep}) AND {_POSITIVE}) AS n_pos,
      CAST(count(*) FILTER (({keep}) AND {_POSITIVE}) AS DOUBLE) / nullif(count(*) FILTER ({keep}), 0) AS positive_rate FROM contacts"""


def _slots() -> str:
    ranks = [f"dense_rank() OVER (ORDER BY {_q(c)}) - 1 AS {c}_slot" for c in _CATEGORICAL]
    return "SELECT id, " + ", ".join(ranks) + " FROM f"


def _scaled() -> str:
    cells = []
    for c in _NUMERIC:
        spread = f"(CASE WHEN min({c}) OVER () < max({c}) OVER () THEN stddev_pop({c}) OVER () ELSE 1 END)"
        cells.append(f"round(coalesce(({c} - avg({c}) OVER ()) / {spread}, 0), 6) + CAST(0 AS DOUBLE) AS {c}_z")
    return "SELECT id, " + ", ".join(cells) + " FROM f"


_DOCS = "d AS (SELECT lang, source, n_chars, CAST(toxic AS VARCHAR) AS toxic FROM documents JOIN labels USING (doc_id))"
_LINES = "dl AS (SELECT *, lower(strftime(l_shipdate, '%b')) AS ship_month, lower(strftime(l_shipdate, '%a')) AS ship_weekday FROM lineitem)"
_COMPLETE = " AND ".join(f"{_q(c)} IS NOT NULL" for c in (*CONTACTS.categoricals, *CONTACTS.numerics, "subscribe"))


def oracle_queries() -> dict[str, str]:
    categorical, numeric = _CATEGORICAL, _NUMERIC
    view = ", ".join(_q(c) for c in ("id", *categorical, *numeric, "subscribe"))
    return {
        "campaign_fixture": _contacts("SELECT * FROM contacts"),
        "contacts_kept": _contacts("SELECT * FROM contacts"),
        "filtered_rate": _with(
            _CONTACTS, _DECLARED, f"kept AS (SELECT * FROM contacts WHERE {_KEEP})", _segments(["poutcome"], "kept", "subscribe", "yes")
        ) + _RATE_ORDER,
        "conformed_contacts": _contacts("SELECT " + ", ".join(map(_clean, CONTACTS.columns)) + " FROM raw", _conformed()),
        "coercion_failures": _contacts(
            _union(
                f"SELECT {_s(c)} AS \"column\", count(*) FILTER (({_present(c)}) IS NOT NULL AND TRY_CAST({_present(c)} AS DOUBLE) IS NULL) AS n_failed FROM raw"
                for c in CONTACTS.numerics
            )
            + " UNION ALL SELECT 'id', count(*) FILTER (id IS NOT NULL AND TRY_CAST(id AS BIGINT) IS NULL) FROM raw",
            _conformed(),
        ),
        "audited_export": _contacts(
            _union(
                [
                    "SELECT 'rows' AS measure, CAST(NULL AS VARCHAR) AS \"column\", count(*) AS n FROM raw",
                    "SELECT 'malformed', NULL, CAST(0 AS BIGINT)",
                    "SELECT 'failed', 'id', count(*) FILTER (id IS NOT NULL AND TRY_CAST(id AS BIGINT) IS NULL) FROM raw",
                    *[
                        f"SELECT 'failed', {_s(c)}, count(*) FILTER (({_present(c)}) IS NOT NULL AND TRY_CAST({_present(c)} AS DOUBLE) IS NULL) FROM raw"
                        for c in CONTACTS.numerics
                    ],
                ]
            ),
            _conformed(),
        ),
        "audited_rejects": _contacts(
            """SELECT CASE WHEN id % 37 = 0 THEN concat_ws(',', id, CAST(age AS VARCHAR), job, coalesce(subscribe, '')) || ',more' ELSE concat_ws(',', id, job) END AS line,
              CASE WHEN id % 37 = 0 THEN '' ELSE 'age' END AS failed
            FROM contacts WHERE id % 37 = 0 OR id % 41 = 0"""
        ),
        "malformed_rows": _contacts("SELECT count(*) AS n_rows, count(*) FILTER (id % 37 = 0 OR id % 41 = 0) AS n_malformed FROM contacts"),
        "dataset_description": _contacts(
            _described("train", "subscribe IS NOT NULL", True) + " UNION ALL BY NAME " + _described("test", "subscribe IS NULL", False)
        ),
        "dictionary_table": _contacts(_dictionary()),
        "filtered_preview": _contacts(f"SELECT * FROM contacts WHERE {_KEEP} ORDER BY id LIMIT 500"),
        "filter_kpis": _contacts(_kpis(_KEEP)),
        "filter_default_criteria": _contacts(_kpis(_COMPLETE)),
        "category_domain": _domain((*CONTACTS.categoricals, "subscribe")),
        "numeric_bounds": _contacts(
            _union(
                f"SELECT {_s(c)} AS \"column\", CAST(min({_q(c)}) AS DOUBLE) AS lo, CAST(max({_q(c)}) AS DOUBLE) AS hi FROM contacts HAVING min({_q(c)}) IS NOT NULL"
                for c in ("id", *CONTACTS.numerics)
            )
        ),
        "target_distribution": _contacts(
            """SELECT v.label, count(*) FILTER (subscribe = v.label) AS n,
              CAST(count(*) FILTER (subscribe = 'yes') AS DOUBLE) / count(*) FILTER (subscribe IN ('yes', 'no')) AS rate
            FROM contacts, (VALUES ('no'), ('yes')) v(label) GROUP BY v.label"""
        ),
        "categorical_distribution": _domain(("month", "day_of_week", "job")),
        "categorical_by_target": _contacts(
            f"SELECT \"column\", value, label, count(*) AS n FROM ({_pairs(('month', 'day_of_week', 'job'), 'contacts', 'subscribe AS label, ')}) WHERE label IN ('yes', 'no') GROUP BY 1, 2, 3"
        ),
        "numeric_histogram": _histogram("contacts", "age", _CONTACTS + ","),
        "numeric_histogram_by_target": _histogram("contacts", "duration", _CONTACTS + ",", "subscribe"),
        "price_histogram": _histogram("orders", "o_totalprice"),
        "rate_by_category": _with(
            _CONTACTS, _DECLARED, _segments(("poutcome", "education", "day_of_week"), "contacts", "subscribe", "yes")
        ) + _RATE_ORDER,
        "rate_by_value": """SELECT row_number() OVER (ORDER BY l_linenumber) - 1 AS bin, CAST(l_linenumber AS DOUBLE) AS lo, count(l_returnflag) AS n,
          count(*) FILTER (l_returnflag = 'R') AS n_pos, CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) / count(l_returnflag) AS rate
          FROM lineitem GROUP BY l_linenumber""",
        "rate_by_quantile_bin": _quantile_bins("contacts", "age", 8, "subscribe", "yes", _CONTACTS + ","),
        "rate_by_quantile_bin_price": _quantile_bins("orders", "o_totalprice", 8, "o_orderstatus", "F"),
        "rate_by_quantile_bin_tied": _quantile_bins("contacts", "campaign", 10, "subscribe", "yes", _CONTACTS + ","),
        "rate_by_quantile_bin_lines": _quantile_bins("lineitem", "l_extendedprice", 10, "l_returnflag", "R"),
        "correlation_matrix": _contacts(_correlations()),
        "missing_overview": _contacts(f"SELECT *, row_number() OVER (ORDER BY share DESC, dictionary_position) AS rank FROM ({_missing()})"),
        "segment_rates": _contacts("SELECT * FROM g WHERE n >= 30", _segments(CONTACTS.categoricals, "contacts", "subscribe", "yes")),
        "segment_rates_lines": _with(_LINES, _segments(("l_linestatus", "ship_month", "ship_weekday"), "dl", "l_returnflag", "R"))
        + "SELECT * FROM g WHERE n >= 30",
        "rate_by_category_documents": _with(_DOCS, _DECLARED, _segments(("lang", "source"), "d", "toxic", "1"))
        + """SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY rate DESC NULLS LAST, value) - 1 AS position FROM g""",
        "rate_by_quantile_bin_documents": _quantile_bins("d", "n_chars", 4, "toxic", "1", _DOCS + ","),
        "segment_lift": _lift(),
        "insight_overall": _contacts(
            f"SELECT count(*) AS n_rows, count(*) FILTER ({_POSITIVE}) AS n_pos, round(CAST(count(*) FILTER ({_POSITIVE}) AS DOUBLE) / count(subscribe), 4) AS rate FROM contacts"
        ),
        "insight_unknown": _contacts(
            "SELECT \"column\", share, CASE WHEN share > 0.1 THEN 'warn' ELSE 'info' END AS level FROM u WHERE share > 0", _unknown_share()
        ),
        "insight_sentinel": _contacts(
            "SELECT count(*) FILTER (pdays = 999) AS n_never, CAST(count(*) FILTER (pdays = 999) AS DOUBLE) / count(*) AS share FROM contacts"
        ),
        "insight_leakage": _contacts(
            """SELECT round(avg(duration) FILTER (subscribe = 'yes'), 6) AS mean_positive,
              round(avg(duration) FILTER (subscribe = 'no'), 6) AS mean_rest FROM contacts"""
        ),
        "insight_correlation": _contacts(_top_correlations()),
        "insight_contact": _contacts(_insight_rates()),
        "insight_report": _contacts(_insight_report(), _unknown_share(), _segments(INSIGHT_COLUMNS, "contacts", "subscribe", "yes")),
        "insight_report_written": _contacts(
            f"""SELECT 'train' AS dataset, n_rows, positive_rate, row_number() OVER (ORDER BY seq) - 1 AS position, title, category, level, content
            FROM ({_insight_report()}), (SELECT count(*) AS n_rows,
              round(CAST(count(*) FILTER ({_POSITIVE}) AS DOUBLE) / count(subscribe), 4) AS positive_rate FROM contacts)""",
            _unknown_share(),
            _segments(INSIGHT_COLUMNS, "contacts", "subscribe", "yes"),
        ),
        "derived_features": _contacts("SELECT id, " + ", ".join(_FLAGS) + " FROM f", _FEATURES),
        "age_buckets": _contacts(
            f"SELECT {_age_bucket('a')} AS age_bucket, count(*) AS n, min(a) AS lo, max(a) AS hi FROM a GROUP BY 1",
            "a AS (SELECT CASE WHEN id % 50 = 0 THEN NULL ELSE (age - 18) * 4 END AS a FROM contacts)",
        ),
        "model_view": _contacts(f"SELECT {view} FROM f", _FEATURES),
        "leakage_view": _contacts("SELECT id, duration, subscribe FROM contacts"),
        "field_mapping": _contacts(_mapping(), _FEATURES),
        "field_mapping_written": _contacts(_mapping(), _FEATURES),
        "constraint_audit": _contacts(_audit()),
        "duplicate_keys": "SELECT l_orderkey AS key, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1",
        "duplicate_contacts": _contacts("SELECT id AS key, CAST(2 AS BIGINT) AS n FROM contacts WHERE id % 29 = 0"),
        "stratified_split": _contacts(
            """SELECT id, subscribe, CASE WHEN place <= n_test THEN 'test' ELSE 'train' END AS part
            FROM (SELECT id, subscribe, row_number() OVER (PARTITION BY subscribe ORDER BY md5(concat(id, ':42')), id) AS place FROM t)
            JOIN cut ON subscribe = label""",
            _SPLIT,
        ),
        "split_sizes_of_text_ids": _contacts("SELECT label AS subscribe, CAST(n_test AS BIGINT) AS n FROM cut", _SPLIT),
        "stratified_folds": _contacts(
            """SELECT id, subscribe, CAST(place > ceil(CAST(own AS DOUBLE) / 3) AS BIGINT) + CAST(place > ceil(CAST(own * 2 AS DOUBLE) / 3) AS BIGINT) AS fold
            FROM (SELECT id, subscribe, count(*) OVER (PARTITION BY subscribe) AS own,
              row_number() OVER (PARTITION BY subscribe ORDER BY md5(concat(id, ':43')), id) AS place FROM contacts WHERE subscribe IS NOT NULL)"""
        ),
        "class_weights": _contacts(
            """SELECT subscribe AS label, own AS n, CAST(total AS DOUBLE) / (own * 2) AS balanced_weight,
              CASE WHEN subscribe = 'yes' THEN CAST(total - own AS DOUBLE) / greatest(own, 1) ELSE CAST(1 AS DOUBLE) END AS positive_weight
            FROM (SELECT subscribe, count(*) AS own, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM contacts WHERE subscribe IS NOT NULL GROUP BY 1)"""
        ),
        "one_hot_matrix": _contacts(_slots(), _FEATURES),
        "scaled_features": _contacts(_scaled(), _FEATURES),
        "quantiles_of_all_numbers": _contacts(_all_quantiles()),
        "rates_by_quantile_bin_all": _all_quantile_bins(),
        "rates_of_merged_states": _contacts(
            _union(
                [
                    f"""SELECT {_s(c)} AS "column", {_q(c)} AS value, count(subscribe) AS n, count(*) FILTER ({_POSITIVE}) AS n_pos,
                      CAST(count(*) FILTER ({_POSITIVE}) AS DOUBLE) / nullif(count(subscribe), 0) AS rate FROM contacts GROUP BY {_q(c)}"""
                    for c in CONTACTS.categoricals
                ]
            )
        ),
        "statistics_of_merged_states": _contacts(
            _union(
                [
                    f"""SELECT {_s(c)} AS "column", count({c}) AS n, count(*) - count({c}) AS n_missing, round(avg({c}), 6) AS mean,
                      round(stddev_pop({c}), 6) AS deviation, min({c}) AS lo, max({c}) AS hi FROM contacts"""
                    for c in CONTACTS.numerics
                ]
            )
        ),
        "correlations_of_merged_states": _contacts(
            _union(
                [
                    f"""SELECT {_s(a)} AS "column", {_s(b)} AS other, count(*) AS n, round(corr({a}, {b}), 6) + 0.0 AS r FROM contacts WHERE {a} IS NOT NULL AND {b} IS NOT NULL"""
                    for i, a in enumerate(CONTACTS.numerics)
                    for b in CONTACTS.numerics[i + 1 :]
                ]
            )
        ),
        "feature_columns": _contacts(_feature_columns(), _FEATURES),
        "default_coding": _contacts(
            """SELECT coding, value, n_pos, n_neg, round(n_pos / (n_pos + n_neg)::DOUBLE, 9) AS rate, round(ln(sp / sn), 9) AS woe,
              round(sum((sp - sn) * ln(sp / sn)) OVER (PARTITION BY coding), 9) AS iv FROM sh""",
            _evidence({
                "own_level": _q("default"), "filled": "CASE WHEN \"default\" = 'unknown' THEN 'no' ELSE \"default\" END",
                "gap": "CASE WHEN \"default\" = 'unknown' THEN 'unknown' ELSE 'known' END",
            }),
        ),
        "default_held_out": _contacts('SELECT "column", value, fold, n_pos, n_neg, round(ln(sp / sn), 9) AS woe FROM sh', _HELD_OUT),
        "boosted_first_round": _first_round(),
        "newton_steps": _newton_steps(),
        "bootstrap_weights": _contacts(
            "SELECT tree, label, CAST(n AS BIGINT) AS n, CAST(sum(n) OVER (PARTITION BY tree) AS DOUBLE) / (2 * n) AS weight FROM sizes", _BOOTSTRAP
        ),
        "portable_scores": _contacts(
            """SELECT id, round(1 / (1 + exp(-(0.2 - 0.3 * z + CASE WHEN poutcome = 'success' THEN 0.75 WHEN z <= -0.25 THEN -0.5 ELSE -1.25 END
              + CASE WHEN age <= 45.5 THEN 0.125 ELSE -0.0625 END))), 9) AS score
            FROM (SELECT *, (coalesce(lending_rate3m, 2.5) - 2.5) / 1.5 AS z FROM contacts)"""
        ),
        "score_histogram": _ranked(_TIED, "SELECT score, tp, fp, cum_tp, cum_fp FROM c"),
        "score_histogram_fine": _ranked(_FINE, "SELECT score, tp, fp, cum_tp, cum_fp FROM c"),
        "roc_auc": _ranked(_TIED, f"SELECT round({_AUC}, 9) AS roc_auc FROM c"),
        "average_precision": _ranked(_TIED, f"SELECT round({_AP}, 9) AS average_precision FROM c"),
        "ranked_summary_fine": _ranked(
            _FINE, f"SELECT max(p) AS n_pos, max(n) AS n_neg, round({_AUC}, 9) AS roc_auc, round({_AP}, 9) AS average_precision FROM c"
        ),
        "pr_curve": _ranked(_TIED, _CURVE),
        "pr_curve_fine": _ranked(_FINE, _CURVE),
        "best_f1": _ranked(_TIED, _BEST_F1),
        "best_f1_fine": _ranked(_FINE, _BEST_F1),
        "confusion": _with(_TIED, _metrics(0.4)) + "SELECT * FROM m",
        "threshold_metrics": _with(_TIED, _metrics(0.4)) + f"SELECT CAST(0.4 AS DOUBLE) AS threshold, {_RATES} FROM m",
        "evaluation_record": _ranked(
            _FINE,
            f"SELECT 'price' AS model, threshold, {_RATES}, roc_auc, average_precision FROM k, x",
            f"best AS ({_BEST_F1})",
            "k AS (SELECT score AS threshold, n - cum_fp AS tn, cum_fp AS fp, p - cum_tp AS fn, cum_tp AS tp FROM c WHERE score = (SELECT threshold FROM best))",
            f"x AS (SELECT round({_AUC}, 9) AS roc_auc, round({_AP}, 9) AS average_precision FROM c)",
        ),
        "keyed_evaluation": _with(
            """s AS (SELECT 'tied' AS model, CAST(l_returnflag = 'R' AS INT) AS label, round(l_discount * 10, 6) AS score FROM lineitem
              UNION ALL SELECT m, CAST(l_returnflag = 'R' AS INT), l_extendedprice / ((SELECT max(l_extendedprice) FROM lineitem) + 1)
              FROM lineitem, LATERAL (SELECT unnest(['fine', 'fine:' || l_linestatus]) AS m))""",
            """h AS (SELECT model, score, count(*) FILTER (label = 1) AS tp, count(*) FILTER (label <> 1) AS fp FROM s GROUP BY ALL)""",
            """c AS (SELECT *, CAST(sum(tp) OVER w AS BIGINT) AS cum_tp, CAST(sum(fp) OVER w AS BIGINT) AS cum_fp,
              CAST(sum(tp) OVER (PARTITION BY model) AS BIGINT) AS p, CAST(sum(fp) OVER (PARTITION BY model) AS BIGINT) AS n
              FROM h WINDOW w AS (PARTITION BY model ORDER BY score DESC))""",
            f"x AS (SELECT model, round({_AUC}, 9) AS roc_auc, round({_AP}, 9) AS average_precision FROM c GROUP BY model)",
            f"""k AS (SELECT model, score AS threshold, n - cum_fp AS tn, cum_fp AS fp, p - cum_tp AS fn, cum_tp AS tp FROM c
              QUALIFY row_number() OVER (PARTITION BY model ORDER BY round({_F1}, 12) DESC, score) = 1)""",
        )
        + f"SELECT k.model, threshold, {_RATES}, roc_auc, average_precision FROM k JOIN x USING (model)",
        "gain_table": _ranked(_TIED, _GAIN),
        "gain_table_fine": _ranked(_FINE, _GAIN),
        "benefit_at_threshold": _with(_TIED, _benefit([0.4])) + "SELECT * FROM o",
        "benefit_scan": _with(_FINE, _benefit(SCAN_THRESHOLDS)) + "SELECT * FROM o",
        "best_benefit": _with(_TIED, _benefit(SCAN_THRESHOLDS)) + "SELECT * FROM o ORDER BY net DESC, position LIMIT 1",
        "stream_filtered_events": "SELECT * FROM events WHERE event_type IN ('click', 'purchase') AND value BETWEEN 10 AND 60",
    }
