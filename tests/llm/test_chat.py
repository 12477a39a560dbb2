"""Maximal conversations against a comparison of all pairs, chunks and segments, and awkward rows."""

import random

import pytest

from leadlens.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, c string, n long, x long, segment string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2, "clash") for r in rows], SCHEMA)


def brute_force(rows, segment=chat.SEGMENT):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, set()).add((turn, role, text))
    key = lambda x: (x[0] is not None, x[0] or 0, x[1] or "unknown", x[2] or "")
    ordered = {c: sorted(t, key=key) for c, t in convs.items()}
    ends = {c: {i + 1 for i, t in enumerate(o) if i + 1 == len(o) or o[i + 1][0] != t[0]} for c, o in ordered.items()}
    out = []
    for c, turns in ordered.items():
        longer = any(len(o) > len(turns) and o[: len(turns)] == turns and len(turns) in ends[d] for d, o in ordered.items() if d != c)
        copy = any(o == turns and d is not None and (c is None or d < c) for d, o in ordered.items() if d != c)
        if not longer and not copy:
            parts = {}
            for turn, role, text in turns:
                parts.setdefault(None if turn is None else turn // segment, []).append(f"<|{role or 'unknown'}|>\n{text or ''}\n<|end|>\n")
            out += [(c, s, len(p), "".join(p)) for s, p in parts.items()]
    return sorted(out, key=str)


def got(df):
    return sorted(((r["conv_id"], r["segment"], r["n_turns"], r["text"]) for r in df.collect()), key=str)


def logs(seed, n):
    """Conversations, and snapshots and copies of them under other ids."""
    rng = random.Random(seed)
    out, conv = [], 0
    for _ in range(n):
        turns = [(t, "user" if t % 2 == 0 else "assistant", f"m{rng.randrange(3)}") for t in range(rng.randint(1, 9))]
        for _ in range(rng.randint(1, 4)):
            conv += 1
            out += [(conv, *t) for t in turns[: rng.randint(1, len(turns))]]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("chunk", [2, 1024])
def test_maximal_conversations(spark, monkeypatch, chunk):
    monkeypatch.setattr(chat, "CHUNK", chunk)
    rows = logs(chunk, 60)
    assert got(chat.chat_format(frame(spark, rows))) == brute_force(rows)


def test_awkward_rows(spark):
    rows = [
        (1, 0, "user", "a"), (1, 1, None, None), (2, 0, "user", "a"), (2, 0, "user", "a"), (3, None, "user", "a"), (3, 0, "user", "b"),
        (None, 0, "system", "x"), (None, 1, "user", None), (5, 0, None, "a"), (6, 0, "user", ""), (7, 0, "user", "a"), (7, 0, "assistant", "a"),
        (8, 500, "user", "late"), (8, 3, "user", "early"), (9, 0, "user", "z" * 100_000), (10, -5, "user", "below"),
    ]
    assert got(chat.chat_format(frame(spark, rows))) == brute_force(rows)
    assert chat.chat_format(frame(spark, [])).count() == 0


def test_long_conversation_and_crowded_turn(spark):
    long = [(1, t, "user", f"t{t}") for t in range(5000)]
    prefix = [(2, t, "user", f"t{t}") for t in range(4200)]
    other = [(3, t, "user", f"t{t}" if t != 77 else "other") for t in range(4200)]
    assert got(chat.chat_format(frame(spark, long + prefix + other))) == brute_force(long + prefix + other)
    crowd = [(1, 0, "user", f"t{i:04}") for i in range(2500)]
    rows = chat.render(frame(spark, crowd), crowd=1000).collect()
    assert len(rows) == 3 and sum(r["n_turns"] for r in rows) == 2500 and max(r["n_turns"] for r in rows) < 1200


def test_no_python_in_the_plan(spark):
    plan = chat.chat_format(frame(spark, logs(1, 3)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_one_order_at_any_size(spark):
    """Crowds at numbers beside others, and rows without a number: parts of bounded size, in the order of role and text."""
    crowd = [(1, t, "user", f"t{i * 7919 % 3000:04}") for t, n in ((0, 3), (1, 2500), (2, 4), (70, 1)) for i in range(n)]
    unnumbered = [(2, None, "user", f"u{i * 7919 % 5000:04}") for i in range(5000)] + [(2, 0, "user", "after")]
    rows = chat.render(frame(spark, crowd + unnumbered).repartition(5), crowd=1000).collect()
    assert len([r for r in rows if r["conv_id"] == 2]) > 5 and max(r["n_turns"] for r in rows) <= 1000
    for conv, source in ((1, crowd), (2, unnumbered)):
        own = sorted((r for r in rows if r["conv_id"] == conv), key=lambda r: (r["segment"] is not None, r["segment"] or 0, r["part"]))
        want = sorted({(t is not None, t or 0, x) for _, t, _, x in source})
        assert "".join(r["text"] for r in own) == "".join(f"<|user|>\n{x}\n<|end|>\n" for *_, x in want)
