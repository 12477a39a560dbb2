"""Template matches against a word-by-word version, re-parameterised questions, and awkward rows."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from leadlens.llm import decontamination as dc

from .samples import AWKWARD, frame, prose

ITEMS = [
    (1, "If Anna buys 12 apples for 3 dollars each and gives 5 of them to Bernard how much did Anna pay for what is left"),
    (2, "A train that leaves Oslo drives 80 km in the first hour and then keeps the same speed until it gets to Bergen"),
    (3, "short one"), (4, None), (5, ""), (6, prose(9, 60)), (6, prose(9, 60)), (7, "seven plain words are one whole window"),
]
HIDDEN = [
    (20, "Intro here. If Carol buys 99 apples for 7 dollars each and gives 41 of them to Dmitri how much did Carol pay for what is left", 1),
    (21, "A train that leaves Paris drives 70 miles in the first hour and then keeps the same speed until it gets to Lyon.", 2),
    (22, prose(1, 200) + " " + prose(9, 60) + " " + prose(2, 200), 6),
    (23, prose(9, 60).upper(), 6),
    (24, "ok so:\tseven plain words are one whole window", 7),
]
CLEAN = [
    (30, "If Carol buys 99 apples and Carol gives Dmitri 5 pears then Anna will pay for what is left of the 12 dollars", None),
    (31, prose(9, 60)[:60], None), (32, "short one", None), (33, prose(5, 500), None), (34, "1 2 3 4 5 6 7 8 9 10 11 12", None),
]


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame([(*x, "clash", "clash") for x in ITEMS], "item_id long, text string, doc_id string, hash string")


def test_finds_hidden_items_and_leaves_clean_documents(spark, benchmark):
    docs = frame(spark, [(i, t, "en") for i, t, _ in HIDDEN + CLEAN])
    rows = dc.decontamination(docs, benchmark).collect()
    assert sorted({(r["doc_id"], r["item_id"]) for r in rows}) == [(i, item) for i, _, item in HIDDEN]
    by = {r["doc_id"]: r for r in rows}
    assert by[20]["changed_slots"] > 0 and by[22]["changed_slots"] == 0
    kept = dc.without_benchmark(docs, benchmark)
    assert kept.schema == docs.schema and sorted(r["doc_id"] for r in kept.collect()) == [i for i, *_ in CLEAN]


def test_inconsistent_slots_do_not_count(spark, benchmark):
    """Anna is Carol at one place and Emma at another; 12 and 5 become the same number."""
    bad = "If Carol buys 8 apples for 7 dollars each and gives 8 of them to Dmitri how much did Emma pay for what is left"
    assert dc.decontamination(frame(spark, [(1, bad, "en")]), benchmark).count() == 0


def test_all_windows_joined_beyond_the_bound(spark, benchmark, monkeypatch):
    docs = frame(spark, [(i, t, "en") for i, t, _ in HIDDEN + CLEAN])
    want = sorted(map(tuple, dc.decontamination(docs, benchmark).collect()))
    monkeypatch.setattr(dc, "SMALL_WINDOWS", 0)
    assert sorted(map(tuple, dc.decontamination(docs, benchmark).collect())) == want


def test_awkward_rows(spark, awkward, nothing, benchmark):
    assert dc.decontamination(awkward, benchmark).count() == 0
    assert dc.without_benchmark(awkward, benchmark).count() == len(AWKWARD)
    assert dc.without_benchmark(awkward, benchmark.limit(0)).count() == len(AWKWARD)
    assert dc.decontamination(nothing, benchmark).count() == 0
    twice = frame(spark, [(None, HIDDEN[2][1], "en"), (None, "clean", "en"), (1, HIDDEN[2][1], "en"), (1, HIDDEN[2][1], "en")])
    assert sorted((r["doc_id"] or 0) for r in dc.decontamination(twice, benchmark.filter("item_id = 6").limit(1)).collect()) == [0, 1]
    assert [r["text"] for r in dc.without_benchmark(twice, benchmark).collect()] == ["clean"]


def tokens(text):
    """Templates and slots of plain ASCII text, word by word."""
    out, previous, tight = [], None, False
    for raw in re.findall(r"[^\x20\x09-\x0D]+", text):
        core = re.sub(r"^[^A-Za-z0-9%]+|[^A-Za-z0-9%]+$", "", raw)
        opens = previous is None or previous[-1] in ".!?:"
        previous = raw
        if not core:
            tight = False
            continue
        digits, letters = re.search(r"\d", core), re.search("[A-Za-z]", core)
        if digits and not letters or core.lower() in dc.number_words():
            kind = "number"
        elif core[0].isdigit() and letters:
            kind = "quantity"
        elif out and out[-1][0] == "number" and core.lower() in dc.UNITS:
            kind = "unit"
        elif core[0].isupper() and not (len(core) > 1 and core[1].isupper()) and not digits:
            kind = "name"
        else:
            kind = None
        if kind in ("name", "number") and tight and not opens and out[-1][0] == kind:
            out[-1] = (kind, (*out[-1][1], core.lower()), kind)
        else:
            out.append((kind or core.lower(), (core.lower(),), kind))
        tight = raw.endswith(core)
    return out


def test_windows_match_a_word_by_word_version(spark):
    rng = random.Random(8)
    pool = ["Anna", "Mary", "two", "hundred", "twenty-five", "one,", "went", "to", "the", "12", "km", "3kg", "--", "shop.", "Then", "(five)", "USA", "7.5", "%", "apples,", "x1", "No!"]
    texts = [" ".join(rng.choices(pool, k=rng.randint(0, 30))) for _ in range(150)]
    rows = dc.template_windows(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), ["doc_id"]).collect()
    got, hashes = {}, {}
    for r in rows:
        got[r["doc_id"], r["position"]] = (r["hash"], r["slots"])
    want = {}
    for i, t in enumerate(texts):
        seen = tokens(t)
        for at in range(max(1, len(seen) - 7) if seen else 0):
            window = seen[at : at + 8]
            if sum(k is None for *_, k in window) >= dc.LEAST_PLAIN:
                want[i, at] = (tuple(x for x, *_ in window), tuple(v for _, v, k in window if k))
    assert set(got) == set(want)
    for key, (template, slots) in want.items():
        assert hashes.setdefault(template, got[key][0]) == got[key][0]  # same template, same hash
        assert len(got[key][1]) == len(slots)
        for value, h in zip(slots, got[key][1], strict=True):
            assert hashes.setdefault(("slot", value), h) == h


PLAINLESS = [
    (1, "12 + 30 * 4 = ?"), (2, "Anna Bernard Carol Dmitri Emma Fritz Greta Hans Ida Jonas"), (3, "以下关于水的沸点的说法中，哪一项是正确的？"),
    (4, "Die Katze sitzt auf dem Dach und der Hund im Garten sieht den Vogel am Fenster und die Maus im Keller"),
    (5, "น้ำเดือดที่อุณหภูมิเท่าใดในระดับน้ำทะเล"), (6, "What is the boiling point of water at the height of the sea"), (7, "Столица какой страны стоит на реке Дунай и называется Вена?"),
]


def test_verbatim_items_of_any_script_and_case_are_found(spark):
    items = spark.createDataFrame(PLAINLESS, "item_id long, text string")
    hidden = [(i, f"{prose(i, 60)}. {t} {prose(i + 50, 60)}", "en") for i, t in PLAINLESS]
    changed = [(n + i, f"{prose(i, 60)}. {f(t)} {prose(i + 50, 60)}", "en") for i, t in PLAINLESS for n, f in ((10, str.upper), (40, str.lower))]
    titled = [(26, f"{prose(1, 60)}. {PLAINLESS[5][1].title()}", "en"), (23, "前文。" + PLAINLESS[2][1] + "后文继续。", "zh")]
    clean = [(30, "12 - 30 / 4 = ?", "en"), (31, "水的沸点是一百度。" * 3, "zh"), (32, "12 30 4 and more of it", "en"), (33, "Anna and Carol met Emma and Hans", "en")]
    rows = dc.decontamination(frame(spark, hidden + changed + titled + clean), items).collect()
    want = {(i, i) for i, _ in PLAINLESS} | {(n + i, i) for i, _ in PLAINLESS for n in (10, 40)} | {(26, 6), (23, 3)}
    assert {(r["doc_id"], r["item_id"]) for r in rows} == want
    assert sorted(r["doc_id"] for r in dc.without_benchmark(frame(spark, hidden + clean), items).collect()) == [i for i, *_ in clean]


# Questions as they stand and as templates of names, numbers and number words.
QUESTIONS = [
    "{A} has {n} apples in the basket. {B} has {m} more apples than {A} has. How many apples do {A} and {B} have together when they put them in one box?",
    "A farmer sells {n} sheep and {m} cows at the market in {C}. He gets {k} dollars for each of them and pays {j} dollars for the way home. How much is left?",
    "{A} walks {n} miles to school every day and {B} rides {m} miles by bus. After {k} days, how much further has {B} gone than {A} on the way to school?",
    "{A} bought {n} pens for {m} cents each from the shop of {B}. What does the shop owe {A} if {k} of the pens were broken and are paid back?",
    "In {C} the tram needs {n} minutes from the station to the river. {A} leaves at {m} and stops for {k} minutes on the way. When is {A} at the river?",
]
NAMES = ["Alice", "Bob", "Maria", "Peter", "Tom", "Mary Ann", "Jean Luc Picard", "Zoë", "Ibrahim", "Olga"]
CITIES = ["Oslo", "New York", "Köln", "Rio de Janeiro", "Graz"]
NUMBERS = ["3", "12", "7", "three", "twelve", "twenty-five", "two hundred", "1500", "eleven", "90"]


def question(rng, template):
    a, b = rng.sample(NAMES, 2)
    n, m, k, j = rng.sample(NUMBERS, 4)
    return template.format(A=a, B=b, C=rng.choice(CITIES), n=n, m=m, k=k, j=j)


def test_reparameterised_questions_are_found(spark):
    """Recall over generated swaps of names and numbers, at sentence beginnings and in words; other questions are left alone."""
    rng = random.Random(17)
    items = [(k, question(rng, t)) for k, t in enumerate(QUESTIONS)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = [(1000 + 100 * k + i, f"{prose(i, 80)}. {question(rng, t)} {prose(i + 1, 80)}", "en") for k, t in enumerate(QUESTIONS) for i in range(40)]
    clean = [(i, f"{prose(i, 100)}. {rng.choice(NAMES)} has {rng.choice(NUMBERS)} apples and gives {rng.choice(NAMES)} some of them. {prose(i + 9, 60)}", "en") for i in range(200)]
    found = {(r["doc_id"], r["item_id"]) for r in dc.decontamination(frame(spark, docs + clean), benchmark).collect()}
    want = {(1000 + 100 * k + i, k) for k in range(len(QUESTIONS)) for i in range(40)}
    print(f"recall {len(found & want) / len(want):.3f} of {len(want)}")
    assert len(found & want) >= 0.9 * len(want) and not found - want


def test_swapped_values_must_be_consistent_at_sentence_beginnings(spark):
    item = "Alice has 12 apples in the basket. Bob has 7 more apples than Alice has."
    good = "Maria has 30 apples in the basket. Peter has 9 more apples than Maria has."
    bad = "Maria has 30 apples in the basket. Maria has 9 more apples than Peter has."
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = dc.decontamination(frame(spark, [(1, good, "en"), (2, bad, "en"), (3, item, "en")]), benchmark).collect()
    assert sorted((r["doc_id"], r["changed_slots"] > 0) for r in rows) == [(1, True), (3, False)]


def by_hand(docs, items, share=0.5, enough=18):
    """Finds of the template windows, from all pairs of windows: slots consistent on a diagonal, or unchanged."""

    def windows(text):
        seen = tokens(text or "")
        found = []
        for at in range(max(1, len(seen) - 7) if seen else 0):
            window = seen[at : at + 8]
            if sum(k is None for *_, k in window) >= dc.LEAST_PLAIN:
                found.append((at, tuple(x for x, *_ in window), tuple(v for _, v, k in window if k)))
        return found

    def first(found):
        out = {}
        for at, template, slots in found:
            out.setdefault((template, slots), [at, 0])[1] += 1
        return [(at, n, *key) for key, (at, n) in out.items()]

    out = set()
    for i, text in docs:
        ours = first(windows(text))
        for j, item in items:
            theirs, diagonals = first(windows(item)), {}
            for at, _, template, slots in ours:
                for place, n, other, old in theirs:
                    if template == other:
                        diagonals.setdefault(at - place, []).append((place, n, tuple(zip(old, slots, strict=True))))
            found = set()
            for matches in diagonals.values():
                pairs = {p for *_, ps in matches for p in ps}
                straight = len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs})
                found |= {(place, n) for place, n, ps in matches if straight or all(a == b for a, b in ps)}
            total, met = sum(n for _, n, *_ in theirs), sum(n for _, n in found)
            if met and met >= min(enough, share * total):
                out.add((i, j))
    return out


def test_whole_query_equals_all_pairs_by_hand(spark, monkeypatch):
    """Windows, diagonals and slots over generated texts; verbatim windows, which have tests of their own, are left out."""
    rng = random.Random(23)
    items = [(k, question(rng, t)) for k, t in enumerate(QUESTIONS)] + [(9, "na na 12 na na na na na " * 6), (10, "tic tac toe Anna " * 5)]
    docs = []
    for i in range(120):
        words = question(rng, rng.choice(QUESTIONS)).split() if i % 4 else "na na 7 na na na na na tic tac toe Bob".split() * rng.randint(1, 9)
        for _ in range(rng.randint(0, 6)):  # cut out, doubled, changed
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 3)] = rng.choice([[], [rng.choice(NAMES)], [rng.choice(NUMBERS)], ["other", "words"], words[at : at + 2]])
        docs.append((i, " ".join(words * rng.choice([1, 1, 2]))))
    texts = [(i, t.replace("Zoë", "Zoe").replace("Köln", "Kiel")) for i, t in docs]
    items = [(i, t.replace("Zoë", "Zoe").replace("Köln", "Kiel")) for i, t in items]
    monkeypatch.setattr(dc, "verbatim_finds", lambda rows, *a: rows.select("doc_key", "doc_id", F.lit(0).alias("item_key"), F.lit(0).alias("item_id"), *[F.lit(0).alias(c) for c in ("found_windows", "item_windows", "changed_slots")]).limit(0))
    got = dc.decontamination(frame(spark, [(i, t, "en") for i, t in texts]), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == by_hand(texts, items)
    assert len(got) > 20


def test_texts_that_repeat_themselves_make_few_rows(spark):
    """An item of equal windows and a document of 100,000 words of them: seconds, not minutes."""
    item = spark.createDataFrame([(1, "na " * 400), (2, "la 5 la la la la la la " * 40)], "item_id long, text string")
    docs = frame(spark, [(1, "na " * 100_000, "en"), (2, "la 6 la la la la la la " * 12_500, "en"), (3, prose(1, 100), "en")])
    start = time.perf_counter()
    assert sorted((r["doc_id"], r["item_id"]) for r in dc.decontamination(docs, item).collect()) == [(1, 1), (2, 2)]
    assert time.perf_counter() - start < 20


def test_short_items_as_whole_lines(spark):
    benchmark = spark.createDataFrame([(1, "2 + 2 ?"), (2, "Why?"), (3, " "), (4, None), (5, prose(3, 30))], "item_id long, text string")
    docs = frame(spark, [(1, "first\n why?  \nlast", "en"), (2, "why not", "en"), (3, prose(3, 30), "en"), (4, None, "en"), (5, " \n", "en")])
    found = dc.contaminated(docs, benchmark, least_tokens=5, lines=True).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(1, 2), (3, 5)]
    assert [r["item_id"] for r in dc.contaminated(docs, benchmark).collect()] == [5]
