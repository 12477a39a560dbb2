"""Packed pieces against the tokenizer itself, document by document."""

import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SMALL
from tokenizers import Tokenizer

from leadlens.llm import packing

from .samples import AWKWARD, frame

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")


def check(pieces, source, length=packing.LENGTH):
    """Every id of every document lies in one piece, and sequences have no gap and no overlap."""
    texts, found, sequences = defaultdict(list), defaultdict(list), defaultdict(list)
    for i, t, *_ in source:
        texts[i].append(ids_of(t))
    for p in pieces:
        found[p["doc_id"]].append((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]))
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(found) == set(texts)
    for i, all_ids in texts.items():
        assert sum(p[1] for p in found[i]) == sum(map(len, all_ids))
        for start, n, crc, size in found[i]:
            assert n > 0 and any(len(ids) == size and zlib.crc32(ids[start : start + n].tobytes()) == crc for ids in all_ids)
        if len(all_ids) == 1:
            assert sorted(x for start, n, *_ in found[i] for x in range(start, start + n)) == list(range(len(all_ids[0])))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return sum(p["length"] for p in pieces) / (length * len(sequences))


def test_documents_are_packed_whole_and_tight(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert check(packing.packing(docs).collect(), docs.select("doc_id", "text").collect()) > 0.95


def test_awkward_rows(spark, awkward, nothing):
    check(packing.packing(awkward).collect(), AWKWARD)
    assert packing.packing(nothing).count() == 0


@pytest.mark.parametrize("per_task", [3, 1000])
def test_leftovers_of_many_partitions_are_merged(spark, per_task):
    source = [(i, "oak " * (1 + i * 7 % 23), None) for i in range(300)]
    docs = frame(spark, source).repartition(20)
    pieces = packing.pack(docs, PATH, length=64, most=3, least_cut=4, per_task=per_task).collect()
    assert check(pieces, source, 64) > 0.85


def test_run_cache_equals_the_tokenizer(monkeypatch):
    rng = random.Random(5)
    alphabet = list("abcABC  \n\t'.,!?<>|_-09") + ["É", "ß", "\x1c", "\x0b", " ", "é", "🎉", "你", "İ", "Σ", "<|endoftext|>", "'s", "'LL"]
    plain = list("abcABC  \n\t.,!?>|_-09") + ["É", "ß", "ÿ", "ÀÞ"]
    texts = ["".join(rng.choices(rng.choice((alphabet, plain)), k=rng.randint(0, 60))) for _ in range(400)]
    monkeypatch.setattr(packing, "HELD", 300)
    cache = packing.RunCache(PATH)
    for at in range(0, 400, 40):
        part = texts[at : at + 40]
        assert [x.tolist() for x in cache.encode(pa.array(part))] == [e.ids for e in TOKENIZER.encode_batch(part, add_special_tokens=False)]


def test_best_fit_and_emission():
    windows = packing.Windows(10, 2)
    place = lambda n: [(s, k, w, o) for s, k, w, o in packing.cut(windows, n, 2)]
    assert place(6) == [(0, 6, 0, 0)] and place(7) == [(0, 7, 1, 0)]
    assert place(3) == [(0, 3, 1, 7)]  # the fullest with room, which is then full
    assert place(8) == [(0, 8, 2, 0)]
    assert place(5) == [(0, 2, 2, 8), (2, 3, 0, 6)]  # fits nowhere: fills the fullest, the rest goes on
    assert place(23) == [(0, 10, 3, 0), (10, 10, 4, 0), (20, 3, 5, 0)]


def test_tokenizers_that_split_otherwise_are_used_alone(tmp_path):
    """The byte vocabulary keeps case and white space; a changed split or normaliser is noticed too."""
    texts = ["Amber  BIRCH cedar 12\n", None, "", "it's a naïve caf\u00e9", "amber_birch 3.5"]
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.by_runs(PATH) and not packing.by_runs(other)
    made = json.loads(open(PATH, encoding="utf-8").read())
    made["normalizer"]["normalizers"].pop()
    cased = tmp_path / "cased.json"
    cased.write_text(json.dumps(made), encoding="utf-8")
    assert not packing.by_runs(str(cased))
    for path in (PATH, other, str(cased)):
        tokenizer = Tokenizer.from_file(path)
        got = packing.RunCache(path).encode(pa.array(texts, pa.string()))
        assert [list(x) for x in got] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
