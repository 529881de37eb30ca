"""Importance resampling against counting in plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from caretiers.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, n, buckets):
    w = WORD.findall((text or "").translate(UPPER))
    return w, [crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute(rows, targets, n, buckets, percent, min_words):
    raw, target = Counter(), Counter()
    for _, text in rows:
        raw.update(features(text, n, buckets)[1])
    for text in targets:
        target.update(features(text, n, buckets)[1])
    s, t = sum(raw.values()), sum(target.values())
    gain = {b: math.floor(1000 * math.log((target[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets)))) for b in range(buckets)}
    out, eligible = [], []
    for doc_id, text in rows:
        w, f = features(text, n, buckets)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(f), weight, score, None])
        if len(w) >= min_words:
            eligible.append(out[-1])
    eligible.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(eligible[: percent * len(eligible) // 100], 1):
        r[4] = rank
    return Counter(map(tuple, out))


@pytest.fixture
def rows():
    rng = random.Random(12)
    vocabulary = ["a", "A", "bé", "3", "the", "x" * 40, "ñandú", "\u0085q", "\xa0", "日本語", "𝒳y", "b2"]
    joins = [" ", ", ", "\n", "--", "_", "\t. ", "\x7f"]
    texts = ["".join(rng.choice(vocabulary) + rng.choice(joins) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    texts += [None, "", " ", "word", "a b c " * 3000, "tail", " the the", "THE\x00the"]
    found = list(enumerate(texts))
    return [*found, *found[:9], (None, texts[3]), (None, None)]


@pytest.mark.parametrize("max_words", [1, 2, 3])
def test_all_columns_match_counting(spark, make, rows, max_words):
    targets = [rows[k][1] for k in (1, 5, 9)] + ["the bé 3 the", None, "unseen words here"]
    found = resampling.resample(make(rows), spark.createDataFrame([(t,) for t in targets], "text string"), 30, 20, max_words, 97)
    expected = brute(rows, targets, max_words, 97, 30, 20)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    got = Counter(map(tuple, found.collect()))
    differ = {k[0] for k in (got - expected)}
    assert got == expected, differ


def test_production_parameters(spark, make, rows):
    targets = [rows[7][1]]
    found = resampling.resample(make(rows), spark.createDataFrame([(targets[0],)], "text string"))
    assert Counter(map(tuple, found.collect())) == brute(rows, targets, 1, 10_000, 10, 20)


def test_composed_crc():
    rng = random.Random(1)
    pairs = [(rng.randbytes(rng.randint(0, 50)), rng.randbytes(rng.choice([0, 1, 7, 300, 70_000]))) for _ in range(60)]
    first, second = (np.array([crc32(p[k]) for p in pairs], np.uint32) for k in (0, 1))
    lengths = np.array([len(p[1]) for p in pairs])
    assert resampling.composed(first, second, lengths).tolist() == [crc32(a + b) for a, b in pairs]


def test_empty_tables_and_further_columns(spark, make):
    target = spark.createDataFrame([], "text string")
    assert resampling.resample(make([]), target).count() == 0
    docs = make([(1, "one two " * 20), (2, None)]).withColumns({c: F.lit("x") for c in ("score", "place", "part", "out", "weight", "rank", "n_words")})
    found = {r["doc_id"]: r for r in resampling.resample(docs, target, percent=100).collect()}
    assert found[1]["rank"] == 1 and found[1]["n_features"] == 40
    assert found[2]["rank"] is None and found[2]["weight"] == 0
