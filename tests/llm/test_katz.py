"""The backoff model against one of dictionaries, and its sums over all words."""

from __future__ import annotations

import math
import random
import re
import uuid
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from caretiers.llm import common, katz

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
END, BEGIN = object(), object()


def split(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER)), END]


class Brute:
    """Word pairs counted in dictionaries, probabilities by the formulas of Katz."""

    def __init__(self, texts):
        self.words, self.pairs = Counter(), Counter()
        for t in texts:
            tokens = split(t)
            self.words.update(tokens)
            self.pairs.update(zip([BEGIN, *tokens], tokens, strict=False))
        self.n = sum(self.words.values())
        self.after, self.count = defaultdict(dict), Counter()
        for (h, w), r in self.pairs.items():
            self.after[h][w] = r
            self.count[h] += r
        self.dw, self.dp = self.discount(self.words), self.discount(self.pairs)
        left = sum(r * (1 - self.dw(r)) for r in self.words.values())
        self.unknown = max(left / self.n, 1 / (self.n + 1)) if self.n else 1.0
        self.kept = (1 - self.unknown) / (self.n - left) if self.n else 0

    @staticmethod
    def discount(counts):
        n = Counter(counts.values())
        for k in (5, 4, 3, 2):
            if all(n[r] for r in range(1, k + 2)):
                c = (k + 1) * n[k + 1] / n[1]
                d = {r: (((r + 1) * n[r + 1] / n[r]) / r - c) / (1 - c) for r in range(1, k + 1)} if c != 1 else {1: 0}
                if all(0 < x < 1 for x in d.values()):
                    return lambda r: d.get(r, 1)
        return lambda r: (r - 0.5) / r if r <= 5 else 1

    def word(self, w):
        r = self.words[w]
        return self.kept * self.dw(r) * r if r else self.unknown

    def given(self, h, w):
        seen, c = self.after.get(h, {}), self.count[h]
        if not seen:
            return self.word(w)
        left = sum(r * (1 - self.dp(r)) for r in seen.values())
        free = left / c if left > 0 else 1 / (c + 1)
        if w in seen:
            return (1 - free) / (c - left) * self.dp(seen[w]) * seen[w]
        return free / (1 - sum(map(self.word, seen))) * self.word(w)

    def score(self, text):
        tokens = split(text)
        known = sum(self.words[t] > 0 for t in tokens)
        base = sum(math.log10((self.words[t] + 1) / (self.n + len(self.words) + 1)) for t in tokens)
        return len(tokens), known, self.n, base, sum(math.log10(self.given(h, w)) for h, w in zip([BEGIN, *tokens], tokens, strict=False))


def held_out(doc_id):
    return crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def check(found, rows, out=held_out):
    model = Brute([t for d, t in rows if not out(d)])
    expected = sorted((str(d), out(d), *model.score(t)) for d, t in rows)
    got = sorted((str(r[0]), *tuple(r)[1:]) for r in found.collect())
    assert len(got) == len(expected)
    for a, b in zip(got, expected, strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-9), a
    return model


def corpus(seed, n=300):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)] + ["The", "the", "été", "日本", "x" * 300, "a\x00b", "."]
    text = lambda: "".join(rng.choice(vocabulary[: rng.choice([6, 40, 407])]) + rng.choice([" ", "  ", "\n", "\t"]) for _ in range(rng.randint(0, 50)))
    return [(k, text()) for k in range(n)]


def test_scores_match_dictionaries(spark, make):
    rows = [*corpus(11), (900, None), (901, ""), (902, "only unseen-1 unseen-2"), (3, "w1 w2"), (3, "w1 w2"), (None, "w5 w6 the"), (None, None)]
    rows += [(5000 + k, "the same words on very many rows") for k in range(200)] + [(7000, "the w1 " * 9000)]
    found = katz.score(make(rows), block_bytes=4000, bucket_bytes=6000)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    model = check(found, rows)
    for h in [BEGIN, "the", "w1", "w300", "same", "never"]:
        total = sum(model.given(h, w) for w in model.words) + model.given(h, "an unknown word")
        assert total == pytest.approx(1)


def test_one_block_gives_the_same(spark, make):
    rows = corpus(12, 60)
    check(katz.score(make(rows)), rows)


@pytest.mark.parametrize("texts", [["a"], ["a a a a a a a a"] * 9, [None, None], ["b c", "b c", "b d"]])
def test_small_corpora(spark, make, texts):
    rows = [*enumerate(texts), (50, "b z"), (51, "a a")]
    check(katz.score(make(rows), "doc_id >= 50"), rows, lambda d: d >= 50)


def test_nothing_to_learn_from_and_empty_tables(spark, make):
    rows = [(1, "some words"), (2, None)]
    found = {r["doc_id"]: r for r in katz.score(make(rows), "true").collect()}
    assert found[1]["score"] == 0 and found[1]["n_known"] == 0 and found[1]["train_tokens"] == 0 and found[1]["base_score"] == 0
    assert katz.score(make([])).count() == 0


def test_further_columns(spark, make):
    rows = corpus(13, 20)
    docs = make(rows).withColumns({c: F.lit("x") for c in ("block", "bucket", "data", "held_out", "score", "ids", "tokens")})
    check(katz.score(docs), rows)


def test_nothing_is_left_behind(spark, make, tmp_path, monkeypatch):
    for module in (common, katz):
        monkeypatch.setattr(module, "shared_dir", lambda _: f"{tmp_path}/{uuid.uuid4().hex}")
    assert katz.score(make(corpus(14, 20))).count() == 20
    assert len(list(tmp_path.iterdir())) == 1  # the result
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("caretiers_katz")]


def test_discounts():
    d = katz.discounts(np.array([100, 40, 22, 14, 10, 7]))
    assert all(0 < x < 1 for x in d[1:]) and d[0] == 1
    # With these discounts the words seen once to K times leave as many tokens as there are words seen once.
    n = np.array([100, 40, 22, 14, 10])
    assert (np.arange(1, 6) * n * (1 - d[1:])).sum() == pytest.approx(100)
    assert katz.discounts(np.array([3, 0, 1, 0, 0, 0])).tolist() == [1, 0.5, 0.75, 2.5 / 3, 3.5 / 4, 0.9]
