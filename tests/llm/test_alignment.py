"""Alignment of two tokenizers against a token-by-token search."""

from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from caretiers.llm import alignment


@pytest.fixture(scope="module")
def tokens():
    """Ids and bytes of both tokenizers' tokens; the first by another library with the same vocabulary."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    first = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def of(text):
        a = [(i, first.decode_single_token_bytes(i)) for i in first.encode_ordinary(" " + text)]
        b = []
        for i in second.encode(text):
            p = second.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()))
        return a, b

    return of


def brute(rows, tokens):
    counts, per_row = Counter(), []
    for doc_id, text in rows:
        a, b = tokens(text) if text else ([], [])
        data = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in a) != data or b"".join(x for _, x in b) != data:
            per_row.append((doc_id, 0, 0, [], ""))
            continue
        ends = [{sum(len(x) for _, x in t[: k + 1]): k for k in range(len(t))} for t in (a, b)]
        both = sorted(ends[0].keys() & ends[1].keys())
        links = [(a[ends[0][e]][0], b[ends[1][e]][0]) for e in both]
        groups, i, j = [], 0, 0
        for e in both:
            x, y = ends[0][e] + 1, ends[1][e] + 1
            groups.append(",".join(str(t) for t, _ in a[i:x]) + "|" + ",".join(str(t) for t, _ in b[j:y]))
            i, j = x, y
        counts.update(links)
        per_row.append((doc_id, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return Counter(
        (d, na, nb, len(links), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), sha)
        for d, na, nb, links, sha in per_row
    )


def texts():
    rng = random.Random(13)
    words = ["the", "Theory", "naïve", "日本語", "🙂", "don't", "x1y2", "internationalisation", "…", "a", "<|endoftext|>", "<s>", "été"]
    found = ["".join(rng.choice(words) + rng.choice([" ", " ", ", ", "-", "\n"]) for _ in range(rng.randint(1, 30))).strip() for _ in range(80)]
    odd = [None, "", " ", "  two", "a  b", "tab\tend\r\n", "▁low", "é", " nbsp", "\x00nul", "ﬁ", "<0x41>", "x" * 3000, "word " * 2000, "</s>", "�"]
    return found + odd


def test_measures_match_a_token_by_token_search(spark, make, tokens):
    plain = texts()
    rows = [*enumerate(plain), *((1000 + k, plain[k % 7]) for k in range(60)), (3, plain[3]), (None, plain[4]), (None, None)]
    found = alignment.measure(make(rows), block_bytes=3000, batch_bytes=700)
    assert found.columns == ["doc_id", *alignment.MEASURES, "groups_sha256"]
    got, expected = Counter(map(tuple, found.collect())), brute(rows, tokens)
    assert got == expected, sorted((got - expected).elements(), key=str)[:3]


def test_text_on_very_many_rows_is_split(spark, make, tokens):
    rows = [(k, "many rows have this text" if k % 3 else "few have this one") for k in range(4500)] + [(None, "many rows have this text")] * 2500
    found = alignment.measure(make(rows))
    assert "_copy" in found._jdf.queryExecution().toString()
    assert Counter(map(tuple, found.collect())) == brute(rows, tokens)


def test_empty_tables_and_further_columns(spark, make):
    assert alignment.measure(make([])).count() == 0
    assert [tuple(r)[1:] for r in alignment.measure(make([(1, None), (2, "")])).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2
    assert [r["n_a"] for r in alignment.measure(make([(1, "▁low")])).collect()] == [0]
    docs = make([(1, "some text")]).withColumns({c: F.lit("x") for c in ("digest", "n", "n_a", "_copy", "block", "count")})
    assert alignment.measure(docs).first()["n_a"] == 2
