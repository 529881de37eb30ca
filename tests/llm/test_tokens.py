"""Encoding, token files and packing against whole-text encoding, one document after the other."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from caretiers.llm import common, packing, tokenfiles
from caretiers.llm.encoding import Encoder, _Words

SF = "/root/testdata/sf0.001"
PIECES = [" ", "  ", "\n", "\n ", " \n", "é", " ", "　", "\x1c", "\x85", "a", "The", "word", ".", ",", "'s", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "12", "\t", "ß", "İ", "Σ", "̈", "中文", "\r", "😀"]


def whole(name, texts, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, end], "<u4") for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cut_texts_have_the_ids_of_whole_texts(name):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12))) for _ in range(8000)]
    texts += ["".join(rng.choice("aeßÀéłǅŉĳſΩ ʼn") for _ in range(6)) for _ in range(4000)]
    encoder = Encoder(name)
    for text, ids in zip(texts, whole(name, texts, 0), strict=True):
        assert encoder.encode(text) == ids[:-1].tobytes(), text


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_symbols_behind_words_are_pieces_of_their_own(name, monkeypatch):
    rng, asked, ids_of = random.Random(2), [], _Words.ids
    monkeypatch.setattr(_Words, "ids", lambda self, text: asked.append(text) or ids_of(self, text))
    words = ["".join(rng.choice("abcdeéß") for _ in range(8)) + rng.choice(["$$$", "!!", ".###", ",***", "?", "&&&"]) for _ in range(300)]
    texts = [" ".join(words), "".join(words), "\n".join(words), "!! a!! !!a ... 7%%% É*** İ!! it's,'s!"]
    encoder = Encoder(name)
    for text, ids in zip(texts[:1], whole(name, texts[:1], 0), strict=True):
        assert encoder.encode(text) == ids[:-1].tobytes()
    assert len(asked) < 30
    for text, ids in zip(texts, whole(name, texts, 0), strict=True):
        assert encoder.encode(text) == ids[:-1].tobytes(), text


def test_token_files_round_trip(spark):
    docs = common.documents(spark, SF)
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = sorted(tokenfiles.query(spark, SF).collect())
    start = 0
    for row, (doc_id, _), ids in zip(got, rows, whole(tokenfiles.TOKENIZER, [t for _, t in rows], tokenfiles.END), strict=True):
        assert tuple(row) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_of_odd_rows(make, spark):
    docs = make([(3, None), (1, ""), (2, "a b"), (2, "a b"), (None, "x"), (4, "word " * 60_000)]).selectExpr("*", "1 as before", "2 as ids")
    path = common.shared_dir(spark)
    tokenfiles.write(docs, path)
    got = tokenfiles.read(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 2, 2, 3, 4]
    assert [r["start"] for r in got] == list(np.cumsum([0] + [r["n_tokens"] for r in got])[:-1])
    assert [r["ids"] for r in got if r["doc_id"] in (1, 3)] == [[0], [0]]
    found = tokenfiles.look_up(spark, path, [4])
    assert found.collect()[0]["n_tokens"] == got[-1]["n_tokens"]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString() or "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id" in found._jdf.queryExecution().toString()
    empty = common.shared_dir(spark)
    tokenfiles.write(make([]), empty)
    assert tokenfiles.read(spark, empty).count() == 0


def check_packed(rows, texts, with_ids=True):
    """Each id in one piece, sequences gapless and within capacity, checksums right."""
    want = dict(zip(range(len(texts)), whole(packing.TOKENIZER, texts, packing.END), strict=True))
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert set(pieces) == set(want)
    for doc, found in pieces.items():
        at = 0
        for r in sorted(found, key=lambda r: r["start"]):
            ids = want[doc][at : at + r["length"]]
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids.tobytes()) and r["doc_tokens"] == len(want[doc])
            assert not with_ids or r["ids"] == ids.tolist()
            at += r["length"]
        assert at == len(want[doc])
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert 0 < at <= packing.CAPACITY
    return sequences


def test_packing_covers_every_id(make, spark):
    texts = [r["text"] for r in common.documents(spark, SF).orderBy("doc_id").collect()] + [None, "", "w " * 30_000]
    docs = make(list(enumerate(texts))).selectExpr("*", "1 as start", "2 as ids")
    sequences = check_packed(packing.pack(docs).collect(), texts)
    tokens = sum(len(x) for x in whole(packing.TOKENIZER, texts, 1))
    assert tokens / (packing.CAPACITY * len(sequences)) > 0.95
    assert packing.pack(make([])).count() == 0
    assert packing.pack(make([(1, "a")] * 2 + [(None, "b")])).count() == 3


def test_windows_are_near_equal_and_rise_in_number():
    rng = random.Random(2)
    sizes = [rng.randint(1, 512) for _ in range(800)]
    windows = packing.windows_of(sizes)
    assert sorted(i for w in windows for i in w) == list(range(800))
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert max(sums) <= packing.CAPACITY and min(sums) > 0.9 * packing.CAPACITY
    assert packing.windows_of([1500, 1500, 1000]) == packing.windows_of([1500, 1500, 1000]) and len(packing.windows_of([1500, 1500, 1000])) == 3
    assert packing.windows_of([]) == []
