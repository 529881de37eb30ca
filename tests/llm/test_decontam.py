"""Decontamination against a search of every phrase in every document."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np

from caretiers.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(text, items):
    w, hit, found = split(text), set(), set()
    for item, t in items:
        v = split(t)
        n = min(10, len(v))
        windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def run(spark, make, texts, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.scan(make(list(enumerate(texts))), benchmark).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:] == brute(texts[r["doc_id"]], items), r["doc_id"]


def test_random_documents_match_brute_force(spark, make):
    rng = random.Random(4)
    vocabulary = ["a", "b", "É", "3", "the", "The", "x9", "ñ"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-", "_"]) for _ in range(n))

    items = [(i, text(rng.randint(0, 16))) for i in range(25)] + [(90, None), (91, "a b c"), (92, "zz"), (91, "the x9 ñ")]
    texts = [text(rng.randint(0, 80)) for _ in range(120)]
    texts += ["a " + (items[k][1] or "") + " zz, b" for k in range(10)] + [None, "", "a b " * 2000, "zz " * 3000]
    run(spark, make, texts, items)


def test_the_sql_with_short_items():
    rng = random.Random(8)
    word = lambda: rng.choice(["a", "B", "the", "ñ", "9"])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 2, 3, 5, 9, 10, 11, 14, 0])] + [(20, None)]
    docs = [(i, ", ".join(word() for _ in range(rng.randint(0, 40))) + (items[i % 9][1] or "")) for i in range(60)] + [(60, None)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    assert {r[0]: r[1:] for r in con.execute(decontam.ORACLE).fetchall()} == {i: brute(t, items) for i, t in docs}


def test_no_items_and_no_documents(spark, make):
    run(spark, make, ["a b c", None], [(1, None), (2, "...")])
    run(spark, make, ["a b c"], [])
    assert decontam.scan(make([]), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


def test_spans_are_cut_out_of_texts(spark, make):
    item = "one two three four five six seven eight nine ten eleven"
    docs = make([(1, f"Keep this. {item.upper()}! And étre this."), (2, "clean one two"), (3, None), (4, f"{item}\n{item}")]).selectExpr("*", "1 as n_hit")
    got = {r["doc_id"]: r for r in decontam.remove(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got[1]["text"] == "Keep this. ! And étre this." and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] == "clean one two" and got[3]["text"] is None and got[4]["text"] == ""
    assert got[1]["n_hit"] == 1


def test_index_counts_and_locates():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 5, 700)
    text[[100, 300, 699]] = [-1, -2, -3]
    index = decontam.FMIndex(text, 5)
    patterns = rng.integers(0, 5, (60, 3))
    which, low, high = index.search(patterns)
    for k, p in enumerate(patterns):
        want = [i for i in range(698) if (text[i : i + 3] == p).all()]
        at = np.flatnonzero(which == k)
        got = sorted(index.locate(np.arange(low[at[0]], high[at[0]]))) if len(at) else []
        assert got == want


def test_a_benchmark_of_many_parts(spark, make, monkeypatch):
    rng = random.Random(7)

    def text(n):
        return " ".join(rng.choice(["a", "b", "É", "3", "the", "x9", "ñ", f"q{rng.randint(0, 50)}"]) for _ in range(n))

    items = [(i, text(rng.randint(0, 30))) for i in range(40)] + [(90, text(300)), (90, "b a 3"), (91, None), (None, "the a the")]
    texts = [text(40) + " " + (items[k % 42][1] or "") + " " + text(20) for k in range(60)] + [items[40][1], None, ""]
    monkeypatch.setattr(decontam.shared, "__defaults__", (200, 16))
    benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    assert len(decontam.shared(benchmark).parts) > 20
    run(spark, make, texts, items[:-1])
    left = {r["doc_id"]: r["text"] for r in decontam.remove(make(list(enumerate(texts))), benchmark).collect()}
    for k, t in enumerate(texts):
        n_words, n_hit, *_ = brute(t, items)
        assert len(split(left[k])) == n_words - n_hit


def test_a_benchmark_of_more_than_twenty_million_characters(spark, make):
    item = "one two three four five six seven eight nine ten eleven"
    items = spark.range(21).selectExpr("id as item_id", f"concat(repeat(concat(repeat('x', 9999), ' '), 100), '{item} ', id, ' twelve') as text")
    docs = make([(1, f"Keep this. {item} 20 twelve! And this."), (2, "clean")])
    got = {r["doc_id"]: r for r in decontam.scan(docs, items).collect()}
    assert (got[1]["n_hit"], got[1]["n_items"], got[2]["n_hit"]) == (13, 21, 0)
    assert {r["doc_id"]: r["text"] for r in decontam.remove(docs, items).collect()}[1] == "Keep this. ! And this."
