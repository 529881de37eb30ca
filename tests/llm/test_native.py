"""Quality rules, line removal, licences and placement: odd rows, SQL oracles, brute force."""

from __future__ import annotations

import random
import re
import time
from collections import Counter

import duckdb
import pytest

from caretiers.llm import common, licenses, lines, quality, registry, sharding

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = registry.QUERIES[name](spark, SF)
    want = con.execute(registry.ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(map(tuple, df.select(names).collect())) == Counter(want.fetchall())


def test_quality_of_odd_rows(make):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two three four five six seven eight nine ten"), (5, "a b c d e " * 5), (None, "x"), (6, "w " * 100_000)]
    got = {r["doc_id"]: r for r in quality.measure(make(rows)).collect()}
    assert len(got) == len(rows)
    assert got[1]["n_words"] == got[2]["n_words"] == got[3]["n_words"] == 0
    assert got[4]["kept"] and not got[4]["base_failed"]
    assert got[5]["n_repeat_words"] == 25 and got[5]["base_failed"]
    assert got[6]["n_repeat_words"] == 100_000


def test_cascade_keeps_columns_and_verdicts_in_any_order(make, spark):
    docs = make([(i, t) for i, t in enumerate(["one two three four five six seven eight nine ten"] * 3 + ["SHOUT! " * 20, None])]).selectExpr("*", "1 as words", "2 as _w", "3 as kept")
    assert sorted(r["doc_id"] for r in quality.keep(docs).collect()) == [0, 1, 2]
    assert quality.keep(docs).columns == docs.columns
    order = list(quality.rules("", ""))
    for names in (order, order[::-1]):
        test = quality.let(quality.words(quality.TEXT), "_w", quality.cascade(names, quality.TEXT, "_w"))
        assert docs.where(test).count() == 3
    assert quality.measure(make([])).count() == 0


def test_boilerplate_stays_once(make, spark):
    line = "all rights are reserved here"
    rows = [(i, f"text {i} of its own\n{line}\nand more of {i}", f"site{i % 12}") for i in range(24)]
    rows += [(100, line, "site1"), (101, None, "site2"), (102, "", None), (None, line, "site3"), (103, f"{line}\n{line}", None)]
    out = lines.remove(make(rows).selectExpr("*", "1 as drop", "2 as id", "3 as line"))
    got = {r["doc_id"]: r for r in out.collect()}
    assert line in got[0]["text"] and all(line not in got[i]["text"] for i in range(1, 24))
    assert got[5]["text"] == "text 5 of its own\nand more of 5" and got[5]["n_chars"] == len(got[5]["text"])
    assert got[100]["text"] == "" and got[101]["text"] is None and got[102]["text"] == "" and got[103]["text"] == ""
    assert got[None]["text"] == line and out.count() == len(rows)


def test_short_lines_and_lines_without_spaces_count(make, monkeypatch):
    monkeypatch.setattr(common, "share", lambda total: 40)  # common lines are dealt over copies
    short = ["hello world", "menu", "版权所有翻版必究保留一切权利", "--"]
    rows = [(i, "\n".join([*short, " \t", f"own {i}", ""]), f"site{i % 12}") for i in range(120)]
    got = {r["doc_id"]: r["text"] for r in lines.remove(make(rows)).collect()}
    assert got[0] == rows[0][1]
    assert all(got[i] == f" \t\nown {i}\n" for i in range(1, 120))


@pytest.mark.parametrize("sites", [8, 9, 10, 11, 12])
def test_sites_near_the_threshold_are_counted_exactly(make, sites):
    rows = [(i, "the same five word line", f"s{i % sites}") for i in range(60)]
    assert lines.boilerplate(make(rows)).count() == (1 if sites >= lines.MIN_SITES else 0)
    assert lines.boilerplate(make([])).count() == 0


def test_licences_are_found_inside_other_text(make):
    filler = "some other words stand here and there "
    rows = [(i, filler * 9 + text + " " + filler * 9) for i, text in enumerate(licenses.TEMPLATES.values())]
    everything = (" " + filler).join(licenses.TEMPLATES.values())
    rows += [(50, everything), (51, None), (52, ""), (53, filler), (54, "Licensed under the"), (None, "released under the mit license"), (55, filler * 30_000)]
    got = {r["doc_id"]: r for r in licenses.scan(make(rows)).collect()}
    for i, name in enumerate(licenses.TEMPLATES):
        assert name in got[i]["licenses"].split(","), name
    assert got[50]["n_licenses"] == len(licenses.TEMPLATES)
    assert [got[i]["n_licenses"] for i in (51, 52, 53, 54, 55)] == [0] * 5
    assert got[None]["licenses"] == "MIT-notice"
    assert licenses.scan(make([])).count() == 0


def test_a_very_long_file_of_changed_licences(make):
    rng = random.Random(7)
    words = licenses.TEMPLATES["MIT"].split()
    text = []
    while len(text) < 150_000:
        changed = list(words)
        changed[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        text += changed
    long = " ".join(text)
    assert len(long) > 900_000
    start = time.time()
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan(make([(1, long), (2, long[: 30 * 6]), (1, "released under the mit license"), (3, "x " * 500_000)])).collect()}
    assert got == {1: "MIT,MIT-notice", 2: "", 3: ""}
    assert time.time() - start < 120  # each hit once; it took minutes a megabyte when windows were arrays


@pytest.mark.parametrize("limit", [licenses.BROADCAST, 0])
def test_templates_as_a_table(make, spark, monkeypatch, limit):
    monkeypatch.setattr(licenses, "BROADCAST", limit)
    table = spark.createDataFrame([("one", "a b c d e f g h"), ("two", "short text"), ("none", None), ("empty", "")], "name string, text string")
    docs = make([(1, "x a b c d e f g h"), (2, "A b, c d e f"), (3, "short text"), (4, "a short text here"), (5, None)]).selectExpr("*", "'q' as name", "1 as hash", "2 as row")
    assert {r["doc_id"]: r["licenses"] for r in licenses.scan(docs, table).collect()} == {1: "one", 2: "", 3: "two", 4: "", 5: ""}


def test_lookup_table_is_even_and_stable():
    table = sharding.lookup_table()
    share = Counter(table)
    assert len(table) == sharding.SLOTS and max(share.values()) - min(share.values()) <= 1
    fewer = sharding.lookup_table(sharding.SHARDS[:-1])
    gone = len(sharding.SHARDS) - 1
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != gone)
    assert moved < 0.02 * len(table)
    with pytest.raises(ValueError):
        sharding.lookup_table(("a", "b"), 100)


def test_placement_equals_the_rule(make, spark, tmp_path):
    docs = make([(i, "x") for i in range(300)] + [(None, None), (7, "y")]).selectExpr("*", "1 as slot", "'q' as shard")
    table = sharding.lookup_table()
    for r in sharding.place(docs).collect():
        slot = int(__import__("hashlib").md5(str(r["doc_id"] if r["doc_id"] is not None else "").encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert (r["slot"], r["shard"]) == (slot, sharding.SHARDS[table[slot]])
    assert sharding.place(docs).count() == 302 and sharding.place(make([])).count() == 0
    sharding.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 302 and set(docs.columns) < set(back.columns)


def shingled(text):
    w = re.sub(r"[\W_]+", " ", (text or "").lower()).split()
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])


def licences_by_brute_force(text, wanted):
    """Templates of whose shingles a window of some template's length, half as long again, holds enough."""
    every, found = shingled(text), set()
    longest = max((3 * len(w) + 1) // 2 for w in wanted.values())
    known = set().union(*wanted.values())
    for k in (k for k, s in enumerate(every) if s in known):
        held = set(every[k : k + longest])
        found |= {name for name, w in wanted.items() if len(held & w) >= licenses.CONTAINMENT * len(w)}
    return ",".join(sorted(found))


def test_licences_equal_an_exact_search(make, spark):
    wanted = {name: set(shingled(text)) for name, text in licenses.TEMPLATES.items()}
    texts = []
    for text in licenses.TEMPLATES.values():
        w = text.split()
        for cut in range(0, len(w) // 2, max(1, len(w) // 24)):
            middle = len(w) // 3
            texts += [" ".join(w[cut:]), " ".join(w[: len(w) - cut]), " ".join(w[:middle] + ["other"] * cut + w[middle + cut :])]
    filler = "some other words stand here and there "
    rows = [(i, filler * (i % 4) + t + " " + filler * (i % 3)) for i, t in enumerate(texts)]
    rows += [(100_000 + r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: licences_by_brute_force(t, wanted) for i, t in rows}
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan(make(rows)).collect()}
    assert got == want
    assert 0.3 < sum(want[i] != "" for i in range(len(texts))) / len(texts) < 0.95
