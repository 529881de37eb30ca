"""Components of the n-gram join against an inverted index over all shingles."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from caretiers.llm import common, graph, ngramjoin

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def roots(n, links):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute(texts):
    """Sizes and smallest linked index of texts numbered from 0."""
    sets, holders, links = [shingles(t) for t in texts], defaultdict(list), []
    for i, s in enumerate(sets):
        both = Counter(j for x in s for j in holders[x])
        links += [(i, j) for j, o in both.items() if 100 * o >= 75 * (len(s) + len(sets[j]) - o)]
        for x in s:
            holders[x].append(i)
    return [len(s) for s in sets], roots(len(texts), links)


def compare(make, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngramjoin.link(make(list(enumerate(texts)))).collect()}
    assert got == dict(enumerate(zip(*brute(texts), strict=True)))


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.random():.6f}"
    return " ".join(out)


@pytest.mark.parametrize("chunk", [ngramjoin.CHUNK, 900])
def test_groups_of_edited_copies(make, monkeypatch, chunk):
    monkeypatch.setattr(ngramjoin, "CHUNK", chunk)
    rng = random.Random(chunk)
    texts = []
    for size in (60, 25, 8, 2, 1):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(60, 160))]
        texts += [edited(rng, words, rng.randint(0, 6)) for _ in range(size)] + [" ".join(words).upper()] * 3
    passage = " ".join(f"p{i}" for i in range(30))
    texts += [passage + " " + " ".join(f"u{rng.randrange(9000)}" for _ in range(rng.randint(5, 60))) for _ in range(60)]
    texts += [None, "", " \n", "a b", "A  b", "a b c d e", "a b c d", "x " * 3000]
    rng.shuffle(texts)
    compare(make, texts)


def test_similarity_just_at_the_bound(make):
    base = [f"w{i}" for i in range(104)]  # 100 shingles
    texts = [" ".join(base)]
    texts += [" ".join(base[: 104 - cut] + [f"z{cut}_{i}" for i in range(add)]) for cut in range(10, 30, 3) for add in range(0, 20, 4)]
    compare(make, texts)


def test_a_shingle_in_very_many_rows_is_dealt_in_parts(make, monkeypatch):
    monkeypatch.setattr(ngramjoin, "share", lambda total: 20)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    texts = [edited(rng, words, rng.randint(0, 3)) for _ in range(150)] + [edited(rng, words[:30], rng.randint(0, 2)) for _ in range(40)]
    texts += [" ".join(f"u{rng.random()}" for _ in range(20)) for _ in range(30)]
    compare(make, texts)


def test_first_shingles_are_moved_once(make, monkeypatch):
    plans = []

    def stored(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return common.stored(df)

    monkeypatch.setattr(ngramjoin, "stored", stored)
    compare(make, ["one two three four five six seven", "one two three four five six", "alone"])
    assert len(re.findall(r"MapInArrow .*\[token#\d+L, sig#\d+L, n#\d+\]", "\n".join(plans))) == 1


def test_the_tables_documents(spark):
    docs = common.documents(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in docs}
    ids = sorted(texts)
    sizes, root = brute([texts[i] for i in ids])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngramjoin.query(spark, "/root/testdata/sf0.001").collect()}
    assert got == {i: (sizes[k], ids[root[k]]) for k, i in enumerate(ids)}


def test_bitmap_lets_every_wanted_text_through(spark):
    texts = spark.range(20_000).selectExpr("id as doc_id", "xxhash64(id) as key", "cast(id as string) as text")
    found = ngramjoin.maybe_wanted(texts, texts.where("doc_id % 50 = 3").select("key"))
    ids = {r["doc_id"] for r in found.collect()}
    assert set(range(3, 20_000, 50)) <= ids and len(ids) < 420
    assert ngramjoin.maybe_wanted(texts, texts.where("false").select("key")).count() == 0


def test_odd_rows_and_one_of_each_group(make):
    text = "one two three four five six seven"
    docs = make([(5, text), (3, text), (None, text), (7, text + " eight"), (3, text), (8, None), (9, ""), (None, "alone")]).selectExpr("*", "1 as n", "2 as sig", "3 as id", "4 as _copy", "5 as _name", "6 as times", "7 as gone", "8 as `a.b`", "9 as key")
    got = Counter(tuple(r) for r in ngramjoin.link(docs).collect())
    assert got == Counter({(5, 3, 3): 1, (3, 3, 3): 2, (None, 3, 3): 1, (7, 4, 3): 1, (8, 0, 8): 1, (9, 0, 9): 1, (None, 1, None): 1})
    kept = ngramjoin.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "8", "9", "None"]
    assert ngramjoin.link(make([])).count() == 0


def test_one_row_of_each_group_stays(make):
    text, other = "one two three four five six seven eight nine ten", "un deux trois quatre cinq"
    rows = [(4, text), (2, text + " eleven"), (2, text), (None, text), (None, other), (None, other), (6, None), (6, None), (6, "")]
    for loads in (1, 2, 3):
        kept = ngramjoin.keep_first(make(rows * loads)).collect()
        assert Counter((r["doc_id"], r["text"] if r["text"] == other else bool(r["text"])) for r in kept) == Counter({(2, True): 1, (None, other): 1, (6, False): 3 * loads})
    assert ngramjoin.keep_first(make([])).count() == 0


def test_a_table_loaded_twice(spark):
    docs = common.documents(spark, "/root/testdata/sf0.001")
    once = sorted(map(tuple, ngramjoin.keep_first(docs).collect()))
    assert sorted(map(tuple, ngramjoin.keep_first(docs.unionByName(docs)).collect())) == once


def test_a_star_of_very_many_links(spark, monkeypatch):
    monkeypatch.setattr(common, "share", lambda total: 50)
    links = spark.range(1, 2000).selectExpr("id + 10 as a", "5L as b").union(spark.range(3).selectExpr("id + 3000 as a", "2009L as b"))
    got = {r["node"]: r["root"] for r in graph.components(links, "a", "b").collect()}
    assert got == dict.fromkeys([5, *range(11, 2010), *range(3000, 3003)], 5)


def test_components_of_a_long_path(spark):
    links = spark.range(1, 120).selectExpr("id as a", "id - 1 as b").union(spark.range(300, 303).selectExpr("id as a", "299L as b"))
    got = {r["node"]: r["root"] for r in graph.components(links, "a", "b").collect()}
    assert got == {**dict.fromkeys(range(120), 0), **dict.fromkeys(range(299, 303), 299)}
