"""The pipeline's stages on the test tables, each against a plain rerun over its own input."""

from __future__ import annotations

import corpus_pipeline
from test_decontam import brute as found_in
from test_ngramjoin import brute as joined
from test_tokens import check_packed

from caretiers.llm import common, lines, quality

SF = "/root/testdata/sf0.001"


def stages(spark, docs, sf_dir=SF):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(common.stored(stage(spark, out[-1], sf_dir)))
    return out


def test_every_stage_on_its_own_input(spark):
    docs, good, lined, single, clean, packed = stages(spark, common.documents(spark, SF))
    for out in (good, lined, single, clean):
        assert out.columns == docs.columns
    kept = {r["doc_id"] for r in quality.measure(docs).where("kept").collect()}
    assert {r["doc_id"] for r in good.collect()} == kept and 0 < len(kept) < docs.count()

    before = {r["doc_id"]: r for r in good.collect()}
    sites, first = {}, {}
    for r in before.values():
        for line in r["text"].split("\n"):
            if len(line.split()) >= lines.MIN_WORDS:
                sites.setdefault(line, set()).add(r["source"])
                first[line] = min(first.get(line, r["doc_id"]), r["doc_id"])
    for r in lined.collect():
        own = before[r["doc_id"]]["text"].split("\n")
        want = [x for x in own if len(sites.get(x, ())) < lines.MIN_SITES or first[x] == r["doc_id"]]
        assert r["text"] == "\n".join(want) and r["n_chars"] == len(r["text"])

    texts = {r["doc_id"]: r["text"] for r in lined.collect()}
    ids = sorted(texts)
    _, root = joined([texts[i] for i in ids])
    assert {r["doc_id"] for r in single.collect()} == {ids[k] for k in root}

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r["doc_id"]: r["text"] for r in clean.collect()}
    for r in single.collect():
        n_words, n_hit, *_ = found_in(r["text"], items)
        assert (left[r["doc_id"]] == r["text"]) == (n_hit == 0)
        assert found_in(left[r["doc_id"]], [])[0] == n_words - n_hit

    rows = clean.orderBy("doc_id").collect()
    number = {r["doc_id"]: k for k, r in enumerate(rows)}
    check_packed([type("Row", (dict,), {})({**r.asDict(), "doc_id": number[r["doc_id"]]}) for r in packed.collect()], [r["text"] for r in rows])
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def test_odd_documents_pass_through(spark, make):
    rows = [(1, None), (2, ""), (None, "one two three four five six seven eight nine ten eleven"), (3, "one two three four five six seven eight nine ten eleven"), (3, "one two three four five six seven eight nine ten eleven"), (4, "w" * 100_000)]
    *_, packed = stages(spark, make(rows).selectExpr("*", "1 as drop", "2 as kept"))
    assert {r["doc_id"] for r in packed.collect()} == {3}
    *_, packed = stages(spark, make([]))
    assert packed.count() == 0


def test_a_table_loaded_twice_is_packed_once(spark):
    docs = common.documents(spark, SF)
    once, twice = stages(spark, docs), stages(spark, docs.unionByName(docs))
    for a, b in zip(once[3:5], twice[3:5], strict=True):  # after the n-gram join
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
