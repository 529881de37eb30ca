"""Removal of boilerplate lines by the number of sites that they appear on.

Every line with a word is hashed. Per hash, HyperLogLog sketches of the sites are merged by
aggregation, partly before the shuffle, so that a line on every page costs one sketch per task. Where
the estimate is within its error of the threshold, the distinct sites are counted exactly. A line on
``MIN_SITES`` sites or more is boilerplate. It stays in the document with the smallest id among those
that hold it, so that no text is lost, and goes from all others. Documents that hold a line are found by
joins in which the rows of a very common line are dealt over many tasks, by how many rows it has.

A null or empty text has no lines; rows whose site is null add no site; rows with equal ids share the
lines to remove; rows without an id count for the sites but keep their text. Documents whose lines all
go stay as rows with an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretiers.llm.common import documents, keep_columns, spread_join, stored

#: Sites from which a line is boilerplate.
MIN_SITES = 10
#: Words that a line must have to be counted. A line without spaces, of any script, is one word.
MIN_WORDS = 1
#: Binary logarithm of the sketch's buckets; the relative standard error is 1.04 / sqrt(2 ** LG_K).
LG_K = 12

ENOUGH_WORDS = r"_l rlike '^[\\x20\\x09-\\x0D]*([^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]+){%d}[^\\x20\\x09-\\x0D]'"


def line_rows(docs: DataFrame, min_words: int) -> DataFrame:
    """A row for each document and distinct line that is long enough: ``id``, ``site``, ``line``."""
    enough = ENOUGH_WORDS % (min_words - 1)
    lines = rf"array_distinct(transform(filter(split(text, '\n'), _l -> {enough}), _l -> xxhash64(_l)))"
    return docs.selectExpr("doc_id as id", "source as site", f"explode({lines}) as line")


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """``line`` (a hash), ``first_id`` and ``n`` (its documents) of the lines on ``min_sites`` sites or more."""
    rows = line_rows(docs, min_words)
    sketches = rows.groupBy("line").agg(
        F.expr(f"hll_sketch_estimate(hll_sketch_agg(site, {LG_K}))").alias("sites"), F.min("id").alias("first_id"), F.count("*").alias("n")
    )
    margin = 1 + 4 * 1.04 * min_sites / 2 ** (LG_K / 2)
    high = stored(sketches.where(f"sites >= {min_sites - margin}"))
    sure = high.where(f"sites > {min_sites + margin}").select("line", "first_id", "n")
    near = high.where(f"sites <= {min_sites + margin}").select("line", "n")
    sites = spread_join(rows, near, "line", "n").select("line", "site").distinct().groupBy("line").agg(F.count("site").alias("exact"))
    exact = high.join(sites.where(f"exact >= {min_sites}").select("line"), "line", "left_semi")
    return stored(sure.unionByName(exact.select("line", "first_id", "n")))


def lines_to_drop(docs: DataFrame, min_sites: int, min_words: int) -> DataFrame:
    """``id`` and the hashes of its lines that go."""
    found = spread_join(line_rows(docs, min_words), boilerplate(docs, min_sites, min_words), "line", "n").where("id <> first_id")
    return found.groupBy("id").agg(F.collect_set("line").alias("drop"))


KEPT = r"array_join(filter(split(d.text, '\n'), _l -> not array_contains(b.drop, xxhash64(_l))), '\n')"


def remove(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` without boilerplate lines; ``n_chars`` follows where it is a column."""
    drop = lines_to_drop(docs, min_sites, min_words)
    both = docs.alias("d").join(drop.alias("b"), F.expr("d.doc_id = b.id"), "left")
    text = f"if(b.drop is null, d.text, {KEPT})"
    changed = {"text": F.expr(text)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.expr(f"if(b.drop is null, d.n_chars, cast(length({KEPT}) as bigint))")
    return both.select(*keep_columns(docs, "d", **changed))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without boilerplate, its lines and how many went."""
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    drop = lines_to_drop(docs, MIN_SITES, MIN_WORDS)
    both = docs.alias("d").join(drop.alias("b"), F.expr("d.doc_id = b.id"), "left")
    return both.select(
        F.col("d.doc_id"),
        F.expr(r"cast(size(split(coalesce(d.text, ''), '\n')) as bigint)").alias("n_lines"),
        F.expr(
            r"cast(if(b.drop is null, 0, size(filter(split(d.text, '\n'), _l -> array_contains(b.drop, xxhash64(_l))))) as bigint)"
        ).alias("n_removed"),
        F.expr(f"if(b.drop is null, coalesce(d.text, ''), {KEPT})").alias("text"),
    )


ORACLE = rf"""
WITH l AS (
  SELECT doc_id, source, i, line,
         len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) >= {MIN_WORDS} AS enough
  FROM (SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
b AS (
  SELECT line, min(doc_id) AS first_id FROM l WHERE enough GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}),
m AS (SELECT l.*, b.line IS NOT NULL AND doc_id <> first_id AS gone FROM l LEFT JOIN b ON l.enough AND l.line = b.line)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
FROM m GROUP BY doc_id
"""
