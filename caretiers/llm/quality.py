"""Quality rules as a short-circuit cascade.

Each rule is an SQL predicate over one text. The cascade estimates on a sample what a rule costs and
how much it rejects, puts the rules with most rejection per cost first, and stops at the first rule
that a text breaks. The order changes the time, never the verdict, which is "breaks no rule".

Everything stays in one row: no shuffle, no Python. A null text counts as empty and has no words, so
it fails ``min_words``; repeated rows are judged one by one; other columns are not looked at.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from caretiers.llm.common import documents, let, words

#: Rows of the sample that costs and selectivities are estimated on. They set the order only.
SAMPLE_ROWS = 400

SYMBOLS = r"(length({t}) - length(translate({t}, '#*$%&|<>', '')))"
LETTERS = r"length(regexp_replace({t}, '[^\\p{{L}}]+', ''))"
CAPITALS = r"length(regexp_replace({t}, '[^\\p{{Lu}}]+', ''))"
EXCLAMATIONS = r"(length({t}) - length(translate({t}, '!', '')))"
LINES = r"filter(split({t}, '\n'), _l -> btrim(_l, ' \t\u000B\u000C\r') <> '')"


def word_chars(text: str) -> str:
    return rf"length(regexp_replace({text}, '[\\x20\\x09-\\x0D]+', ''))"


def dup_lines(text: str) -> str:
    """Lines with a word that equal an earlier line."""
    return let(LINES.format(t=text), "_ls", "size(_ls) - size(array_distinct(_ls))")


def repeat_words(w: str) -> str:
    """Words inside a five-word window that occurs twice or more, the first time included.

    Hashes tell cheaply that a text has no repeated window. Otherwise windows are compared as text:
    sorted, equal neighbours flagged, and the flagged starts turned into covered words.
    """
    hashes = f"transform(slice({w}, 1, size({w}) - 4), (_x, _i) -> xxhash64(_x, {w}[_i + 1], {w}[_i + 2], {w}[_i + 3], {w}[_i + 4]))"
    windows = f"sort_array(transform(slice({w}, 1, size({w}) - 4), (_x, _i) -> struct(concat_ws(' ', slice({w}, _i + 1, 5)) as g, _i as p)))"
    twice = "coalesce(get(_s, _k - 1).g = _y.g, false) or coalesce(get(_s, _k + 1).g = _y.g, false)"
    starts = let(windows, "_s", f"sort_array(filter(transform(_s, (_y, _k) -> if({twice}, _y.p, -1)), _p -> _p >= 0))")
    covered = let(starts, "_ps", "aggregate(zip_with(_ps, slice(_ps, 2, size(_ps)), (_a, _b) -> least(5, _b - _a)), 0, (_n, _c) -> _n + _c)")
    unique = let(hashes, "_h", "size(array_distinct(_h)) = size(_h)")
    return f"(case when size({w}) < 6 then 0 when {unique} then 0 else {covered} end)"


def rules(t: str, w: str) -> dict[str, str]:
    """What a kept text must satisfy, as SQL text over the text ``t`` and its words ``w``."""
    n = f"size({w})"
    return {
        "min_words": f"{n} >= 10",
        "repeats": f"100 * {repeat_words(w)} <= 20 * {n}",
        "symbols": f"10 * {SYMBOLS.format(t=t)} <= 4 * {n}",
        "capitals": f"10 * {CAPITALS.format(t=t)} <= 6 * {LETTERS.format(t=t)}",
        "exclamations": f"10 * {EXCLAMATIONS.format(t=t)} <= 4 * {n}",
        "word_length": f"{word_chars(t)} between 2 * {n} and 25 * {n}",
        "line_copies": f"100 * {dup_lines(t)} <= 60 * greatest(size({LINES.format(t=t)}), 5)",
    }


#: The rules that ``base_failed`` stands for.
BASE = ("min_words", "repeats")
TEXT = "coalesce(text, '')"


def rule_order(docs: DataFrame, names: list[str] | None = None, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by rejections per second on the first ``sample_rows`` rows, best first."""
    sample = docs.select("text").limit(sample_rows).persist()
    try:
        total = sample.count()
        scores = []
        for name in names or list(rules("", "")):
            test = let(words(TEXT), "_w", rules(TEXT, "_w")[name])
            start = time.perf_counter()
            rejected = sample.selectExpr(f"count_if(not {test}) as n").first()["n"]
            cost = time.perf_counter() - start
            scores.append((-(rejected + 0.5) / (total + 1) / cost, name))
    finally:
        sample.unpersist()
    return [name for _, name in sorted(scores)]


def cascade(order: list[str], t: str, w: str) -> str:
    """SQL text: true if no rule is broken; later rules are not evaluated after a broken one."""
    tests = rules(t, w)
    return "case " + " ".join(f"when not ({tests[name]}) then false" for name in order) + " else true end"


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text breaks no rule, columns unchanged."""
    return docs.where(let(words(TEXT), "_w", cascade(rule_order(docs), TEXT, "_w")))


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` with the base measures, ``base_failed`` and the cascade's verdict ``kept``."""
    order = rule_order(docs, [n for n in rules("", "") if n not in BASE])
    return (
        docs.selectExpr("doc_id", f"{TEXT} as text")
        .selectExpr("doc_id", "text", f"{words('text')} as words")
        .selectExpr(
            "doc_id",
            "text",
            "words",
            f"cast({word_chars('text')} as bigint) as word_chars",
            f"cast({SYMBOLS.format(t='text')} as bigint) as n_symbols",
            f"cast({dup_lines('text')} as bigint) as n_dup_lines",
            f"cast({repeat_words('words')} as bigint) as n_repeat_words",
        )
        .selectExpr(
            "doc_id",
            "cast(size(words) as bigint) as n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "size(words) < 10 or 100 * n_repeat_words > 20 * size(words) as base_failed",
            f"case when size(words) < 10 or 100 * n_repeat_words > 20 * size(words) then false else {cascade(order, 'text', 'words')} end as kept",
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure(documents(spark, sf_dir))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (
  SELECT doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
g AS (SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS g FROM s, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i)),
twice AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, (SELECT unnest(range(0, 5)) AS o) GROUP BY doc_id),
m AS (
  SELECT doc_id, t, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM s LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 10 * n_symbols <= 4 * n_words
       AND 10 * length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) <= 6 * length(regexp_replace(t, '[^\p{L}]+', '', 'g'))
       AND 10 * (length(t) - length(replace(t, '!', ''))) <= 4 * n_words
       AND word_chars BETWEEN 2 * n_words AND 25 * n_words
       AND 100 * n_dup_lines <= 60 * greatest(n_lines, 5) AS kept
FROM b
"""
