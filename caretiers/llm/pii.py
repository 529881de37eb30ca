r"""Personal data: patterns propose spans, checksums confirm them, words before them adjust a score.

Base kinds (``email``, ``ip``, ``card``, ``phone``) are found leftmost and non-overlapping per kind;
matches that fail their check (parts over 255, digit count, Luhn) go, and the rest always stay.
Further kinds start from a score that nearby words raise, and stay from ``KEEP`` on:

* ``iban``: country, check digits, and as many characters as the country's have, so that a word that follows is
  not taken in; other countries' in groups. mod-97 must be 1, which is proof enough.
* ``ssn``: ``ddd-dd-dddd``, kept beside words such as "social security".
* ``secret``: a run of 16 or more letters, digits, ``_``, ``-``, ``/`` and ``+``, of any length, that has a letter
  and a digit, kept beside words such as "password".

Everything stays in one row: no shuffle, no Python. The patterns neither backtrack beyond a run of
characters nor recurse, so time is linear in the text. Positions are code points, ends exclusive.
A null text has no spans; repeated rows are judged one by one; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caretiers.llm.common import documents, let

#: Score from which a span of a further kind stays.
KEEP = 0.5
#: Characters before a span in which words count as near.
NEAR = 40
#: Spans per block of the running sum of positions.
BLOCK = 256

# Octet and digit patterns of the base kinds.
OCTET = "0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
LOCAL = "[A-Za-z0-9._%+-]"

# Lengths of IBANs and the countries that have them.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def iban_pattern() -> str:
    """An IBAN of each length in groups of four, or of any country."""

    def groups(size: int) -> str:
        rest = f"(?: ?[A-Z0-9]{{{size % 4}}})" if size % 4 else ""
        return f"(?: ?[A-Z0-9]{{4}}){{{size // 4}}}{rest}"

    known = [f"(?:{countries.replace(' ', '|')})[0-9]{{2}}{groups(length - 4)}" for length, countries in IBAN_LENGTHS.items()]
    return "|".join([*known, "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"])


#: kind -> (what the text must hold, pattern). ``\G`` lets a match start where the last one ended.
PATTERNS = {
    "email": ("instr({t}, '@') > 0", rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": ("{d}", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": ("{d}", r"[0-9](?:[ -]?[0-9])++"),
    "phone": ("instr({t}, '+') > 0", r"\+[0-9][ ().0-9-]+[0-9]"),
    "iban": ("{d}", iban_pattern()),
    "ssn": ("{d}", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "secret": ("{d}", r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{16,}+"),
}
BASE = ("email", "ip", "card", "phone")
#: kind -> (score without context, gain beside one of the words, the words).
CONTEXT = {
    "iban": (0.6, 0.3, "iban|account|konto|compte|cuenta|bank"),
    "ssn": (0.3, 0.4, "ssn|social security|tax|sozialversicherung|seguridad social"),
    "secret": (0.2, 0.4, "password|passwd|pwd|token|secret|api.?key|access.?key|credential"),
}


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def luhn(digits: str) -> str:
    double = f"cast(substr({digits}, length({digits}) - _i, 1) as int) * (1 + _i % 2)"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (_a, _i) -> _a + {double} - if({double} > 9, 9, 0)) % 10 = 0"


def mod97(value: str) -> str:
    """Whether an IBAN's digits, the first four moved to the end and letters as 10 to 35, are 1 modulo 97."""
    turned = f"split(concat(substr(replace({value}, ' ', ''), 5), substr({value}, 1, 4)), '')"
    step = "if(_c between '0' and '9', (_a * 10 + ascii(_c) - 48) % 97, (_a * 100 + ascii(_c) - 55) % 97)"
    return f"aggregate(filter({turned}, _c -> _c <> ''), 0, (_a, _c) -> {step}) = 1"


def valid(kind: str, v: str) -> str:
    digits = rf"regexp_replace({v}, '[^0-9]', '')"
    if kind == "ip":
        return f"{v} rlike {quoted(rf'^{OCTET}([.]{OCTET}){{3}}$')}"
    if kind == "card":
        return let(digits, "_d", f"case when length(_d) between 12 and 19 then {luhn('_d')} else false end")
    if kind == "phone":
        return f"length({digits}) between 9 and 15"
    if kind == "iban":
        return f"case when length(replace({v}, ' ', '')) between 15 and 34 then {mod97(v)} else false end"
    if kind == "secret":
        return f"{v} rlike '[0-9]' and {v} rlike '[A-Za-z]'"
    return "true"


def scored(kind: str, before: str) -> str:
    """Whether a proposed span stays, given the text before it."""
    if kind in BASE:
        return "true"
    score, gain, near = CONTEXT[kind]
    prefix = "0.6" if kind == "secret" else "0"
    known = f"if(_x.v rlike '(^|[^A-Za-z0-9])(AKIA|ASIA)[A-Z0-9]{{16}}($|[^A-Za-z0-9])', {prefix}, 0)" if kind == "secret" else "0"
    return f"{score} + if(lower(right({before}, {NEAR})) rlike {quoted(near)}, {gain}, 0) + {known} >= {KEEP}"


SPAN = "struct<s: int, e: int, v: string, b: string>"


def spans(kind: str, t: str, has_digit: str) -> str:
    """SQL text: the array of this kind's spans (start, order of kind, end, kind) in ``t``.

    Starts are running sums of the lengths of what stands between the matches and of the matches,
    summed in blocks, so that long lists cost no more than their length times the block's.
    """
    condition, pattern = PATTERNS[kind]
    none = "cast(array() as array<struct<s: int, o: int, e: int, kind: string>>)"
    parts = "zip_with(_m, slice(split({t}, {p}, -1), 1, size(_m)), (_v, _g) -> struct(_v as v, _g as g))".format(t=t, p=quoted(pattern))
    step = "struct(_a.p + length(_q.g) + length(_q.v) as p, concat(_a.o, array(struct(_a.p + length(_q.g) as s, _a.p + length(_q.g) + length(_q.v) as e, _q.v as v, _q.g as b))) as o)"
    zero = f"cast(struct(0 as p, array() as o) as struct<p: int, o: array<{SPAN}>>)"
    blocks = f"transform(sequence(0, (size(_ps) - 1) div {BLOCK}), _n -> aggregate(slice(_ps, cast(_n * {BLOCK} + 1 as int), {BLOCK}), {zero}, (_a, _q) -> {step}))"
    bases = "aggregate(_bs, cast(struct(0 as p, array() as o) as struct<p: int, o: array<int>>), (_a, _q) -> struct(_a.p + _q.p as p, concat(_a.o, array(_a.p)) as o)).o"
    placed = f"flatten(zip_with(_bs, {bases}, (_q, _base) -> transform(_q.o, _x -> struct(_base + _x.s as s, _base + _x.e as e, _x.v as v, _x.b as b))))"
    ok = f"filter({let(blocks, '_bs', placed)}, _x -> {valid(kind, '_x.v')} and {scored(kind, '_x.b')})"
    order = list(PATTERNS).index(kind)
    out = f"transform({let(parts, '_ps', ok)}, _x -> struct(_x.s as s, {order} as o, _x.e as e, '{kind}' as kind))"
    found = let(f"regexp_extract_all({t}, {quoted(pattern)}, 0)", "_m", f"if(size(_m) = 0, {none}, {out})")
    return f"if({condition.format(t=t, d=has_digit)}, {found}, {none})"


def joined(array: str) -> str:
    return f"array_join(transform(sort_array({array}), _x -> concat(_x.kind, ':', _x.s, ':', _x.e)), ',')"


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts and spans of the base kinds, and all spans as ``kind:start:end`` joined by commas."""
    text = docs.selectExpr("doc_id", "coalesce(text, '') as text").selectExpr("doc_id", "text", "text rlike '[0-9]' as digits")
    found = text.selectExpr("doc_id", *(f"{spans(k, 'text', 'digits')} as {k}" for k in PATTERNS))
    base = f"concat({', '.join(BASE)})"
    return found.selectExpr(
        "doc_id",
        *(f"cast(size({k}) as bigint) as n_{k}" for k in BASE),
        f"sha2({joined(base)}, 256) as base_sha256",
        f"{joined(f'concat({", ".join(PATTERNS)})')} as spans",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(documents(spark, sf_dir))


# A run of letters and digits, or of digits and hyphens, stands for the patterns with boundaries, which this SQL's
# engine lacks.
ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k(kind, o, re) AS (VALUES
  ('email', 0, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'),
  ('ip', 1, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
  ('card', 2, '[0-9]([\x20-]?[0-9])+'),
  ('phone', 3, '\+[0-9][\x20().0-9-]+[0-9]'),
  ('iban', 4, '{iban_pattern()}'),
  ('ssn', 5, '[0-9-]+'),
  ('secret', 6, '[A-Za-z0-9_/+-]+')),
f AS (SELECT doc_id, t, kind, o, regexp_extract_all(t, re) AS m, list_transform(string_split_regex(t, re), lambda x: length(x)) AS g FROM d, k),
r AS (
  SELECT doc_id, t, kind, o, unnest(m) AS v, unnest(list_transform(range(1, len(m) + 1), lambda i:
           list_sum(g[1 : i]) + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: length(x))), 0))) AS s
  FROM f WHERE len(m) > 0),
proposed AS (
  SELECT doc_id, t, kind, o, v, s::BIGINT AS s, (s + length(v))::BIGINT AS e, regexp_replace(v, '[^0-9]', '', 'g') AS digits
  FROM r WHERE (kind <> 'ssn' OR regexp_full_match(v, '[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}'))
           AND (kind <> 'secret' OR length(v) >= 16)),
near AS (
  SELECT *, lower(right(t[coalesce(lag(e) OVER (PARTITION BY doc_id, kind ORDER BY s), 0) + 1 : s], 40)) AS before FROM proposed),
found AS (
  SELECT doc_id, kind, o, s, e FROM near
  WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN len(list_filter(string_split(v, '.'), lambda x: coalesce(try_cast(x AS HUGEINT), 256) > 255)) = 0
    WHEN 'card' THEN length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda i:
      digits[length(digits) + 1 - i]::INT * (2 - i % 2) - CASE WHEN digits[length(digits) + 1 - i]::INT * (2 - i % 2) > 9 THEN 9 ELSE 0 END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
    WHEN 'iban' THEN length(replace(v, ' ', '')) BETWEEN 15 AND 34 AND list_reduce(
      list_prepend(0, list_transform(string_split(replace(v, ' ', '')[5:] || v[1:4], ''), lambda c: ascii(c) - CASE WHEN c BETWEEN '0' AND '9' THEN 48 ELSE 55 END)),
      lambda a, x: (a * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97) = 1
    WHEN 'ssn' THEN regexp_matches(before, 'ssn|social security|tax|sozialversicherung|seguridad social')
    ELSE regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND (regexp_matches(v, '(^|[^A-Za-z0-9])(AKIA|ASIA)[A-Z0-9]{{16}}($|[^A-Za-z0-9])')
      OR regexp_matches(before, 'password|passwd|pwd|token|secret|api.?key|access.?key|credential')) END)
SELECT d.doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip, count(*) FILTER (kind = 'card') AS n_card,
       count(*) FILTER (kind = 'phone') AS n_phone,
       sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER (o < 4), '')) AS base_sha256,
       coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o), '') AS spans
FROM d LEFT JOIN found USING (doc_id) GROUP BY d.doc_id
"""
