"""DuckDB SQL of the variants: expressions over a word and a hash, and the fan-outs over rows."""

from __future__ import annotations

from lexiloom.functions import mutation, text
from lexiloom.plans.views import SQL_UNIFIED, TARGETS, sql_clean, sql_hash, sql_number, sql_unit

ASCII = "".join(map(chr, range(0x21, 0x7F)))
FORM = "^([^A-Za-z0-9]*)([A-Za-z0-9]+)([^A-Za-z0-9]*)$"
KNOWN = ", ".join(f"'{t}'" for t in TARGETS)
_SEPS = "[" + ", ".join(f"'{s}'" for s in mutation.SEPARATORS) + "]"


def case(w: str, h: str) -> str:
    digits = f"array_to_string(list_transform(range(0, (length({w}) - 1) // 32 + 1), lambda b: md5({h} || b::VARCHAR)), '')"
    return f"array_to_string(list_transform(string_split({w}, ''), lambda c, i: CASE WHEN substr({digits}, i, 1) < '8' THEN upper(c) ELSE c END), '')"


def _mapped(w: str, h: str, letters: str, forms: str, low: float, high: float) -> str:
    pool = f"string_split(regexp_replace({w}, '[^{letters}]', '', 'g'), '')"
    k = f"greatest(1, round_even(len({pool}) * ({low} + {sql_unit(h, 2)} * ({high} - {low})), 0))::INT"
    hit = f"array_to_string(list_transform(list_sort(list_transform({pool}, lambda c, i: md5({h} || (i - 1)::VARCHAR) || c))[1:{k}], lambda x: substr(x, 33)), '')"
    return f"CASE WHEN NOT regexp_matches({w}, '[{letters}]') THEN {case(w, h)} ELSE translate({w}, {hit}, translate({hit}, '{letters}', '{forms}')) END"


def leet(w: str, h: str) -> str:
    return _mapped(w, h, mutation.LEET_FROM, mutation.LEET_TO, 0.3, 0.8)


def homoglyph(w: str, h: str) -> str:
    return _mapped(w, h, mutation.LOOK_FROM, mutation.LOOK_TO, 0.2, 0.5)


def sep(w: str, h: str) -> str:
    return f"CASE WHEN length({w}) < 4 THEN {case(w, h)} ELSE left({w}, 1) || array_to_string(list_transform(string_split(substr({w}, 2), ''), lambda c: {_SEPS}[{sql_number(h, 3)} % 9 + 1] || c), '') END"


def censor(w: str, h: str) -> str:
    return f"""CASE WHEN length({w}) <= 2 THEN {case(w, h)} WHEN {sql_number(h, 4)} % 3 = 0 THEN left({w}, 1) || repeat('*', length({w}) - 1)
  WHEN {sql_number(h, 4)} % 3 = 1 THEN left({w}, 1) || regexp_replace(substr({w}, 2), '[aeiouy]', '*', 'g') ELSE regexp_replace({w}, '[aeiouy]', ['$', '@', '#'][{sql_number(h, 5)} % 3 + 1], 'g') END"""


def repeat(w: str, h: str) -> str:
    at = f"({sql_number(h, 6)} % greatest(length({w}) - 1, 1) + 2)"
    return f"CASE WHEN length({w}) < 3 THEN {case(w, h)} ELSE left({w}, {at} - 1) || repeat(substr({w}, {at}, 1), {sql_number(h, 7)} % 3 + 2) || substr({w}, {at} + 1) END"


def fullwidth(w: str, h: str = "") -> str:
    return f"translate({w}, '{ASCII.replace(chr(39), chr(39) * 2)}', '{text.wide(ASCII)}')"


def combo(w: str, h: str) -> str:
    return f"CASE WHEN {sql_unit(h, 8)} < 0.5 THEN {censor(f'({leet(w, h)})', h)} ELSE {homoglyph(f'({sep(w, h)})', h)} END"


def word(w: str, h: str) -> str:
    """One of the eight styles, by hash; ``w`` is in lower case."""
    styles = {"leet": leet, "sep": sep, "censor": censor, "repeat": repeat, "case": case, "homoglyph": homoglyph, "fullwidth": fullwidth, "combo": combo}
    return f"CASE {sql_number(h, 9)} % {len(mutation.STYLES)} " + " ".join(f"WHEN {i} THEN {styles[s](w, h)}" for i, s in enumerate(mutation.STYLES)) + " END"


def sentence(t: str, h: str) -> str:
    return f"CASE WHEN {sql_unit(h, 10)} < 0.5 THEN {fullwidth(t)} ELSE {case(t, h)} END"


def stem(w: str) -> str:
    cuts = (f"WHEN length({w}) > {len(s) + 2} AND ends_with({w}, '{s}') AND left({w}, length({w}) - {len(s)}) IN ({KNOWN}) THEN left({w}, length({w}) - {len(s)})" for s in text.SUFFIXES)
    return f"CASE WHEN {w} IN ({KNOWN}) THEN {w} {' '.join(cuts)} END"


def _parts(label: int, p: str) -> str:
    """Rows of one label, their tokens, and the first hits of each, as common table expressions with a prefix."""
    most = 2 if label else 1
    return f"""{p}base AS (SELECT * RENAME (text AS base_text) FROM u WHERE label = {label}),
{p}tok AS (SELECT ord, unnest(s) AS token, generate_subscripts(s, 1) - 1 AS i FROM (SELECT ord, string_split(base_text, ' ') AS s FROM {p}base)),
{p}parts AS (SELECT *, lower(core) AS low FROM (SELECT *, regexp_extract(token, '{FORM}', 1) AS pre, regexp_extract(token, '{FORM}', 2) AS core, regexp_extract(token, '{FORM}', 3) AS post FROM {p}tok)),
{p}hits AS (SELECT * FROM (SELECT *, {stem("low")} AS stem FROM {p}parts WHERE core <> '') WHERE stem IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ord ORDER BY i) <= {most})"""


def _asked(p: str) -> str:
    """Each asked (word, hash) once, with its form, from the prefix's table ``asked``."""
    return f"""{p}forms AS (SELECT w, hw, {word("w", "hw")} AS form FROM (SELECT DISTINCT w, hw FROM {p}asked)),
{p}said AS (SELECT a.ord, a.v, a.i, pre || form || post AS said FROM {p}asked a JOIN {p}forms f ON a.w = f.w AND a.hw = f.hw),
{p}texts AS (SELECT v.ord, v.v, string_agg(coalesce(said, token), ' ' ORDER BY t.i) AS t FROM {p}variants v JOIN {p}tok t ON v.ord = t.ord LEFT JOIN {p}said d ON d.ord = v.ord AND d.v = v.v AND d.i = t.i WHERE v.v > 0 GROUP BY ALL)"""


OFFENSIVE = f"""{_parts(1, "o_")},
o_variants AS (SELECT ord, v, {sql_hash("offensive", "source", "base_text", "v::VARCHAR")} AS h FROM o_base, range(0, 4) t(v)),
o_long AS (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY i) AS k, count(*) OVER (PARTITION BY ord) AS n FROM o_parts WHERE length(core) >= 4 AND ord NOT IN (SELECT ord FROM o_hits)),
o_asked AS (
  SELECT ord, v, i, stem AS w, md5(h || i::VARCHAR) AS hw, pre, substr(core, length(stem) + 1) || post AS post FROM o_variants JOIN o_hits USING (ord) WHERE v > 0
  UNION ALL SELECT ord, v, i, low, h, pre, post FROM o_variants JOIN o_long USING (ord) WHERE v > 0 AND k = {sql_number("h", 11)} % n + 1
), {_asked("o_")},
offensive AS (
  SELECT CASE WHEN v = 0 THEN base_text ELSE {sql_clean(f"CASE WHEN t = base_text AND v % 3 = 0 AND ord NOT IN (SELECT ord FROM o_hits) THEN {sentence('base_text', 'h')} ELSE t END")} END AS text,
    label, source, origin_label, split_origin, ord, base_text, (v > 0)::INT AS mutated, v::INT AS variant
  FROM o_base JOIN o_variants USING (ord) LEFT JOIN o_texts USING (ord, v))"""

CLEAN = f"""{_parts(0, "c_")},
c_variants AS (SELECT ord, 1 AS v, {sql_hash("clean", "source", "base_text")} AS h FROM c_base WHERE ord IN (SELECT ord FROM c_hits)
  AND ord IN (SELECT ord FROM (SELECT ord, row_number() OVER (ORDER BY {sql_hash("clean-variants", "ord::VARCHAR")}, ord) - 1 AS p, count(*) OVER () AS n FROM c_base) WHERE p < floor(n * 0.4))),
c_asked AS (SELECT ord, v, i, stem AS w, md5(h || i::VARCHAR) AS hw, pre, substr(core, length(stem) + 1) || post AS post FROM c_variants JOIN c_hits USING (ord)),
{_asked("c_")},
clean AS (
  SELECT base_text AS text, label, source, origin_label, split_origin, ord, base_text, 0 AS mutated, 0 AS variant FROM c_base
  UNION ALL SELECT {sql_clean("t")}, label, source, origin_label, split_origin, ord, base_text, 1, 1 FROM c_base JOIN c_texts USING (ord))"""

FANOUT_OFFENSIVE = f"WITH u AS ({SQL_UNIFIED}), {OFFENSIVE} SELECT * FROM offensive"
FANOUT_CLEAN = f"WITH u AS ({SQL_UNIFIED}), {CLEAN} SELECT * FROM clean"
MUTATED = f"""WITH u AS ({SQL_UNIFIED}), {OFFENSIVE}, {CLEAN}
SELECT * EXCLUDE class FROM (SELECT *, 0 AS class FROM offensive UNION ALL SELECT *, 1 FROM clean) QUALIFY row_number() OVER (PARTITION BY text ORDER BY class, ord, variant) = 1"""
