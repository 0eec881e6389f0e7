"""DuckDB building blocks of the SQL that the queries are checked against."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

S = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
D = r"\p{Nd}"
TAG = "[REDACTED]"


def blank(t: str) -> str:
    return f"regexp_full_match({t}, '(?s){S}*')"



def _ranges(cps: list[int]) -> str:
    """The body of a character class, as ranges of code points."""
    runs, at = [], 0
    while at < len(cps):
        to = at
        while to + 1 < len(cps) and cps[to + 1] == cps[to] + 1:
            to += 1
        runs.append(f"\\x{{{cps[at]:x}}}-\\x{{{cps[to]:x}}}")
        at = to + 1
    return "".join(runs)


# Letters and digits beyond ASCII; a combining mark is none.
_WORDS = f"[{_ranges([c for c in range(0x80, 0x110000) if chr(c).isalnum()])}]"


def mapped(t: str, space: str = " ") -> str:
    """Beyond ASCII: spaces as ``space``, word characters as ``_``, the rest as ``~``; lengths stay."""
    spaces = r"[\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    return f"regexp_replace(regexp_replace(regexp_replace({t}, '{spaces}', '{space}', 'g'), '{_WORDS}', '_', 'g'), '[^\\x00-\\x7f]', '~', 'g')"


#: label, order of emission, pattern with the match as group 1 and what it looks ahead to as group 2, on mapped text?
RULES = {
    "R1": ("PERSON", 0, rf"(\b[A-Z][a-z]+(?:{S}+[A-Z][a-z]+){{1,2}}\b)()", True),
    "R2": ("DATE", 1, rf"((?:0?[1-9]|1[0-2])[-/](?:0?[1-9]|[12]{D}|3[01])[-/](?:(?:19|20){D}{{2}}|{D}{{2}}))()", False),
    "R3": ("SSN", 2, rf"({D}{{3}}-{D}{{2}}-{D}{{4}})()", False),
    "R4": (
        "PHONE", 3,
        rf"((?:\+?1(?:[-.]|{S})?)?(?:\({D}{{3}}\)|{D}{{3}})(?:[-.]|{S})?{D}{{3}}(?:[-.]|{S})?{D}{{4}})([^0-9]|$)", False,
    ),
    "R5": ("EMAIL", 4, r"([A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,})([^a-zA-Z0-9._%+\-]|$)", False),
    "R6": ("MRN", 5, rf"(MRN{S}*{D}{{5,}}|{D}{{7,}})()", False),
    "R7": (
        "ADDRESS", 6,
        rf"({D}{{1,5}}{S}+(?:[A-Za-z0-9]+{S}?){{2,8}}(?:,{S}?)?[A-Za-z]+(?:[ -][A-Za-z]+)*(?:,{S}?)?[A-Z]{{2}}(?:,?{S}?{D}{{5}})?)()", False,
    ),
    "R8": (
        "PERSON", 7,
        rf"(\b(?:DWR|DWA|MD|Dr\.?){S}+[A-Z][a-z]+{S}+(?:DWR|DWA|MD|Dr\.?|[A-Z]{{2,4}})\b)()", True,
    ),
}
#: Terms of a list, as a rule of its own.
LISTED = {"L1": ("DRUG", 0, r"(\b(?:insulin glargine|metformin|apixaban|insulin)\b)()", "~")}
_LEAD = rf"^(?:DWR|DWA|MD|Dr\.?){S}+"


def spans(source: str, rule: str, names: str | None = None) -> str:
    """SELECT id, start, end, label, ord of one rule over ``source`` (id, text)."""
    label, order, pattern, on_mapped = (RULES | LISTED)[rule]
    t = mapped("text", "~" if on_mapped == "~" else " ") if on_mapped else "text"
    sizes = lambda lst: f"coalesce(list_sum(list_transform({lst}, lambda z: length(z))), 0)"
    sql = f"""SELECT id, CAST({sizes('g[1:i]')} + {sizes('m[1:i-1]')} + {sizes('k[1:i-1]')} AS INT) AS start, m[i] AS hit FROM (
      SELECT id, m, k, g, unnest(generate_series(1, len(m))) AS i FROM (
        SELECT id, regexp_extract_all(t, '{pattern}', 1) AS m, regexp_extract_all(t, '{pattern}', 2) AS k, string_split_regex(t, '{pattern}') AS g
        FROM (SELECT id, {t} AS t FROM {source})))"""
    if rule == "R8":
        lead = f"length(regexp_extract(hit, '{_LEAD}'))"
        sql = f"SELECT id, CAST(start + {lead} AS INT) AS start, regexp_extract(substr(hit, {lead} + 1), '^[A-Z][a-z]+') AS hit FROM ({sql})"
    where = f"WHERE list_has_any(regexp_extract_all(hit, '[A-Za-z]+'), ({names}))" if names and label == "PERSON" else ""
    return f"SELECT id, start, CAST(start + length(hit) AS INT) AS \"end\", '{label}' AS label, {order} AS ord FROM ({sql}) {where}"


def tag_ranges(source: str) -> str:
    return f"""SELECT id, CAST(coalesce(list_sum(list_transform(g[1:i], lambda z: length(z))), 0) + {len(TAG)} * (i - 1) AS INT) AS a FROM (
      SELECT id, g, unnest(generate_series(1, len(g) - 1)) AS i FROM (SELECT id, string_split(text, '{TAG}') AS g FROM {source}))"""


def merge(source: str) -> str:
    """Islands of strictly overlapping spans; source: id, start, end, label, ord."""
    return f"""SELECT id, min(start) AS start, max("end") AS "end", arg_min(label, CAST(start AS BIGINT) * 1000000 + ord) AS label FROM (
      SELECT *, sum(CASE WHEN before IS NULL OR start >= before THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY start, ord ROWS UNBOUNDED PRECEDING) AS island FROM (
        SELECT *, max("end") OVER (PARTITION BY id ORDER BY start, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM {source})) GROUP BY id, island"""


def mask(texts: str, merged: str, mask: str = f"'{TAG}'") -> str:
    """SELECT id, masked of the rows with spans; ``mask`` may use ``label``."""
    return f"""SELECT s.id, string_agg(substr(t.text, s.before + 1, s.start - s.before) || {mask}, '' ORDER BY s.start) || substr(any_value(t.text), max(s."end") + 1) AS masked
      FROM (SELECT *, coalesce(lag("end") OVER (PARTITION BY id ORDER BY start), 0) AS before FROM {merged}) s JOIN {texts} t ON t.id = s.id GROUP BY s.id"""


def collapse(text: str) -> str:
    return rf"regexp_replace({text}, '\[REDACTED\](?:{S}*\[REDACTED\])+', '{TAG}', 'g')"


@lru_cache(1)
def _compatible() -> tuple[str, str]:
    """A map from each character with a compatibility decomposition to it, and a class of all that may change."""
    changing = [c for c in range(0x80, 0x110000) if not 0xAC00 <= c <= 0xD7A3 and not 0xD800 <= c <= 0xDFFF and not unicodedata.is_normalized("NFKC", chr(c))]
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))) for c in changing]
    pairs = [(a, b) for a, b in pairs if unicodedata.normalize("NFD", a) != b]
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    keys, values = (", ".join(quoted(p[k]) for p in pairs) for k in (0, 1))
    return f"MAP([{keys}], [{values}])", f"[{_ranges(changing)}\\p{{M}}\\x{{1160}}-\\x{{11ff}}]"


def normalised(source: str, n: int) -> list[str]:
    """CTEs on{n} (id, text): the compatibility form, and u{n}: for its changed texts where each character cluster came from."""
    table, changing = _compatible()
    decomposed = "array_to_string(list_transform(string_split(c, ''), lambda z: coalesce(w.m[z], z)), '')"
    return [
        f"w{n} AS MATERIALIZED (SELECT {table} AS m)",
        f"""c{n} AS MATERIALIZED (SELECT id, cs, list_transform(cs, lambda c: CASE WHEN regexp_matches(c, '{changing}') THEN nfc_normalize({decomposed}) ELSE c END) AS ns
           FROM (SELECT id, regexp_extract_all(text, '(?s).\\p{{M}}*') AS cs FROM {source} WHERE regexp_matches(text, '{changing}')), w{n} w)""",
        f"""u{n} AS MATERIALIZED (SELECT *, sum(rl) OVER r - rl AS rs, sum(nl) OVER r - nl AS ns FROM (
             SELECT id, i, cs[i] = ns[i] AS same, length(cs[i]) AS rl, length(ns[i]) AS nl FROM (SELECT id, cs, ns, unnest(generate_series(1, len(cs))) AS i FROM c{n}))
           WINDOW r AS (PARTITION BY id ORDER BY i ROWS UNBOUNDED PRECEDING))""",
        f"on{n} AS (SELECT t.id, coalesce(array_to_string(c.ns, ''), t.text) AS text FROM {source} t LEFT JOIN c{n} c ON c.id = t.id)",
    ]


def stored(source: str, n: int) -> str:
    """Spans of the compatibility form as spans of the stored text."""
    at = lambda side, p: f"{side}.id = o.id AND {side}.ns <= {p} AND {p} < {side}.ns + {side}.nl"
    return f"""SELECT o.id, CAST(coalesce(CASE WHEN a.same THEN a.rs + o.start - a.ns ELSE a.rs END, o.start) AS INT) AS start,
        CAST(coalesce(CASE WHEN b.same THEN b.rs + o."end" - b.ns ELSE b.rs + b.rl END, o."end") AS INT) AS "end", o.label, o.ord
      FROM {source} o LEFT JOIN u{n} a ON {at('a', 'o.start')} LEFT JOIN u{n} b ON {at('b', '(o."end" - 1)')}"""


def redaction(
    base: str, passes: int = 2, rules: tuple[str, ...] = tuple(RULES), names: str | None = None, dry: bool = False, normalize: bool = True
) -> str:
    """CTEs t0, t1, ... (id, text) and g1, g2, ... (merged spans) of chained passes over ``base`` (id, text)."""
    out = [f"t0 AS (SELECT id, text FROM ({base}) WHERE text IS NOT NULL AND NOT {blank('text')})"]
    for n in range(1, passes + 1):
        prev = f"t{n - 1}"
        on = f"on{n}" if normalize else prev
        union = " UNION ALL ".join(spans(on, r, names) for r in rules)
        out += [
            *(normalised(prev, n) if normalize else ()),
            f"s{n} AS ({union})",
            f"k{n} AS ({tag_ranges(on)})",
            f"""o{n} AS (SELECT s.* FROM s{n} s WHERE NOT EXISTS (SELECT 1 FROM k{n} k WHERE k.id = s.id AND s.start < k.a + {len(TAG)} AND s."end" > k.a))""",
            f"b{n} AS ({stored(f'o{n}', n) if normalize else f'SELECT * FROM o{n}'})",
            f"""f{n} AS (SELECT o.* FROM b{n} o JOIN {prev} t ON t.id = o.id WHERE NOT (
                upper(substr(t.text, o.start + 1, o."end" - o.start)) = substr(t.text, o.start + 1, o."end" - o.start)
                AND lower(substr(t.text, o.start + 1, o."end" - o.start)) <> substr(t.text, o.start + 1, o."end" - o.start)
                AND NOT contains(lower(o.label), 'person') AND NOT contains(lower(o.label), 'address')))""",
            f"g{n} AS ({merge(f'f{n}')})",
        ]
        text = "t.text" if dry else f"coalesce({collapse('m.masked')}, t.text)"
        out += [f"m{n} AS ({mask(prev, f'g{n}')})", f"t{n} AS (SELECT t.id, {text} AS text FROM {prev} t LEFT JOIN m{n} m ON m.id = t.id)"]
    return ",\n".join(out)
