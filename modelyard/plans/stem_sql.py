"""Stemming as DuckDB SQL, for checks: a chain of CTEs over distinct tokens.

Written from the published steps with string functions and patterns only; it shares the
suffix tables with nothing. ``stems`` maps every token of ``samples`` to its stem.
"""

from __future__ import annotations

# Irregular forms and suffix tables of the algorithm.
IRREGULAR = (
    "sky sky, skies sky, dying die, lying lie, tying tie, news news, innings inning, inning inning, "
    "outings outing, outing outing, cannings canning, canning canning, howe howe, proceed proceed, "
    "exceed exceed, succeed succeed"
)
SECOND = (
    "ational ate, ization ize, iveness ive, fulness ful, ousness ous, tional tion, biliti ble, "
    "entli ent, ousli ous, ation ate, alism al, aliti al, iviti ive, fulli ful, enci ence, anci ance, "
    "izer ize, alli al, ator ate, logi log, bli ble, eli e"
)
THIRD = "icate ic, ative -, alize al, iciti ic, ical ic, ness -, ful -"
FOURTH = "ement, ance, ence, able, ible, ment, ant, ent, ion, ism, ate, iti, ous, ive, ize, al, er, ic, ou"


def _pairs(text: str) -> list[tuple[str, str]]:
    rows = [row.split() for row in text.split(", ")]
    return [(r[0], "" if r[-1] == "-" else r[-1]) for r in rows]


def _shape(word: str) -> str:
    """Vowels as V, consonants as C; a y is a vowel after a consonant."""
    out = f"regexp_replace(regexp_replace({word},'[aeiou]','V','g'),'[^Vy]','C','g')"
    out = f"regexp_replace({out},'^y','C')"
    for _ in range(4):  # each round settles the first open y of a run, then the next
        out = f"replace(replace({out},'Cy','CV'),'Vy','VC')"
    return out


def _count(shape: str) -> str:
    return f"((length({shape})-length(replace({shape},'VC','')))//2)"


def _short(word: str, shape: str) -> str:
    return (
        f"CASE WHEN length({word})=2 THEN {shape}='VC' "
        f"ELSE ends_with({shape},'CVC') AND right({word},1) NOT IN ('w','x','y') END"
    )


def _cut(word: str, n: int) -> str:
    return f"left({word},length({word})-{n})"


def _suffix_step(name: str, source: str, table: list[tuple[str, str]], least: int, rule: str = "true") -> str:
    """Replace the longest suffix of the table if the stem before it measures enough."""
    ordered = sorted(table, key=lambda p: -len(p[0]))
    found = " ".join(f"WHEN ends_with(w,'{s}') THEN '{s}'" for s, _ in ordered)
    new = " ".join(f"WHEN '{s}' THEN '{r}'" for s, r in ordered)
    return f"""{name}_a AS (SELECT tok, w, CASE {found} END AS suf FROM {source}),
{name}_b AS (SELECT *, left(w,length(w)-length(suf)) AS st, CASE WHEN suf='logi' THEN {_cut('w', 3)} ELSE left(w,length(w)-length(suf)) END AS ms FROM {name}_a),
{name}_c AS (SELECT *, {_shape('ms')} AS sh FROM {name}_b),
{name} AS (SELECT tok, CASE WHEN suf IS NOT NULL AND {_count('sh')}>{least} AND ({rule}) THEN st||CASE suf {new} END ELSE w END AS w FROM {name}_c)"""


def stems_cte(tokens: str) -> str:
    """CTEs that end in stems(tok, stem); tokens is a query of distinct tokens."""
    odd = ",".join(f"('{a}','{b}')" for a, b in _pairs(IRREGULAR))
    return f"""odd_words(tok, stem) AS (VALUES {odd}),
s0 AS (SELECT tok, tok AS w FROM ({tokens}) t WHERE length(tok)>3 AND tok NOT IN (SELECT tok FROM odd_words)),
s1 AS (SELECT tok, CASE WHEN ends_with(w,'ies') THEN CASE WHEN length(w)=4 THEN {_cut('w', 1)} ELSE {_cut('w', 2)} END
 WHEN ends_with(w,'sses') THEN {_cut('w', 2)} WHEN ends_with(w,'s') AND NOT ends_with(w,'ss') THEN {_cut('w', 1)} ELSE w END AS w FROM s0),
s2a AS (SELECT *, CASE WHEN ends_with(w,'ed') THEN {_cut('w', 2)} WHEN ends_with(w,'ing') THEN {_cut('w', 3)} END AS st,
 CASE WHEN ends_with(w,'eed') THEN {_cut('w', 3)} END AS ee FROM s1),
s2b AS (SELECT *, {_shape('st')} AS sh, {_shape('ee')} AS she FROM s2a),
s2 AS (SELECT tok, CASE WHEN ends_with(w,'ied') THEN CASE WHEN length(w)=4 THEN {_cut('w', 1)} ELSE {_cut('w', 2)} END
 WHEN ee IS NOT NULL THEN CASE WHEN {_count('she')}>0 THEN {_cut('w', 1)} ELSE w END
 WHEN st IS NULL OR NOT contains(sh,'V') THEN w
 WHEN regexp_matches(st,'(at|bl|iz)$') THEN st||'e'
 WHEN length(st)>1 AND right(st,1)=left(right(st,2),1) AND right(sh,1)='C' THEN CASE WHEN right(st,1) IN ('l','s','z') THEN st ELSE {_cut('st', 1)} END
 WHEN {_count('sh')}=1 AND ({_short('st', 'sh')}) THEN st||'e' ELSE st END AS w FROM s2b),
s3a AS (SELECT *, {_shape(_cut('w', 1))} AS sh FROM s2),
s3 AS (SELECT tok, CASE WHEN ends_with(w,'y') AND length(w)>2 AND right(sh,1)='C' THEN {_cut('w', 1)}||'i' ELSE w END AS w FROM s3a),
s4a AS (SELECT *, {_shape(_cut('w', 4))} AS sh FROM s3),
s4 AS (SELECT tok, CASE WHEN ends_with(w,'alli') AND {_count('sh')}>0 THEN {_cut('w', 2)} ELSE w END AS w FROM s4a),
{_suffix_step('s5', 's4', _pairs(SECOND), 0)},
{_suffix_step('s6', 's5', _pairs(THIRD), 0)},
{_suffix_step('s7', 's6', [(s, '') for s in FOURTH.split(', ')], 1, "suf<>'ion' OR right(st,1) IN ('s','t')")},
s8a AS (SELECT tok, w, {_cut('w', 1)} AS st FROM s7),
s8b AS (SELECT *, {_shape('st')} AS sh FROM s8a),
s8 AS (SELECT tok, CASE WHEN ends_with(w,'e') AND ({_count('sh')}>1 OR {_count('sh')}=1 AND NOT ({_short('st', 'sh')})) THEN st ELSE w END AS w FROM s8b),
s9a AS (SELECT *, {_shape(_cut('w', 1))} AS sh FROM s8),
s9 AS (SELECT tok, CASE WHEN ends_with(w,'ll') AND {_count('sh')}>1 THEN {_cut('w', 1)} ELSE w END AS w FROM s9a),
stems AS (SELECT t.tok, CASE WHEN length(t.tok)<=3 THEN t.tok ELSE coalesce(o.stem, s9.w) END AS stem
 FROM ({tokens}) t LEFT JOIN odd_words o ON o.tok=t.tok LEFT JOIN s9 ON s9.tok=t.tok)"""
