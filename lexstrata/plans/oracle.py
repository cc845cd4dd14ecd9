"""DuckDB statements of the structuring rules, written on their own as a chain of CTEs."""

from __future__ import annotations

from ..functions import patterns as P
from .synthetic import SQL_LEGAL

WORD = "0-9A-Za-zÀ-ÿ_"


def re2(pattern: str) -> str:
    """A Java pattern for RE2, as a SQL literal: Unicode flags go, word classes are spelled out."""
    for java, plain in (("(?iuUs)", "(?is)"), ("(?iuU)", "(?i)"), ("(?iu)", "(?i)"), ("(?Us)", "(?s)"), ("(?U)", "")):
        pattern = pattern.replace(java, plain)
    if pattern.endswith(r"\b"):
        pattern = pattern[:-2] + rf"(?:$|[^{WORD}])"
    pattern = pattern.replace(r"\b", rf"(?:^|[^{WORD}])").replace(r"[\w\-]", rf"[{WORD}\-]").replace(r"\p{IsUppercase}", r"\p{Lu}")
    return "'" + pattern.replace("'", "''") + "'"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def has(x: str, p: str) -> str:
    return f"regexp_matches({x}, {re2(p)})"


def get(x: str, p: str, n: int) -> str:
    return f"regexp_extract({x}, {re2(p)}, {n})"


def no_lower(x: str) -> str:
    return rf"NOT regexp_matches({x}, '\p{{Ll}}')"


ROMAN_FORM = "'^(XL|L?X{0,3})(IX|IV|V?I{0,3})$'"
_p = P.COMPAT
PART = f"({has('x', _p.part)} AND NOT ({strip(get('x', _p.part, 2))} <> '' AND {has(strip(get('x', _p.part, 2)), _p.prose)}))"
ROMAN = f"({has('x', _p.roman)} AND {get('x', _p.roman, 1)} <> '' AND regexp_matches({get('x', _p.roman, 1)}, {ROMAN_FORM}))"
NAME = (
    rf"(x <> '' AND length(x) <= 100 AND NOT regexp_matches(x, '^\d') AND NOT {has('x', _p.article)} AND NOT {PART} AND NOT {has('x', _p.ordinal_article)} "
    f"AND NOT {has('x', _p.transitory)} AND NOT {ROMAN} AND (({no_lower('x')} AND regexp_matches(x, '[A-ZÁÉÍÓÚÑ]{{3,}}')) OR ({has('x', _p.name)} AND length(x) < 80)))"
)
# the heading word ends where no letter follows; RE2 has no look-ahead, so the head is cut by its own pattern
_HEAD = "regexp_extract(x0, '(?i)^(Transitorios?)', 1)"

_KINDS = f"""
cut AS (SELECT doc_id, line_no, {strip('text')} AS x0 FROM legal),
heads AS (SELECT *, {has('x0', _p.transitory)} AND NOT starts_with(x0, '>') AND NOT starts_with(x0, '|') AS opens, {strip(f"substr(x0, length({_HEAD}) + 1)")} AS rest FROM cut),
parts AS (
  SELECT doc_id, line_no, 0 AS sub_no, CASE WHEN opens AND rest <> '' THEN {_HEAD} ELSE x0 END AS x FROM heads
  UNION ALL SELECT doc_id, line_no, 1, rest FROM heads WHERE opens AND rest <> ''),
shapes AS (SELECT *, CASE
  WHEN sub_no = 0 AND x = '' THEN 'blank' WHEN sub_no = 0 AND starts_with(x, '>') THEN 'quote' WHEN sub_no = 0 AND starts_with(x, '|') THEN 'table'
  WHEN sub_no = 0 AND {has('x', _p.transitory)} THEN 'transitory' WHEN {has('x', _p.ordinal_article)} THEN 'ordinal_article'
  WHEN {has('x', _p.article)} THEN 'article' WHEN {PART} THEN 'part' ELSE 'text' END AS shape FROM parts),
cutup AS (SELECT *, CASE shape
    WHEN 'ordinal_article' THEN regexp_replace({strip(get('x', _p.ordinal_article, 1))}, '\\.+$', '')
    WHEN 'article' THEN regexp_replace({strip(get('x', _p.article_split, 1))}, '\\.+$', '')
    WHEN 'part' THEN {strip(get('x', _p.part, 1))}
    WHEN 'transitory' THEN regexp_extract(x, '(?i)^(Transitorios?)', 1) END AS heading,
  CASE shape
    WHEN 'ordinal_article' THEN {strip(f"regexp_replace({strip(get('x', _p.ordinal_article, 2))}, '^[.-]+', '')")}
    WHEN 'article' THEN {strip(get('x', _p.article_split, 2))}
    WHEN 'part' THEN {strip(get('x', _p.part, 2))} ELSE '' END AS body,
  {has('x', _p.transitory_ordinal)} AS is_ordinal, sub_no = 0 AND {NAME} AS is_name FROM shapes),
named AS (SELECT *, coalesce(lag(shape) OVER w = 'part' AND lag(body) OVER w = '', false) AND is_name AND shape NOT IN ('blank', 'quote', 'table') AS named
  FROM cutup WINDOW w AS (PARTITION BY doc_id ORDER BY line_no, sub_no)),
said AS (SELECT *, CASE WHEN named THEN '' WHEN shape IN ('article', 'ordinal_article') THEN body WHEN shape = 'text' THEN x ELSE '' END AS said FROM named),
tails AS (SELECT *, CASE WHEN coalesce(lag(said) OVER w, '') LIKE '%-' AND shape = 'text' AND NOT is_ordinal THEN regexp_replace(lag(said) OVER w, '-$', '') || said ELSE said END AS tail
  FROM said WINDOW w AS (PARTITION BY doc_id ORDER BY line_no, sub_no)),
guards AS (SELECT *, shape IN ('article', 'ordinal_article') AND NOT named AND coalesce(lag(said) OVER w <> '' AND {has('lag(tail) OVER w', _p.connector)}, false) AS guarded
  FROM tails WINDOW w AS (PARTITION BY doc_id ORDER BY line_no, sub_no)),
turns AS (SELECT *, CASE WHEN NOT named AND shape = 'transitory' THEN true WHEN NOT named AND shape = 'article' AND NOT guarded THEN false END AS turn FROM guards),
flags AS (SELECT *, coalesce(last_value(turn IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no, sub_no ROWS UNBOUNDED PRECEDING), false) AS in_transitory FROM turns),
kinds AS (SELECT doc_id, line_no, CAST(sub_no AS INTEGER) AS sub_no, x, CASE WHEN named THEN 'name' WHEN guarded THEN 'text' WHEN shape <> 'text' THEN shape
  WHEN in_transitory AND is_ordinal THEN 'transitory_ordinal' WHEN {ROMAN} THEN 'fraction' WHEN {has('x', _p.clause)} THEN 'clause' ELSE 'text' END AS kind,
  heading, body, guarded, in_transitory FROM flags)"""

_RAW = get("x", _p.transitory_ordinal, 1)
_REST = strip(f"regexp_replace({strip(get('x', _p.transitory_ordinal, 2))}, '^[.-]+', '')")
_PIECES = f"""{_KINDS},
pieces AS (SELECT *, CASE kind WHEN 'transitory_ordinal' THEN '**' || {strip(_RAW)} || CASE WHEN contains(substr(x, 1, length({_RAW}) + 3), '.-') THEN '.-' ELSE '.' END || '**'
    || CASE WHEN {_REST} <> '' THEN ' ' || {_REST} ELSE '' END
  WHEN 'fraction' THEN x WHEN 'clause' THEN x WHEN 'text' THEN x WHEN 'article' THEN body WHEN 'ordinal_article' THEN body ELSE '' END AS piece FROM kinds),
before AS (SELECT *, coalesce(lag(piece) OVER (PARTITION BY doc_id ORDER BY line_no, sub_no), '') AS prev FROM pieces),
broken AS (SELECT *, prev <> '' AS open_before, prev LIKE '%-' AND kind = 'text' AND NOT guarded AS glued, CASE WHEN piece = '' THEN false
  WHEN kind = 'text' THEN prev = '' OR (regexp_matches(prev, '[.;:]$') AND NOT guarded AND regexp_matches(x, '^\\p{{Lu}}')) ELSE true END AS breaks FROM before),
numbered AS (SELECT *, sum(CASE WHEN breaks THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no, sub_no ROWS UNBOUNDED PRECEDING) AS para_no FROM broken),
joined AS (SELECT doc_id, CAST(para_no AS BIGINT) AS para_no, arg_min(line_no, (line_no, sub_no)) AS line_no, arg_min(sub_no, (line_no, sub_no)) AS sub_no, arg_min(kind, (line_no, sub_no)) AS kind,
  {strip("replace(replace(string_agg(CASE WHEN glued THEN chr(1) || piece ELSE piece END, ' ' ORDER BY line_no, sub_no), '- ' || chr(1), ''), chr(1), '')")} AS text
  FROM numbered WHERE piece <> '' GROUP BY doc_id, para_no)"""


def clauses(x: str) -> str:
    """List of the parts of a paragraph at run-on clauses (a mark stands for the look-around)."""
    marked = rf"regexp_replace({x}, '([.:])\s+([a-z]\)\s)', '\1' || chr(2) || '\2', 'g')"
    parts = f"list_transform(string_split({marked}, chr(2)), lambda v: {strip('v')})"
    return rf"CASE WHEN {x} <> '' AND NOT regexp_matches({x}, '^(#|>|---|\*\*)') THEN {parts} ELSE [{x}] END"


def _spread(lst: str) -> str:
    return f"flatten(list_transform({lst}, lambda v, i: CASE WHEN i = 1 THEN [v] ELSE ['', v] END))"


_MARKDOWN = f"""{_PIECES},
lead_rows AS (SELECT *, CASE WHEN lead(kind) OVER w = 'name' THEN ' — ' || lead(x) OVER w ELSE '' END AS name FROM numbered WINDOW w AS (PARTITION BY doc_id ORDER BY line_no, sub_no)),
outs AS (
  SELECT doc_id, line_no, sub_no, 0 AS slot, kind, CASE kind WHEN 'blank' THEN [''] WHEN 'quote' THEN ['', x, ''] WHEN 'table' THEN {_spread(clauses('x'))}
    WHEN 'transitory' THEN ['', '## ' || heading, ''] WHEN 'article' THEN ['', '### ' || heading] WHEN 'ordinal_article' THEN ['', '### ' || heading]
    WHEN 'part' THEN ['', '## ' || heading || CASE WHEN body <> '' THEN ' — ' || body ELSE '' END || name]
    WHEN 'fraction' THEN CASE WHEN open_before THEN [''] END WHEN 'clause' THEN CASE WHEN open_before THEN [''] END END AS o FROM lead_rows
  UNION ALL SELECT doc_id, line_no, sub_no, 1, kind, {_spread(clauses('text'))} FROM joined),
flat AS (SELECT doc_id, line_no, sub_no, slot, kind, unnest(range(len(o))) AS n, unnest(o) AS text FROM outs WHERE o IS NOT NULL),
md AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no, sub_no, slot, n) AS INTEGER) AS out_no, kind, text FROM flat)"""


_SQUEEZED = strip(r"regexp_replace(text, '\s+', ' ', 'g')")


def headers(source: str, least: int = 16) -> str:
    """CTE ``headers`` (doc_id, header, n) over the lines of ``source``."""
    caps = f"length({strip('text')}) >= {least} AND {no_lower('text')} AND regexp_matches(text, '[A-ZÁÉÍÓÚÑ]{{4,}}')"
    return (
        f"header_counts AS (SELECT doc_id, {_SQUEEZED} AS header, count(*) AS n, min(line_no) AS first FROM {source} WHERE {caps} GROUP BY ALL), "
        "headers AS (SELECT doc_id, header, n FROM header_counts QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) = 1 AND n >= 3)"
    )


SQL_CLEAN = f"""{SQL_LEGAL.replace('legal AS', 'raw_legal AS')}, {headers('raw_legal')},
legal AS (SELECT doc_id, line_no, CASE WHEN header IS NULL THEN text WHEN contains({strip('text')}, header) THEN {strip(f"replace({strip('text')}, header, ' ')")} ELSE {strip('text')} END AS text
  FROM raw_legal LEFT JOIN headers USING (doc_id) WHERE header IS NULL OR {_SQUEEZED} <> header)"""
KINDS = f"{SQL_LEGAL},{_KINDS}"
PIECES = f"{SQL_LEGAL},{_PIECES}"
MARKDOWN = f"{SQL_CLEAN},{_MARKDOWN}"
