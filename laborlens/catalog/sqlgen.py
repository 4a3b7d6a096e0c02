"""DuckDB SQL twins of the column functions, for the oracle check.

Each builder mirrors one function in ``laborlens.functions`` and is generated
from the same dictionaries, so the two sides cannot drift apart.
"""

from __future__ import annotations

from laborlens.functions import dictionaries as D
from laborlens.functions.similarity import char_masks, py_token_sort


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def title_case(x: str) -> str:
    chars = f"string_split(lower({x}), '')"
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE array_to_string(list_transform({chars}, lambda c, i: "
            f"CASE WHEN i > 1 AND upper({chars}[i - 1]) <> lower({chars}[i - 1]) THEN c ELSE upper(c) END), '') END")


def first_contained(text: str, pairs, default: str | None = None) -> str:
    if not pairs:
        return default or "NULL"
    whens = " ".join(f"WHEN contains({text}, {q(k)}) THEN {q(v)}" for k, v in pairs)
    return f"CASE {whens} ELSE {default or 'NULL'} END"


def exact_lookup(key: str, pairs, default: str) -> str:
    whens = " ".join(f"WHEN {key} = {q(k)} THEN {q(v)}" for k, v in pairs)
    return f"CASE {whens} ELSE {default} END"


def normalise_city(raw: str, aliases=D.CITY_ALIASES) -> str:
    key = f"lower({strip_ws(raw)})"
    return (f"CASE WHEN {raw} IS NULL OR {raw} = '' THEN '' ELSE "
            f"{first_contained(key, aliases, title_case(strip_ws(raw)))} END")


def classify_keywords(text: str, groups, default: str = D.SECTOR_DEFAULT) -> str:
    whens = []
    for label, words in groups:
        cond = " OR ".join(f"contains({text}, {q(w)})" for w in words)
        whens.append(f"WHEN {cond} THEN {q(label)}")
    return f"CASE {' '.join(whens)} ELSE {q(default)} END"


def classify_sector(name: str, description: str | None = None, groups=D.SECTOR_KEYWORDS) -> str:
    desc = "''" if description is None else f"coalesce({description}, '')"
    return classify_keywords(f"lower(coalesce({name}, '') || ' ' || {desc})", groups)


def classify_register_sector(name: str, groups=D.REGISTER_SECTOR_KEYWORDS) -> str:
    return classify_keywords(f"lower(coalesce({name}, ''))", groups)


def classify_signal(title: str, desc: str, layoff=D.LAYOFF_WORDS, hiring=D.HIRING_WORDS) -> str:
    text = f"lower(coalesce({title}, '') || ' ' || coalesce({desc}, ''))"
    lay = " + ".join(f"(CASE WHEN contains({text}, {q(w)}) THEN 1 ELSE 0 END)" for w in layoff)
    hire = " + ".join(f"(CASE WHEN contains({text}, {q(w)}) THEN 1 ELSE 0 END)" for w in hiring)
    return (f"CASE WHEN ({lay}) > ({hire}) THEN 'layoff' WHEN ({hire}) > ({lay}) THEN 'hiring' "
            f"ELSE 'neutral' END")


def extract_headcount(text: str, patterns=D.HEADCOUNT_PATTERNS) -> str:
    parts = []
    for p in patterns:
        grp = f"regexp_extract({text}, {q('(?i)' + p)}, 1)"
        parts.append(f"CASE WHEN {grp} <> '' THEN TRY_CAST(replace({grp}, ',', '') AS BIGINT) END")
    return f"coalesce({', '.join(parts)})"


def extract_company(text: str, known=D.KNOWN_COMPANIES, patterns=D.COMPANY_PATTERNS,
                    stop=D.COMPANY_STOP_WORDS) -> str:
    t = f"coalesce({text}, '')"
    parts = [f"CASE WHEN contains(lower({t}), {q(k.lower())}) THEN {q(k)} END" for k in known]
    stops = ", ".join(q(s) for s in stop)
    for p in patterns:
        grp = f"regexp_extract({t}, {q(p)}, 1)"
        parts.append(f"CASE WHEN {grp} <> '' AND {grp} NOT IN ({stops}) THEN {grp} END")
    parts.append("''")
    return f"coalesce({', '.join(parts)})"


def extract_city(text: str, cities=D.MENTION_CITIES) -> str:
    from laborlens.functions.text import mention_pattern
    hit = f"regexp_extract(lower(coalesce({text}, '')), {q(mention_pattern(cities))}, 1)"
    return f"CASE WHEN {hit} = '' THEN '' ELSE {title_case(hit)} END"


def strip_html(x: str, limit: int | None = None) -> str:
    text = strip_ws(f"regexp_replace({x}, {q('<[^>]+>')}, {q(' ')}, {q('g')})")
    return text if limit is None else f"substring({text}, 1, {limit})"


def without_commas(x: str) -> str:
    return f"TRY_CAST(replace({strip_ws(x)}, ',', '') AS BIGINT)"


def first_nonempty(*cols: str) -> str:
    return f"coalesce({', '.join(f'nullif({c}, ' + q('') + ')' for c in cols)})"


def token_sort(x: str) -> str:
    return f"array_to_string(list_sort(regexp_split_to_array({strip_ws(x)}, '\\s+')), ' ')"


def canonical_rows(canonical) -> str:
    """The canonical names as rows: position, name, sorted form, its length, all-ones word, character masks."""
    rows = []
    for i, name in enumerate(canonical):
        b = py_token_sort(name)
        if len(b) > 62:  # one 64-bit word; the registered dictionaries' names are shorter
            raise ValueError(b)
        masks = ", ".join(f"{q(c)}: {m}::BIGINT" for c, m in char_masks(b).items()) or "'': 0::BIGINT"
        rows.append(f"({i}, {q(name)}, {q(b)}, {len(b)}, {(1 << len(b)) - 1}::BIGINT, MAP {{{masks}}})")
    return f"(VALUES {', '.join(rows)}) canon(pos, name, b, lb, ones, masks)"


#: the bit-parallel recurrence over the characters of ``a`` for the canonical row's masks
LCS = ("(lb - bit_count(list_reduce(string_split(a, ''), lambda v, c: ((v + (v & coalesce(masks[c], 0))) "
       "| (v - (v & coalesce(masks[c], 0)))) & ones, ones)))")


def company_names(src: str, col: str, out: str, canonical=D.CANONICAL_COMPANIES,
                  cutoff: float = D.COMPANY_MATCH_CUTOFF, min_len: int = 2) -> str:
    """X1 twin: (_k, out) of every distinct value of ``col``, by scoring it against each canonical row in reach."""
    return f"""
SELECT k AS _k, CASE WHEN k IS NULL OR length(s) < {min_len} THEN '' ELSE coalesce(best, {title_case('s')}) END AS {out}
FROM (SELECT k, s, any_value(name) FILTER (WHERE _r = 1 AND score >= {float(cutoff)}) AS best FROM (
  SELECT k, s, name, score, row_number() OVER (PARTITION BY k ORDER BY score DESC NULLS LAST, pos) AS _r FROM (
    SELECT n.*, pos, name, CASE WHEN a = b THEN 100.0::DOUBLE ELSE 200.0::DOUBLE * {LCS} / (la + lb) END AS score
    FROM (SELECT k, s, a, length(a) AS la FROM (SELECT k, s, {token_sort('s')} AS a FROM (
            SELECT k, {strip_ws('k')} AS s FROM (SELECT DISTINCT {col} AS k FROM ({src})))) ) n
    LEFT JOIN {canonical_rows(canonical)} ON la + lb > 0 AND 200 * least(la, lb) >= {cutoff} * (la + lb)))
  GROUP BY k, s)"""


def parse_published(x: str) -> str:
    """Y2 twin: ISO dates alone or with a time, a fraction, "Z" or an offset; RFC-822 with GMT or an offset; m/d/y."""
    t = f"trim({x}, ' ')"
    body = f"CASE WHEN regexp_matches({t}, '^[A-Za-z]{{3}}, ') THEN substr({t}, 6) END"
    iso = f"CASE WHEN regexp_matches({t}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}($|[T ])') THEN {t} END"
    return (f"coalesce(try_strptime({t}, '%Y-%m-%dT%H:%M:%SZ'), "
            f"CASE WHEN regexp_matches({t}, ':.*[+-]\\d{{2}}:?\\d{{2}}$') THEN make_timestamp(epoch_us(TRY_CAST({iso} AS TIMESTAMPTZ))) "
            f"ELSE TRY_CAST({iso} AS TIMESTAMP) END, "
            f"try_strptime({body}, '%d %b %Y %H:%M:%S GMT'), "
            f"make_timestamp(epoch_us(try_strptime({body}, '%d %b %Y %H:%M:%S %z'))), "
            f"try_strptime({t}, '%m/%d/%Y'))")


def signal_score_tenths(t: str, hc: str) -> str:
    h = f"coalesce(CAST({hc} AS BIGINT), 0)"
    mag = ("CASE " + " ".join(f"WHEN {h} > {b} THEN {int(round(v * 10))}" for b, v in D.SCORE_BANDS)
           + f" ELSE {int(round(D.SCORE_FLOOR * 10))} END")
    return f"CASE WHEN {t} = 'layoff' THEN -({mag}) WHEN {t} = 'hiring' THEN {mag} ELSE 0 END"


def status_from_sums(s: str, n: str) -> str:
    lo, hi = int(round(D.STATUS_LAYOFF_BELOW * 10)), int(round(D.STATUS_HIRING_ABOVE * 10))
    s, n = f"coalesce({s}, 0)", f"coalesce({n}, 0)"
    return (f"CASE WHEN {n} > 0 AND {s} < {n} * ({lo}) THEN 'layoff' "
            f"WHEN {n} > 0 AND {s} > {n} * {hi} THEN 'hiring' ELSE 'mixed' END")


def company_status(s: str, n: str, lay: str, hire: str) -> str:
    return (f"CASE WHEN {hire} > {lay} * 2 THEN 'hiring' WHEN {lay} > {hire} * 2 THEN 'layoff' "
            f"ELSE {status_from_sums(s, n)} END")


def mean_score(s: str, n: str) -> str:
    return f"CASE WHEN {n} > 0 THEN {s} / ({n} * 10.0) ELSE 0.0 END"


def choose_sector(reg: str, company: str, groups=D.SECTOR_KEYWORDS) -> str:
    empties = ", ".join(q(e) for e in D.EMPTY_SECTORS)
    return f"CASE WHEN {reg} IS NULL OR {reg} IN ({empties}) THEN {classify_sector(company, None, groups)} ELSE {reg} END"


def news_url_key(url: str, title: str, company: str) -> str:
    return (f"CASE WHEN regexp_matches({url}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]+/?$') "
            f"THEN concat_ws('|', {url}, coalesce({title}, '')) "
            f"ELSE coalesce(nullif({url}, ''), concat_ws('|', coalesce({title}, ''), coalesce({company}, ''))) END")


def keep_first(src: str, keys: list[str], order: list[str], columns: list[str], last: bool = False) -> str:
    """U* twin: row_number over the key by the order tuple, then every column (nulls first)."""
    d = "DESC NULLS LAST" if last else "ASC NULLS FIRST"
    rest = [c for c in columns if c not in keys and c not in order]
    ob = ", ".join(f"{o} {d}" for o in order + rest)
    cols = ", ".join(columns)
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {ob}) AS _rn "
            f"FROM ({src})) WHERE _rn = 1")
