"""The same queries in SQL for a second engine (DuckDB), on the same tables.

The statements share the input views, patterns and word lists with the library
and nothing else: where Spark works inside the row, they unnest and use window
functions.
"""

from __future__ import annotations

import re

from jobtide import fixed_values as V
from jobtide.checks import fixtures as X
from jobtide.functions import sections as S
from jobtide.functions import text as T
from jobtide.functions.requirements import TOKEN

AS_OF = f"TIMESTAMP '{X.AS_OF}'"
LANDED_UNTIL = f"TIMESTAMP '{X.LANDED_UNTIL}'"
SPACE = r"[\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
HEADER = r"(?i)\b(?:" + "|".join(V.SKILL_HEADERS) + r")\b"


def q(text: str) -> str:
    """A SQL string literal; control characters are spelled with chr()."""
    parts = re.split("([\x00-\x1f])", text)
    spelled = [
        f"chr({ord(p)})" if i % 2 else "'" + p.replace("'", "''") + "'" for i, p in enumerate(parts) if p or not i % 2
    ]
    return spelled[0] if len(spelled) == 1 else "(" + " || ".join(spelled) + ")"


def sub(expr: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(replacement)}, 'g')"


def rewrite(expr: str, rules) -> str:
    for pattern, replacement in rules:
        expr = sub(expr, pattern, replacement)
    return expr


def strip(expr: str) -> str:
    return sub(expr, f"^{SPACE}+|{SPACE}+$", "")


def collapse(expr: str) -> str:
    return f"trim({sub(expr, SPACE + '+', ' ')}, ' ')"


def normalize(expr: str) -> str:
    quotes = "'" * len(V.APOSTROPHES)
    return collapse(
        f"replace(translate(coalesce({expr}, ''), {q(T.NBSP + V.APOSTROPHES)}, {q(' ' + quotes)}), '&amp;', '&')"
    )


# Every character reference the check tables contain; the ampersand last.
ENTITIES = (
    ("&apos;", "'"),
    ("&nbsp ", T.NBSP + " "),
    ("&#146;", "’"),
    ("&#00008217;", "’"),
    ("&bull;", "•"),
    ("&middot;", "·"),
    ("&copy;", "©"),
    ("&quot;", '"'),
    ("&#8217;", "’"),
    ("&eacute;", "é"),
    ("&lt;", T.HIDDEN_LT),
    ("&amp;", "&"),
)


def decoded(expr: str) -> str:
    expr = f"coalesce({expr}, '')"
    for name, char in ENTITIES:
        expr = f"replace({expr}, '{name}', {q(char)})"
    return expr


def revealed(expr: str) -> str:
    return f"replace(replace({expr}, {q(T.HIDDEN_LT)}, '<'), {q(T.HIDDEN_GT)}, '>')"


def pieces(expr: str) -> str:
    cut = f"string_split({sub(decoded(expr), f'{T.INVISIBLE}|{T.TAG}', T.CUT)}, {q(T.CUT)})"
    return f"list_filter(list_transform({cut}, lambda p: {revealed(strip('p'))}), lambda p: p <> '')"


def plain(expr: str, separator: str) -> str:
    return f"coalesce(array_to_string({pieces(expr)}, {q(separator)}), '')"


def with_(*names: str) -> str:
    """A WITH clause holding the named tables and all they need, in order."""
    wanted: list[str] = []

    def need(name: str) -> None:
        if name in wanted:
            return
        for other in TABLES:
            if other != name and re.search(rf"\b(FROM|JOIN) {other}\b", TABLES[name]):
                need(other)
        wanted.append(name)

    for name in names:
        need(name)
    return "WITH " + ",\n".join(f"{name} AS ({TABLES[name]})" for name in wanted) + "\n"


JSON = {
    "title": "json_extract_string(raw_json, '$.title')",
    "company": "json_extract_string(raw_json, '$.company.display_name')",
    "location": "json_extract_string(raw_json, '$.location.display_name')",
    "low": "CAST(json_extract_string(raw_json, '$.salary_min') AS DOUBLE)",
    "high": "CAST(json_extract_string(raw_json, '$.salary_max') AS DOUBLE)",
}

BILINGUAL = strip(rewrite("lower(title)", V.BILINGUAL_RULES))
NO_SENIORITY = collapse(
    sub(f"regexp_replace({BILINGUAL}, {q(V.SENIORITY_WORDS)}, '', 'gi')", V.LEADING_NON_LETTERS, "")
)
CLEAN = f"coalesce({collapse(rewrite(NO_SENIORITY, V.COMMON_TERM_RULES))}, '')"


def keyword_case(title: str) -> str:
    whens = " ".join(
        f"WHEN regexp_matches({title}, {q(f'(?i){V.KEYWORD_LEFT}({words}){V.KEYWORD_RIGHT}')}) THEN '{role}'"
        for role, words in V.KEYWORD_ROLES
    )
    return f"CASE {whens} END"


def seniority_case(title: str, years: str) -> str:
    whens = " ".join(
        f"WHEN contains(lower(coalesce({title}, '')), '{word}') THEN '{level}'"
        for level, words in V.SENIORITY_TITLE_WORDS
        for word in words
    )
    return (
        f"CASE {whens} WHEN {years} <= {V.JUNIOR_UP_TO_YEARS} THEN 'junior'"
        f" WHEN {years} >= {V.SENIOR_FROM_YEARS} THEN 'senior' WHEN {years} IS NOT NULL THEN 'mid' END"
    )


def words(expr: str) -> str:
    return f"list_distinct(regexp_extract_all({expr}, {q(T.WORD)}))"


def match_tables(source: str, name: str) -> dict[str, str]:
    """Tables that map the ``cleaned_title`` of ``source`` by joining it to the aliases."""
    return {
        f"{name}_titles": f"SELECT DISTINCT cleaned_title FROM {source} WHERE cleaned_title <> ''",
        f"{name}_exact": rf"""
            SELECT cleaned_title, arg_min(name, position) AS role FROM {name}_titles CROSS JOIN aliases
            WHERE regexp_matches(cleaned_title, '(?i)\b(' || regexp_escape(alias) || ')\b') GROUP BY 1""",
        f"{name}_flexible": f"""
            SELECT cleaned_title, arg_min(name, position) AS role FROM {name}_titles CROSS JOIN aliases
            WHERE list_has_all({words('cleaned_title')}, {words('lower(alias)')}) GROUP BY 1""",
        f"{name}_roles": f"""
            SELECT s.*, coalesce(e.role, x.role, {keyword_case('s.cleaned_title')}) AS matched_role,
                   CASE WHEN e.role IS NOT NULL THEN '{V.EXACT_MATCH}' WHEN x.role IS NOT NULL THEN '{V.FLEXIBLE_MATCH}'
                        WHEN {keyword_case('s.cleaned_title')} IS NOT NULL THEN '{V.KEYWORD_MATCH}'
                        ELSE '{V.NO_MATCH}' END AS match_method
            FROM {source} s LEFT JOIN {name}_exact e USING (cleaned_title)
            LEFT JOIN {name}_flexible x USING (cleaned_title)""",
    }


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else q(v) for v in row) + ")" for row in rows)


MARKED = f"replace({decoded('html')}, {q(T.NBSP)}, ' ')"
for _pattern, _replacement in S.MARKS:
    # The same patterns without possessive quantifiers; backslash references.
    if _pattern.startswith("(?U)"):
        _pattern = _pattern[4:].replace(r"[^\s", "[^" + SPACE[1:-1]).replace(r"\s++", SPACE + "+")
    _pattern = _pattern.replace("++", "+").replace("*+", "*")
    MARKED = sub(MARKED, _pattern, _replacement.replace("$", "\\"))

INNER = normalize(revealed(sub("raw", f"{S.MARK}|{T.TAG}", "")))


def block_tables(source: str, keys: str, name: str) -> dict[str, str]:
    """Tables ``<name>_blocks`` and ``<name>_items`` of ``source(keys, html)``."""
    over = f"OVER (PARTITION BY {keys} ORDER BY grp, part, piece"
    return {
        f"{name}_groups": f"""
            SELECT {keys}, grp, string_split(g, chr(29)) AS parts
            FROM (SELECT {keys}, string_split('h' || chr(31) || {MARKED}, chr(28)) AS gs FROM {source}),
                 UNNEST(gs) WITH ORDINALITY AS u(g, grp)""",
        f"{name}_pieces": f"""
            SELECT {keys}, grp, 1 AS part, piece, CASE WHEN lower(p) LIKE 'h%' THEN 'H' ELSE 'T' END AS kind,
                   substr(p, instr(p, chr(31)) + 1) AS raw
            FROM {name}_groups, UNNEST(string_split(parts[1], chr(30))) WITH ORDINALITY AS u(p, piece)
            UNION ALL
            SELECT {keys}, grp, part, 1 AS piece, 'L' AS kind, substr(p, instr(p, chr(31)) + 1) AS raw
            FROM {name}_groups, UNNEST(parts) WITH ORDINALITY AS u(p, part)
            WHERE part > 1 AND regexp_matches(p, {q(S.ITEM_OPEN)})""",
        f"{name}_kept": f"""
            SELECT *, {INNER} AS body FROM {name}_pieces WHERE kind = 'L' OR {INNER} <> ''""",
        f"{name}_context": f"""
            SELECT {keys}, kind, raw, CAST(row_number() {over}) - 1 AS INTEGER) AS block_pos,
                   coalesce(last_value(CASE WHEN kind <> 'L' THEN body END IGNORE NULLS)
                            {over} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS context
            FROM {name}_kept""",
        f"{name}_flagged": f"""
            SELECT *, regexp_matches(context, {q(HEADER)})
                   OR regexp_matches(regexp_extract(raw, {q(S.FIRST_LINE.replace('*+', '*'))}, 1), {q(HEADER)}) AS flagged
            FROM {name}_context""",
        f"{name}_lines": f"""
            SELECT {keys}, block_pos, flagged, line_no, line, regexp_matches(line, {q(V.BULLET_PREFIX)}) AS bullet,
                   regexp_matches(line, {q(HEADER)}) AND NOT regexp_matches(line, {q(V.BULLET_PREFIX)}) AS header
            FROM (SELECT {keys}, block_pos, flagged, line_no, {normalize(revealed('l'))} AS line
                  FROM {name}_flagged, UNNEST(string_split({sub('raw', T.TAG, chr(10))}, chr(10)))
                       WITH ORDINALITY AS u(l, line_no) WHERE kind = 'T')
            WHERE line <> ''""",
        f"{name}_seen": f"""
            SELECT *, coalesce(bool_or(header) OVER (PARTITION BY {keys}, block_pos ORDER BY line_no
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS below_header,
                   sum(CAST(bullet AS INT)) OVER (PARTITION BY {keys}, block_pos ORDER BY line_no) AS item_no
            FROM {name}_lines""",
        f"{name}_bulleted": f"""
            SELECT {keys}, block_pos, item_no, string_agg(CASE WHEN bullet
                   THEN trim({sub('line', V.BULLET_PREFIX, '')}, ' ') ELSE ' ' || line END, '' ORDER BY line_no) AS item
            FROM {name}_seen
            WHERE item_no > 0 AND (bullet OR (NOT header AND (flagged OR below_header)))
            GROUP BY {keys}, block_pos, item_no""",
        f"{name}_listed": f"""
            SELECT {keys}, block_pos, item_no, {INNER} AS item
            FROM (SELECT {keys}, block_pos, raw AS body_html FROM {name}_flagged WHERE kind = 'L'),
                 UNNEST(regexp_split_to_array(body_html, {q(S.ITEM_OPEN)})) WITH ORDINALITY AS u(raw, item_no)
            WHERE item_no > 1""",
        f"{name}_blocks": f"""
            SELECT f.*, f.flagged OR coalesce(h.has_header, false) AS is_section
            FROM {name}_flagged f LEFT JOIN (SELECT {keys}, block_pos, bool_or(header) AS has_header
                 FROM {name}_lines GROUP BY {keys}, block_pos) h USING ({keys}, block_pos)""",
        f"{name}_items": f"""
            SELECT {keys}, block_pos, is_section, item,
                   CAST(row_number() OVER (PARTITION BY {keys}, block_pos ORDER BY item_no) - 1 AS INTEGER) AS item_pos
            FROM (SELECT {keys}, block_pos, item_no, item FROM {name}_bulleted
                  UNION ALL SELECT {keys}, block_pos, item_no, item FROM {name}_listed)
                 JOIN {name}_blocks USING ({keys}, block_pos)
            WHERE item <> ''""",
    }


def gazetteer(expr: str, item_type: str) -> str:
    """Sorted names of a type found in a text, as JSON."""
    spaced = f"' ' || array_to_string(regexp_extract_all(lower({expr}), {q(TOKEN)}), ' ') || ' '"
    tests = ", ".join(
        f"CASE WHEN contains({spaced}, {q(' ' + ' '.join(re.findall(r'[.]?[a-z0-9_][a-z0-9_+#]*', t.term)) + ' ')}) THEN {q(t.canonical)} END"
        for t in X.TERMS
        if t.item_type == item_type
    )
    return f"list_sort(list_distinct(list_filter([{tests}], lambda t: t IS NOT NULL)))"


def years(expr: str, group: int) -> str:
    least = "list_min" if group == 1 else "list_max"
    # Written apart from the library's pattern: decimals are cut and ranges spelled "a-b" first.
    whole = sub(expr, r"([0-9])[.,][0-9]{1,2}([^0-9]|$)", r"\1\2")
    more = sub(whole, r"(?i)([0-9])(?:\s*\+|\s*-?\s*plus\b|\s+or\s+more\b|\s+ou\s+plus\b)", r"\1")
    ranged = sub(more, r"(?i)\b(?:between|entre)\s+([0-9]+)\s+(?:and|et)\s+([0-9])", r"\1-\2")
    joined = sub(ranged, r"(?i)([0-9])\s*(?:-|–|—|to\b|à)\s*([0-9]{1,2}\s*-?\s*(?:years?|yrs?|ans?|années?)\b)", r"\1-\2")
    unit = r"\s*-?\s*(?:years?|yrs?|ans?|années?)(?:[^\pL\pN_]|$)"
    pattern = rf"(?i)(?:^|[^\pL\pN_.,]|[^0-9][.,])([0-9]{{1,2}})(?:-([0-9]{{1,2}}))?{unit}"
    found = f"regexp_extract_all({joined}, {q(pattern)}, {group})"
    return f"{least}(list_transform(list_filter({found}, lambda y: y <> ''), lambda y: CAST(y AS INTEGER)))"


def _list_ok(field: str) -> str:
    other = f"list_filter(json_extract(safe, '$.{field}[*]'), lambda e: json_type(e) NOT IN ('VARCHAR', 'NULL'))"
    return (
        f"(coalesce(json_type(safe, '$.{field}'), 'NULL') = 'NULL'"
        f" OR (json_type(safe, '$.{field}') = 'ARRAY' AND len({other}) = 0))"
    )


def _list(field: str) -> str:
    dropped = ", ".join(q(v) for v in V.DROPPED_LIST_VALUES)
    return (
        f"CASE WHEN ok THEN list_filter(coalesce(json_extract_string(safe, '$.{field}[*]'), []),"
        f" lambda v: v IS NOT NULL AND lower({strip('v')}) NOT IN ({dropped})) ELSE [] END"
    )


def _year(field: str) -> str:
    number = r"^\s*([+-]?\d+)(?:\.0+)?\s*$"
    return f"TRY_CAST(regexp_extract(json_extract_string(safe, '$.{field}'), {q(number)}, 1) AS INTEGER)"


def _year_ok(field: str) -> str:
    return f"(coalesce(json_type(safe, '$.{field}'), 'NULL') = 'NULL' OR {_year(field)} IS NOT NULL)"


_FIRST = "row_number() OVER (PARTITION BY source, source_job_id ORDER BY seq)"

TABLES: dict[str, str] = {
    "postings": X.POSTINGS,
    "titles": f"SELECT source, source_job_id, seq, {JSON['title']} AS title FROM postings",
    "cleaned": f"SELECT *, {CLEAN} AS cleaned_title FROM titles",
    "loaded": f"SELECT * REPLACE (coalesce(fetched_at, {AS_OF}) AS fetched_at) FROM postings",
    "jobs_raw": f"SELECT * EXCLUDE (n) FROM (SELECT *, {_FIRST} AS n FROM loaded) WHERE n = 1",
    "landed": f"SELECT * FROM (SELECT *, {_FIRST} AS n FROM loaded WHERE created_at < {LANDED_UNTIL}) WHERE n = 1",
    "posting_keys": X.POSTING_KEYS,
    "scraped_keys": X.SCRAPED_KEYS,
    "descriptions": X.DESCRIPTIONS,
    "responses": X.RESPONSES,
    "job_pages": X.JOB_PAGES,
    "lines": X.LINES,
    "aliases": "SELECT * FROM (VALUES "
    + _values([(i, r.name, a) for i, r in enumerate(X.ROLES) for a in r.aliases])
    + ") AS t(position, name, alias)",
    "tasks": "SELECT * FROM (VALUES "
    + _values([(i + 1, r.name, s) for i, r in enumerate(X.ROLES) for s in r.search_term])
    + ") AS t(position, role_title, search_term)",
    "metadata": f"""
        SELECT source, source_job_id, {JSON['title']} AS job_title, {JSON['title']} AS title, {JSON['company']} AS company,
               {JSON['location']} AS location, {JSON['low']} AS min_salary, {JSON['high']} AS max_salary,
               created_at AS posted_at, p.redirect_url
        FROM jobs_raw p JOIN descriptions d USING (source, source_job_id) WHERE {JSON['company']} IS NOT NULL""",
    "meta_cleaned": f"SELECT *, {CLEAN} AS cleaned_title FROM metadata",
    **match_tables("cleaned", "all"),
    **match_tables("meta_cleaned", "meta"),
    "jobs": f"""
        SELECT source, source_job_id, posted_at, job_title, matched_role AS role_title, match_method AS role_match_method,
               company, location, min_salary, max_salary, redirect_url
        FROM meta_roles WHERE match_method <> '{V.NO_MATCH}'""",
    "html_pages": "SELECT page_id, html FROM pages",
    "html_descriptions": "SELECT source, source_job_id, html_description AS html FROM descriptions",
    **block_tables("html_pages", "page_id", "pg"),
    **block_tables("html_descriptions", "source, source_job_id", "ds"),
    "wanted": """
        SELECT source, source_job_id, is_section, string_agg(item, chr(10) ORDER BY block_pos, item_pos) AS items
        FROM ds_items GROUP BY ALL""",
    "sections": f"""
        SELECT h.source, h.source_job_id, h.html,
               trim(coalesce(t.items, o.items, {normalize(plain('h.html', ' '))}), ' ') AS section
        FROM html_descriptions h
        LEFT JOIN (SELECT * FROM wanted WHERE is_section) t USING (source, source_job_id)
        LEFT JOIN (SELECT * FROM wanted WHERE NOT is_section) o USING (source, source_job_id)""",
    "reductions": f"""
        SELECT source, source_job_id, CAST(100 AS DOUBLE) * (length({plain('html', chr(10))}) - length(section))
               / nullif(length({plain('html', chr(10))}), 0) AS reduction_pct FROM sections""",
    "requirements": f"""
        SELECT source, source_job_id, {gazetteer('section', V.TECHNICAL_TOOL)} AS technical_tools,
               {gazetteer('section', V.TECHNICAL_CONCEPT)} AS technical_concepts,
               {gazetteer('section', V.CERTIFICATION)} AS certifications,
               {years('section', 1)} AS min_years, {years('section', 2)} AS max_years,
               {seniority_case('job_title', years('section', 1))} AS seniority,
               CASE WHEN section = '' THEN '{V.SKIPPED}' ELSE '{V.VALIDATED}' END AS extraction_status,
               CASE WHEN section = '' THEN 'No requirement section extracted' END AS error
        FROM jobs JOIN sections USING (source, source_job_id)""",
    "items": f"""
        SELECT *, lower({strip('item_value')}) AS item_value_norm FROM (
        SELECT source, source_job_id, '{V.TECHNICAL_TOOL}' AS item_type, unnest(technical_tools) AS item_value FROM requirements
        UNION ALL SELECT source, source_job_id, '{V.TECHNICAL_CONCEPT}', unnest(technical_concepts) FROM requirements
        UNION ALL SELECT source, source_job_id, '{V.CERTIFICATION}', unnest(certifications) FROM requirements)""",
    "job_items": "SELECT * FROM items JOIN jobs USING (source, source_job_id)",
    "safe_responses": "SELECT *, CASE WHEN json_valid(response) THEN response ELSE '[]' END AS safe FROM responses",
    "checked": f"""
        SELECT *, json_type(safe) = 'OBJECT' AND {' AND '.join(_list_ok(f) for f in ('technical_tools', 'technical_concepts', 'certifications'))}
               AND {_year_ok('min_years')} AND {_year_ok('max_years')} AS ok FROM safe_responses""",
    "parsed": f"""
        SELECT source, source_job_id,
               CASE WHEN {strip("coalesce(response, '')")} = '' THEN '{V.SKIPPED}' WHEN ok THEN '{V.VALIDATED}' ELSE '{V.FAILED}' END AS extraction_status,
               {_list('technical_tools')} AS technical_tools, {_list('technical_concepts')} AS technical_concepts,
               {_list('certifications')} AS certifications,
               CASE WHEN ok THEN {_year('min_years')} END AS min_years, CASE WHEN ok THEN {_year('max_years')} END AS max_years
        FROM checked""",
    "rescraped": """
        SELECT source, CASE WHEN redirect_url IS NOT NULL THEN source_job_id END AS source_job_id, redirect_url, seq,
               raw_json AS html_description FROM postings""",
    "item_roles": "SELECT DISTINCT item_value_norm AS item, role_title FROM job_items WHERE item_value_norm IS NOT NULL",
    "role_sizes": "SELECT role_title, count(*) AS size FROM item_roles GROUP BY 1",
}


def violations(table: str, name: str, required: list[str]) -> str:
    unique = (
        f"SELECT '{name}' AS table_name, 'unique key' AS rule, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_rows FROM"
        f" (SELECT count(*) AS n FROM {table} WHERE source IS NOT NULL AND source_job_id IS NOT NULL"
        " GROUP BY source, source_job_id)"
    )
    nulls = [
        f"SELECT '{name}', '{c} not null', count(*) FILTER (WHERE {c} IS NULL) FROM {table}" for c in required
    ]
    return " UNION ALL ".join([unique, *nulls])


def histogram(values: str, bins: int) -> str:
    return f""",
        vals AS ({values}),
        edges AS (SELECT min(v) AS low, (max(v) - min(v)) / CAST({bins} AS DOUBLE) AS width FROM vals),
        binned AS (SELECT CAST(least(coalesce(floor((v - low) / nullif(width, 0)), 0), {bins - 1}) AS INTEGER) AS bin FROM vals, edges)
        SELECT CAST(b.bin AS INTEGER) AS bin, round(low + b.bin * width, 4) AS lower, round(low + (b.bin + 1) * width, 4) AS upper,
               count(binned.bin) AS n
        FROM range({bins}) AS b(bin) CROSS JOIN edges LEFT JOIN binned ON binned.bin = b.bin GROUP BY ALL"""


def json_lists(table: str, columns: str) -> str:
    lists = ", ".join(
        f"CAST(to_json({c}) AS VARCHAR) AS {c}" for c in ("technical_tools", "technical_concepts", "certifications")
    )
    return f"SELECT {columns}, {lists} FROM {table}"


def by_role(item_type: str, name: str) -> str:
    return (
        f"SELECT role_title, item_value_norm AS {name}, count(*) AS n_jobs FROM job_items"
        f" WHERE item_type = '{item_type}' GROUP BY ALL"
    )


def text_time(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


_EXCLUDED = ", ".join(q(t) for t in V.EXCLUDED_TERMS)
_LINE_LISTS = ", ".join(
    f"CAST(to_json({gazetteer('line', t)}) AS VARCHAR) AS {f}"
    for t, f in (
        (V.TECHNICAL_TOOL, "technical_tools"),
        (V.TECHNICAL_CONCEPT, "technical_concepts"),
        (V.CERTIFICATION, "certifications"),
    )
)
_MAP = with_("all_roles") + (
    "SELECT source, source_job_id, seq, title, cleaned_title, matched_role, match_method FROM all_roles"
)
_TERMS = with_("lines") + f"SELECT doc_id, {_LINE_LISTS} FROM lines"
_MONTHS = (
    "SELECT strftime(created_at, '%b-%y') AS month_year, count(*) AS n_postings,"
    " CAST(min(created_at) AS VARCHAR) AS first_created{more} FROM jobs_raw GROUP BY 1"
)


def _between(opening: str, closing: str) -> str:
    return f"split_part(split_part(html, {q(opening)}, 2), {q(closing)}, 1)"


ORACLE_SQL: dict[str, str] = {
    "top_tools_by_role": with_("job_items") + by_role(V.TECHNICAL_TOOL, "tool"),
    "land_postings": with_("postings")
    + f"""SELECT 'BoardA' AS source, json_extract_string(raw_json, '$.id') AS source_job_id,
        json_extract_string(raw_json, '$.created') AS created_at, search_term, CAST({AS_OF} AS VARCHAR) AS fetched_at,
        json_extract_string(raw_json, '$.redirect_url') AS redirect_url, raw_json FROM postings""",
    "search_tasks": with_("tasks", "postings")
    + """SELECT t.position, t.role_title, t.search_term, count(p.seq) AS n_landed
        FROM tasks t LEFT JOIN postings p USING (search_term) GROUP BY ALL""",
    "exclude_terms": with_("titles")
    + f"""SELECT seq, title FROM titles WHERE NOT list_has_any(
        list_concat([], regexp_split_to_array(lower(coalesce(title, '')), '[^\\pL\\pN_]+'))
        || regexp_split_to_array(lower(coalesce(title, '')), '[^\\pL\\pN_-]+'), [{_EXCLUDED}])""",
    "recent_postings": with_("postings")
    + f"SELECT seq, source_job_id FROM postings WHERE created_at >= {AS_OF} - INTERVAL 365 DAY",
    "cap_per_term": with_("postings")
    + f"""SELECT search_term, seq FROM postings QUALIFY row_number() OVER (PARTITION BY search_term
        ORDER BY created_at DESC, source, source_job_id, seq) <= {V.RESULTS_PER_PAGE * V.MAX_PAGES}""",
    "insert_if_absent": with_("jobs_raw", "landed")
    + "SELECT source, source_job_id, seq FROM jobs_raw ANTI JOIN landed USING (source, source_job_id)",
    "upsert_postings": with_("jobs_raw", "landed")
    + f"""SELECT source, source_job_id, {text_time('created_at', 'fetched_at')}, search_term, redirect_url, raw_json
        FROM jobs_raw ANTI JOIN landed USING (source, source_job_id)""",
    "upsert_descriptions": with_("rescraped", "descriptions")
    + f"""SELECT source, source_job_id, redirect_url, CAST({AS_OF} AS VARCHAR) AS scraped_at, html_description
        FROM (SELECT * FROM rescraped WHERE source_job_id IS NOT NULL QUALIFY {_FIRST} = 1)
        ANTI JOIN descriptions USING (source, source_job_id)""",
    "upsert_jobs": with_("jobs")
    + f"""SELECT * REPLACE (CAST(posted_at AS VARCHAR) AS posted_at), CAST({AS_OF} AS VARCHAR) AS created_at
        FROM jobs WHERE NOT posted_at < {LANDED_UNTIL}""",
    "upsert_requirements": with_("requirements")
    + json_lists(
        "requirements",
        "source, source_job_id, min_years, max_years, seniority, extraction_status, error,"
        f" CAST({AS_OF} AS VARCHAR) AS extracted_at",
    )
    + f" WHERE extraction_status <> '{V.SKIPPED}'",
    "constraint_violations": with_("postings", "rescraped")
    + violations(
        "postings", "jobs_raw", ["source", "source_job_id", "created_at", "search_term", "fetched_at", "raw_json"]
    )
    + " UNION ALL "
    + violations(
        f"(SELECT *, {AS_OF} AS scraped_at FROM rescraped)", "descriptions_raw", ["source", "source_job_id", "scraped_at"]
    ),
    "table_counts": with_("jobs_raw", "descriptions", "jobs", "requirements", "items")
    + """SELECT 'jobs_raw' AS table_name, count(*) AS n_rows FROM jobs_raw
        UNION ALL SELECT 'descriptions_raw', count(*) FROM descriptions UNION ALL SELECT 'jobs', count(*) FROM jobs
        UNION ALL SELECT 'job_requirements', count(*) FROM requirements
        UNION ALL SELECT 'job_requirement_items', count(*) FROM items""",
    "ingest_metrics": with_("descriptions", "landed")
    + """SELECT count(*) AS candidates, count(*) FILTER (WHERE coalesce(html_description, '') = '') AS missed,
        count(*) FILTER (WHERE html_description <> '' AND l.n IS NOT NULL) AS already_present,
        count(*) FILTER (WHERE html_description <> '' AND l.n IS NULL) AS inserted
        FROM descriptions LEFT JOIN landed l USING (source, source_job_id)""",
    "stream_ingest_keys": with_("postings") + "SELECT DISTINCT source, source_job_id FROM postings",
    "posting_metadata": with_("metadata")
    + f"""SELECT source, source_job_id, job_title, company, location, min_salary, max_salary, {text_time('posted_at')},
        redirect_url FROM metadata""",
    "curated_jobs": with_("jobs") + "SELECT * REPLACE (CAST(posted_at AS VARCHAR) AS posted_at) FROM jobs",
    "unmapped_titles": with_("meta_roles")
    + f"SELECT source, source_job_id, job_title, cleaned_title FROM meta_roles WHERE match_method = '{V.NO_MATCH}'",
    "job_descriptions": with_("jobs", "descriptions")
    + """SELECT source, source_job_id, job_title, role_title, html_description
        FROM jobs JOIN descriptions USING (source, source_job_id)""",
    "missing_descriptions": with_("jobs_raw", "descriptions")
    + """SELECT source_job_id, source, redirect_url FROM jobs_raw WHERE (source, source_job_id) IN (
            SELECT (source, source_job_id) FROM jobs_raw EXCEPT SELECT (source, source_job_id) FROM descriptions)
        AND redirect_url IS NOT NULL GROUP BY ALL""",
    "cross_source_id_collisions": with_("jobs_raw", "descriptions")
    + """, by_id AS (SELECT source_job_id, count(*) AS n FROM jobs_raw JOIN descriptions d USING (source_job_id) GROUP BY 1),
        by_key AS (SELECT source_job_id, count(*) AS n FROM jobs_raw JOIN descriptions d USING (source, source_job_id) GROUP BY 1)
        SELECT j.source_job_id, count(DISTINCT j.source) AS n_sources, coalesce(any_value(i.n), 0) AS rows_by_id,
               coalesce(any_value(k.n), 0) AS rows_by_key
        FROM jobs_raw j LEFT JOIN by_id i USING (source_job_id) LEFT JOIN by_key k USING (source_job_id)
        GROUP BY 1 HAVING count(DISTINCT j.source) > 1""",
    "extraction_backlog": with_("jobs", "parsed")
    + f"""SELECT source, source_job_id, job_title FROM jobs
        ANTI JOIN (SELECT * FROM parsed WHERE extraction_status = '{V.VALIDATED}') USING (source, source_job_id)""",
    "normalize_bilingual": with_("titles") + f"SELECT seq, title, {BILINGUAL} AS result FROM titles",
    "remove_seniority": with_("titles") + f"SELECT seq, title, {NO_SENIORITY} AS result FROM titles",
    "normalize_common_terms": with_("titles")
    + f"SELECT seq, title, {collapse(rewrite('lower(title)', V.COMMON_TERM_RULES))} AS result FROM titles",
    "clean_job_title": with_("titles") + f"SELECT seq, title, {CLEAN} AS result FROM titles",
    "match_alias_exact": with_("cleaned", "all_exact")
    + "SELECT seq, cleaned_title, role AS matched_role FROM cleaned LEFT JOIN all_exact USING (cleaned_title)",
    "match_alias_flexible": with_("cleaned", "all_flexible")
    + "SELECT seq, cleaned_title, role AS matched_role FROM cleaned LEFT JOIN all_flexible USING (cleaned_title)",
    "match_keywords": with_("cleaned")
    + f"SELECT seq, cleaned_title, {keyword_case('cleaned_title')} AS matched_role FROM cleaned",
    "map_titles": _MAP,
    "map_titles_by_join": _MAP,
    "infer_seniority": with_("titles")
    + f"SELECT seq, {seniority_case('title', 'CASE WHEN seq % 3 > 0 THEN seq % 8 END')} AS seniority FROM titles",
    "page_main_container": with_("job_pages")
    + f"""SELECT page_id, {strip(f'''CASE page_id % 5
        WHEN 0 THEN {_between('<article title="a > b" id=jobDescription>', '</article>')}
        WHEN 1 THEN {_between('<div class="card job-description">', '</div></div>')} || '</div>'
        WHEN 2 THEN {_between("<section class='adp-body'>", '</section>')}
        WHEN 3 THEN {_between('<div data-testid="viewJobBodyContainer">', '</div>')} END''')} AS container FROM job_pages""",
    "normalize_text": with_("lines") + f"SELECT doc_id, {normalize('line')} AS result FROM lines",
    "page_plain_text": f"SELECT page_id, {plain('html', '')} AS plain_text FROM pages",
    "page_list_items": with_("pg_items", "pg_blocks")
    + """SELECT page_id, block_pos, item_pos, item FROM pg_items
        SEMI JOIN (SELECT * FROM pg_blocks WHERE kind = 'L') USING (page_id, block_pos)""",
    "section_headers": with_("ds_blocks")
    + "SELECT source, source_job_id, block_pos, kind, context, is_section FROM ds_blocks",
    "is_skill_header": with_("lines") + f"SELECT doc_id, regexp_matches(line, {q(HEADER)}) AS result FROM lines",
    "strip_bullets": with_("lines")
    + f"""SELECT doc_id, regexp_matches(line, {q(V.BULLET_PREFIX)}) AS is_bullet,
        trim({sub('line', V.BULLET_PREFIX, '')}, ' ') AS result FROM lines""",
    "section_items": with_("ds_items")
    + "SELECT source, source_job_id, block_pos, item_pos, is_section, item FROM ds_items",
    "requirement_section": with_("sections") + "SELECT source, source_job_id, section FROM sections",
    "text_reduction": with_("reductions")
    + "SELECT source, source_job_id, round(reduction_pct, 6) AS reduction_pct FROM reductions",
    "extract_terms": _TERMS,
    "extract_terms_by_join": _TERMS,
    "extract_years": with_("lines")
    + f"SELECT doc_id, {years('line', 1)} AS min_years, {years('line', 2)} AS max_years FROM lines",
    "parse_responses": with_("parsed")
    + json_lists("parsed", "source, source_job_id, extraction_status, min_years, max_years"),
    "clean_requirement_lists": with_("safe_responses")
    + f"""SELECT source, source_job_id, CAST(to_json(CASE WHEN json_type(safe, '$.technical_tools') = 'ARRAY'
        THEN list_filter(json_extract_string(safe, '$.technical_tools[*]'), lambda v: v IS NOT NULL
        AND lower({strip('v')}) NOT IN ({', '.join(q(v) for v in V.DROPPED_LIST_VALUES)})) ELSE [] END) AS VARCHAR) AS technical_tools
        FROM safe_responses""",
    "job_requirements": with_("requirements")
    + json_lists(
        "requirements", "source, source_job_id, min_years, max_years, seniority, extraction_status, error"
    ),
    "requirement_items": with_("items") + "SELECT * FROM items",
    "jobs_requiring_tool": with_("job_items")
    + """SELECT role_title, count(DISTINCT source || ':' || source_job_id) AS n_jobs FROM job_items
        WHERE item_value_norm = 'python' GROUP BY 1""",
    "topk_tools_by_role": with_("job_items")
    + f"""SELECT *, CAST(row_number() OVER (PARTITION BY role_title ORDER BY n_jobs DESC, tool) AS INTEGER) AS rank
        FROM ({by_role(V.TECHNICAL_TOOL, 'tool')}) QUALIFY rank <= 3""",
    "top_concepts_by_role": with_("job_items") + by_role(V.TECHNICAL_CONCEPT, "concept"),
    "certification_demand": with_("job_items", "jobs")
    + f"""SELECT d.*, round(d.n_jobs / t.n, 6) AS share FROM ({by_role(V.CERTIFICATION, 'certification')}) d
        JOIN (SELECT role_title, count(*) AS n FROM jobs GROUP BY 1) t USING (role_title)""",
    "role_distribution": with_("jobs") + "SELECT role_title, count(*) AS n FROM jobs GROUP BY 1",
    "match_method_distribution": with_("jobs") + "SELECT role_match_method, count(*) AS n FROM jobs GROUP BY 1",
    "extraction_status_counts": with_("parsed") + "SELECT extraction_status, count(*) AS n FROM parsed GROUP BY 1",
    "seniority_distribution": with_("requirements") + "SELECT seniority, count(*) AS n FROM requirements GROUP BY 1",
    "role_seniority": with_("requirements", "jobs")
    + """SELECT role_title, seniority, count(*) AS n FROM requirements JOIN jobs USING (source, source_job_id) GROUP BY ALL""",
    "experience_by_role": with_("requirements", "jobs")
    + """SELECT role_title, count(*) AS n_jobs, count(min_years) AS n_stated, min(min_years) AS least_years,
        max(max_years) AS most_years, round(avg(min_years), 4) AS mean_min_years
        FROM requirements JOIN jobs USING (source, source_job_id) GROUP BY 1""",
    "salary_by_role": with_("jobs")
    + """SELECT role_title, count(min_salary) AS n_stated, min(min_salary) AS lowest, max(max_salary) AS highest,
        round(avg(min_salary), 2) AS mean_min_salary, round(avg(max_salary), 2) AS mean_max_salary FROM jobs GROUP BY 1""",
    "postings_by_month": with_("jobs_raw") + _MONTHS.format(more=""),
    "postings_by_month_flagged": with_("jobs_raw")
    + _MONTHS.format(
        more=", strftime(created_at, '%b-%y') = (SELECT strftime(min(fetched_at), '%b-%y') FROM jobs_raw) AS has_first_fetch"
    ).replace("GROUP BY 1", "GROUP BY ALL"),
    "mapped_by_month": with_("jobs") + "SELECT strftime(posted_at, '%Y-%m') AS month, count(*) AS n FROM jobs GROUP BY 1",
    "first_fetch": with_("jobs_raw") + "SELECT CAST(min(fetched_at) AS VARCHAR) AS first_fetch FROM jobs_raw",
    "unmapped_rate": with_("meta_roles")
    + f"""SELECT count(*) FILTER (WHERE match_method = '{V.NO_MATCH}') AS n_unmapped, count(*) AS n_titles,
        round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE match_method = '{V.NO_MATCH}') / count(*), 2) AS unmapped_pct
        FROM meta_roles""",
    "length_histogram": with_("html_pages")
    + histogram(f"SELECT CAST(length({plain('html', '')}) AS DOUBLE) AS v FROM html_pages", 20),
    "reduction_histogram": with_("reductions")
    + histogram("SELECT reduction_pct AS v FROM reductions WHERE reduction_pct IS NOT NULL", 100),
    "role_similarity": with_("item_roles", "role_sizes")
    + """, shared AS (SELECT a.role_title AS from_role, b.role_title AS to_role, count(*) AS n_shared
        FROM item_roles a JOIN item_roles b ON a.item = b.item AND a.role_title <> b.role_title GROUP BY 1, 2)
        SELECT from_role, to_role, n_shared, f.size + t.size - n_shared AS n_union,
               round(n_shared / (f.size + t.size - n_shared), 6) AS jaccard
        FROM shared JOIN role_sizes f ON f.role_title = from_role JOIN role_sizes t ON t.role_title = to_role""",
    "career_gap": with_("item_roles")
    + """SELECT role_title AS to_role, item AS missing_item FROM item_roles
        WHERE item NOT IN (SELECT item FROM item_roles WHERE role_title = 'data analyst') GROUP BY ALL""",
    "role_skill_gap": with_("item_roles")
    + """SELECT f.role_title AS from_role, t.role_title AS to_role, t.item AS missing_item
        FROM (SELECT DISTINCT role_title FROM item_roles) f JOIN item_roles t ON f.role_title <> t.role_title
        WHERE NOT EXISTS (SELECT 1 FROM item_roles h WHERE h.role_title = f.role_title AND h.item = t.item)""",
    "limit_jobs": with_("jobs")
    + "SELECT source, source_job_id, job_title FROM jobs ORDER BY source, source_job_id LIMIT 10",
    "sample_unmapped": with_("meta_roles")
    + f"""SELECT source, source_job_id, job_title FROM meta_roles WHERE match_method = '{V.NO_MATCH}'
        ORDER BY md5('42:' || source || ':' || source_job_id), source, source_job_id LIMIT 20""",
}
ORACLE_SQL["init_catalog"] = with_("jobs_raw", "descriptions", "jobs", "requirements") + """
    SELECT 'jobs_raw' AS table_name, count(*) AS n_rows FROM jobs_raw
    UNION ALL SELECT 'descriptions_raw', count(*) FROM descriptions UNION ALL SELECT 'jobs', count(*) FROM jobs
    UNION ALL SELECT 'job_requirements', count(*) FROM requirements"""
ORACLE_SQL |= {
    f"rolled_up_{name}": ORACLE_SQL[whole]
    for name, whole in {
        "months": "postings_by_month",
        "first_fetch": "first_fetch",
        "roles": "role_distribution",
        "match_methods": "match_method_distribution",
        "mapped_months": "mapped_by_month",
        "seniority": "seniority_distribution",
        "tools": "top_tools_by_role",
        "requiring_tool": "jobs_requiring_tool",
    }.items()
}
ORACLE_SQL["rolled_up_extraction_status"] = (
    with_("requirements") + "SELECT extraction_status, count(*) AS n FROM requirements GROUP BY 1"
)
ORACLE_SQL["catalog_listing"] = f"""SELECT table_name,
    CASE table_name WHEN 'job_requirement_items' THEN 'view' ELSE 'table' END AS kind, n_rows
    FROM ({ORACLE_SQL["table_counts"]})"""
ORACLE_SQL["ingest_counts"] = ORACLE_SQL["ingest_metrics"]
ORACLE_SQL["quarantined_rows"] = with_("postings") + """
    SELECT 'source_job_id not null' AS broken_rule, count(*) AS n_rows, CAST(sum(seq) AS BIGINT) AS seq_sum
    FROM postings WHERE redirect_url IS NULL HAVING count(*) > 0"""
ORACLE_SQL["stored_jobs"] = ORACLE_SQL["curated_jobs"]
ORACLE_SQL["stored_requirements"] = ORACLE_SQL["job_requirements"]
ORACLE_SQL["stored_top_tools"] = ORACLE_SQL["top_tools_by_role"]
ORACLE_SQL["given_section_headers"] = with_("pg_blocks") + "SELECT page_id, block_pos, kind, context, is_section FROM pg_blocks"
ORACLE_SQL["given_section_items"] = with_("pg_items") + "SELECT page_id, block_pos, item_pos, is_section, item FROM pg_items"
ORACLE_SQL["catalog_overview"] = (
    ORACLE_SQL["table_counts"].replace("SELECT 'jobs_raw' AS", "SELECT 'default' AS schema_name, 'jobs_raw' AS")
    .replace("UNION ALL SELECT 'descriptions_raw',", "UNION ALL SELECT 'default', 'descriptions_raw',")
    .replace("UNION ALL SELECT 'jobs',", "UNION ALL SELECT 'default', 'jobs',")
    .replace("UNION ALL SELECT 'job_requirements',", "UNION ALL SELECT 'default', 'job_requirements',")
    .replace("UNION ALL SELECT 'job_requirement_items',", "UNION ALL SELECT 'default', 'job_requirement_items',")
)
