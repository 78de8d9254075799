"""DuckDB SQL that answers each registered query over the same tables.

Written on its own, in another regex dialect and mostly another formulation
(unnest and join instead of array functions), so that agreement means something.
"""

from __future__ import annotations

from legajo.functions import lexicon as L
from legajo.functions import redact as R
from legajo.functions import text as T
from legajo.functions.contract import CV_RULES, DEGREES, JD_RULES
from legajo.functions.errors import FATAL_CLASSES
from legajo.operators import requests as Q
from legajo.plans import corpora as C
from legajo.plans.queries import PRICE_PER_1K, SALT

ORACLE: dict[str, str] = {}

# What counts as personal data, in DuckDB's regex dialect.
EMAIL = r"\b[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.]+\b"
DNI = r"\b[0-9]{8}\b"
RUC = r"\b[0-9]{11}\b"
PHONE = r"\b(?:\+51\s?)?(?:9[0-9]{8}|[0-9]{7,8})\b"
WORDS = r"[\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)*[+#]*"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values) -> str:
    return ", ".join(map(quoted, values))


def sub(text: str, pattern: str, tag: str) -> str:
    return f"regexp_replace({text}, '{pattern}', {quoted(tag)}, 'g')"


def n_of(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


def short_first(text: str) -> str:
    words = rf"regexp_extract_all(split_part({text}, chr(10), 1), '\S+')"
    return f"len({words}) <= 5"


def named(text: str) -> str:
    """The text with a short first line replaced."""
    tag = quoted(R.NAME_TAG)
    return (
        f"CASE WHEN NOT ({short_first(text)}) THEN {text} WHEN contains({text}, chr(10)) "
        f"THEN {tag} || {text}[strpos({text}, chr(10)):] ELSE {tag} END"
    )


def joined(items: str) -> str:
    return f"coalesce(array_to_string({items}, '; '), '')"


def masked(source: str, *columns: str, lead: bool = False) -> str:
    """A query that adds text_anon to ``source`` (doc_id, text); ``lead`` drops blank leading lines."""
    extra = "".join(f", {c}" for c in columns)
    steps = sub(sub(sub(sub("text", EMAIL, R.EMAIL_TAG), DNI, R.DNI_TAG), RUC, R.RUC_TAG), PHONE, R.PHONE_TAG)
    if lead:
        steps = rf"regexp_replace({steps}, '^(?:[\t\x{{0b}}-\r\x{{1c}}-\x{{20}}\x{{85}}\p{{Z}}]*\n)+', '')"
    return (
        f"SELECT doc_id{extra}, {named('stepped')} AS text_anon "
        f"FROM (SELECT doc_id{extra}, {steps} AS stepped FROM ({source}))"
    )


DOCS = "SELECT doc_id, text FROM documents"

# Scans, sources, sinks

ORACLE["scan_documents"] = """
SELECT item_id, '.txt' AS suffix, 'text' AS kind, true AS parts_ok,
       CAST(octet_length(encode(text)) + 1 AS BIGINT) AS n_bytes, md5(text || chr(10)) AS digest
FROM benchmark"""

ORACLE["route_by_suffix"] = r"""
WITH n AS (
  SELECT p_partkey, replace(p_name, ' ', '-')
         || CASE p_partkey % 6 WHEN 0 THEN '.pdf' WHEN 1 THEN '.DOCX' WHEN 2 THEN '.doc'
            WHEN 3 THEN '.txt' WHEN 4 THEN '' ELSE '.tar.PDF' END AS name FROM part),
s AS (SELECT *, regexp_extract(name, '^.+(\.[^.]+)$', 1) AS suffix FROM n)
SELECT p_partkey, name, name[1:length(name) - length(suffix)] AS stem, suffix,
       CASE WHEN lower(suffix) = '.pdf' THEN 'pdf'
            WHEN lower(suffix) IN ('.doc', '.docx') THEN 'docx' ELSE 'text' END AS kind
FROM s"""

ORACLE["decode_text"] = """
WITH d AS (SELECT doc_id, CASE doc_id % 4 WHEN 3 THEN NULL WHEN 2 THEN chr(65279) || text ELSE text END AS t
           FROM documents)
SELECT doc_id, t IS NOT NULL AS decode_ok, CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS digest FROM d"""

ORACLE["assemble_pages"] = """
SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text
FROM conversations GROUP BY conv_id"""

ORACLE["assemble_paragraphs"] = """
SELECT conv_id,
       coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE turn % 3 <> 1 AND conv_id % 7 <> 0
                AND regexp_matches(text, '[^\\s]')), '') AS text
FROM conversations GROUP BY conv_id"""

ORACLE["write_documents_text"] = """
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, md5(text) AS digest FROM documents"""

# Masking

ORACLE["redact_email"] = f"SELECT doc_id, {sub('text', EMAIL, R.EMAIL_TAG)} AS text FROM ({C.CV_SQL})"
ORACLE["redact_dni"] = f"SELECT doc_id, {sub('text', DNI, R.DNI_TAG)} AS text FROM ({C.CV_SQL})"
ORACLE["redact_ruc"] = f"SELECT doc_id, {sub('text', RUC, R.RUC_TAG)} AS text FROM ({C.CV_SQL})"
ORACLE["redact_phone"] = f"SELECT doc_id, {sub('text', PHONE, R.PHONE_TAG)} AS text FROM ({C.CV_SQL})"
ORACLE["mask_name_line"] = f"SELECT doc_id, {named('text')} AS text FROM ({C.CV_SQL})"
ORACLE["anonymize"] = masked(DOCS)
ORACLE["anonymize_cvs"] = masked(C.CV_SQL)


def audit(source: str, by: str) -> str:
    final = " + ".join(n_of("t5", p) for p in (EMAIL, DNI, RUC, PHONE))
    return f"""
WITH a AS (SELECT {by}, text AS t0, {sub('text', EMAIL, R.EMAIL_TAG)} AS t1 FROM ({source})),
b AS (SELECT *, {sub('t1', DNI, R.DNI_TAG)} AS t2 FROM a),
c AS (SELECT *, {sub('t2', RUC, R.RUC_TAG)} AS t3 FROM b),
d AS (SELECT *, {sub('t3', PHONE, R.PHONE_TAG)} AS t4 FROM c),
e AS (SELECT *, {named('t4')} AS t5 FROM d)
SELECT {by}, count(*) AS docs,
       CAST(sum({n_of('t0', EMAIL)}) AS BIGINT) AS emails, CAST(sum({n_of('t1', DNI)}) AS BIGINT) AS dnis,
       CAST(sum({n_of('t2', RUC)}) AS BIGINT) AS rucs, CAST(sum({n_of('t3', PHONE)}) AS BIGINT) AS phones,
       count(*) FILTER (WHERE {short_first('t4')}) AS names, CAST(sum({final}) AS BIGINT) AS left_over
FROM e GROUP BY {by}"""


ORACLE["pii_audit"] = audit("SELECT source, text FROM documents", "source")
ORACLE["pii_audit_cvs"] = audit(f"SELECT doc_id % 5 AS grp, text FROM ({C.CV_SQL})", "grp")

# Projections and scalar functions

ORACLE["title_from_stem"] = r"""
WITH s AS (SELECT p_partkey, replace(p_name, ' ', CASE p_partkey % 2 WHEN 0 THEN '_' ELSE '-' END)
                  || '-o''ñ' || CAST(p_partkey AS VARCHAR) || 'ops' AS stem FROM part)
SELECT p_partkey, array_to_string(list_transform(
         regexp_extract_all(replace(replace(stem, '-', ' '), '_', ' '), '\p{L}+|\P{L}+'),
         lambda r: upper(r[1]) || lower(r[2:])), '') AS title
FROM s"""

ORACLE["truncate_text"] = f"""
WITH m AS ({masked(DOCS)})
SELECT doc_id, CAST(length(text_anon[1:{T.CV_CHARS}]) AS BIGINT) AS n_chars, text_anon[1:{T.CV_CHARS}] AS cut FROM m"""


def rid(key: str) -> str:
    h = f"md5('{SALT}|' || CAST({key} AS VARCHAR))"
    return f"{h}[1:8] || '-' || {h}[9:12] || '-' || {h}[13:16] || '-' || {h}[17:20] || '-' || {h}[21:32]"


ORACLE["record_id"] = f"SELECT c_custkey, {rid('c_custkey')} AS record_id FROM customer"


def request(source: str, system: str, template: str, values: list[str], max_tokens: int) -> str:
    parts = template.split("%s")
    user = quoted(parts[0])
    for value, part in zip(values, parts[1:]):
        user += f" || {value} || {quoted(part)}"
    return f"""
SELECT doc_id, {rid('doc_id')} AS record_id, {quoted(system)} AS system, {user} AS user,
       {max_tokens} AS max_tokens, CAST({Q.TEMPERATURE} AS DOUBLE) AS temperature
FROM ({source})"""


ORACLE["render_cv_request"] = request(
    masked(C.CV_SQL), Q.CV_SYSTEM, Q.CV_USER, [f"text_anon[1:{T.CV_CHARS}]", f"({rid('doc_id')})"], Q.CV_MAX_TOKENS
)
ORACLE["render_jd_request"] = request(
    C.JD_SQL, Q.JD_SYSTEM, Q.JD_USER, ["title", f"text[1:{T.JD_CHARS}]", f"({rid('doc_id')})"], Q.JD_MAX_TOKENS
)

TOKENS = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\t-\r\x{1c}-\x{20}\x{85}\p{Z}]"
ORACLE["request_payloads"] = f"""
SELECT doc_id, 'system' AS first_role, md5("user") AS user_digest, max_tokens, 'modelo-1' AS model
FROM ({ORACLE['render_cv_request']})"""

ORACLE["token_estimate"] = f"SELECT doc_id, {n_of('text', TOKENS)} AS tokens FROM documents"

ORACLE["title_fallback"] = f"""
WITH t AS (SELECT p_partkey, p_type, CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN {quoted(T.NO_TITLE)}
                  WHEN 2 THEN ' ' WHEN 3 THEN p_name END AS read FROM part)
SELECT p_partkey, coalesce(nullif(nullif(read, ''), {quoted(T.NO_TITLE)}), p_type) AS title FROM t"""

ORACLE["list_preview"] = """
SELECT doc_id, array_to_string(string_split(text, ' ')[1:5], ', ') AS preview FROM documents"""

ORACLE["line_preview"] = f"""
WITH m AS ({masked(DOCS)})
SELECT doc_id, array_to_string(string_split(regexp_replace(text_anon, '\\n\\z', ''), chr(10))[1:5], chr(10)) AS preview
FROM m"""

# Joins, aggregates, windows

ORACLE["correlate_responses"] = f"""
WITH q AS (SELECT c_custkey AS doc_id, 'rid-' || CAST(c_custkey AS VARCHAR) AS record_id FROM customer),
r AS (SELECT {C.REPLY_DOC} AS doc_id, {C.REPLY_ECHO} AS rid FROM customer)
SELECT coalesce(r.doc_id, q.doc_id) AS doc_id, record_id, rid,
       CASE WHEN r.doc_id IS NULL THEN 'unanswered' WHEN q.doc_id IS NULL THEN 'unknown'
            WHEN rid = record_id THEN 'matched' ELSE 'id_mismatch' END AS status
FROM q FULL JOIN r ON q.doc_id = r.doc_id"""

ORACLE["token_rollup"] = f"""
WITH m AS ({masked('SELECT doc_id, text, lang FROM documents', 'lang')}),
t AS (SELECT lang, {n_of(f'text_anon[1:{T.CV_CHARS}]', TOKENS)} AS tokens FROM m)
SELECT lang, count(*) AS requests, CAST(sum(tokens) AS BIGINT) AS tokens_total, avg(tokens) AS tokens_mean,
       max(tokens) AS tokens_max, CAST(sum(tokens) AS DOUBLE) / 1000 * CAST({PRICE_PER_1K} AS DOUBLE) AS cost
FROM t GROUP BY lang"""

FATAL = (
    f"(error_class IN ({listed(FATAL_CLASSES)}) OR lower(message) LIKE '%api\\_key%' ESCAPE '\\' "
    "OR lower(message) LIKE '%authentication%')"
)
VERDICT = f"CASE WHEN error_class IS NULL THEN 'success' WHEN {FATAL} THEN 'fatal' ELSE 'retryable' END"

ORACLE["resolve_attempts"] = f"""
WITH n AS (SELECT user_id, day, error_class, message, {VERDICT} AS verdict,
             row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS i FROM ({C.ATTEMPTS_SQL})),
f AS (SELECT user_id, day, min(i) FILTER (WHERE verdict <> 'retryable') AS stop, least(max(i), 3) AS last
      FROM n WHERE i <= 3 GROUP BY user_id, day),
e AS (SELECT f.*, n.verdict, n.error_class, n.message
      FROM f JOIN n ON f.user_id = n.user_id AND f.day = n.day AND coalesce(f.stop, f.last) = n.i)
SELECT user_id, day,
       CASE WHEN verdict = 'success' THEN 'ok' WHEN verdict = 'fatal' THEN 'fatal'
            WHEN last = 3 THEN 'exhausted' ELSE 'pending' END AS outcome,
       CAST(coalesce(stop, last) AS BIGINT) AS attempts,
       CAST(CASE coalesce(stop - 1, CASE last WHEN 3 THEN 2 ELSE last END)
            WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 6 END AS BIGINT) AS wait_s,
       error_class, message
FROM e"""

ORACLE["classify_error"] = f"SELECT event_id, {VERDICT} AS verdict FROM ({C.ATTEMPTS_SQL})"

# JSON and validation

_JSON = "WITH j AS (SELECT doc_id, body, TRY_CAST(body AS JSON) AS v FROM ({source}))"


def is_string(value: str) -> str:
    return f"coalesce(json_type({value}) = 'VARCHAR', false)"


def number_of(name: str) -> str:
    text = f"trim(v->>'$.{name}')"
    return (
        f"CASE WHEN json_type(v, '$.{name}') IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN TRY_CAST(v->>'$.{name}' AS DOUBLE) "
        f"WHEN json_type(v, '$.{name}') = 'BOOLEAN' THEN CASE v->>'$.{name}' WHEN 'true' THEN 1.0 ELSE 0.0 END "
        f"WHEN json_type(v, '$.{name}') = 'VARCHAR' AND regexp_full_match({text}, '[+-]?[0-9][0-9_]*(\\.[0-9]*)?') "
        f"THEN TRY_CAST(replace({text}, '_', '') AS DOUBLE) END"
    )


def passes(rule) -> str:
    kind = f"json_type(v, '$.{rule.name}')"
    items = f"CAST(json_extract(v, '$.{rule.name}') AS JSON[])"
    if rule.kind in ("str", "enum"):
        ok = f"{kind} = 'VARCHAR'"
        if rule.values:
            ok += f" AND v->>'$.{rule.name}' IN ({listed(rule.values)})"
    elif rule.kind == "float":
        ok = f"({number_of(rule.name)}) >= {rule.minimum if rule.minimum is not None else '-1e308'}"
    else:
        whole = (
            is_string("i") if rule.kind == "list_str"
            else " AND ".join(is_string(f"json_extract(i, '$.{m}')") for m in rule.members)
        )
        ok = (
            f"CASE WHEN {kind} = 'ARRAY' THEN "
            f"len(list_filter({items}, lambda i: NOT ({whole}))) = 0 ELSE false END"
        )
    if rule.optional:
        ok = f"({kind} IS NULL OR ({ok}))"
    return f"coalesce({ok}, false)"


def errors(rules) -> str:
    cases = ", ".join(f"CASE WHEN NOT {passes(r)} THEN '{r.name}' END" for r in rules)
    return (
        f"CASE WHEN coalesce(json_type(v), '') <> 'OBJECT' THEN 'json' "
        f"ELSE {joined(f'list_filter([{cases}], lambda e: e IS NOT NULL)')} END"
    )


def languages(field: str) -> str:
    pair = "(i->>'$.idioma') || '=' || (i->>'$.nivel')"
    return joined(f"list_transform(CAST(json_extract(v, '$.{field}') AS JSON[]), lambda i: {pair})")


REPLIES = _JSON.format(source=C.REPLIES_SQL)

ORACLE["parse_response"] = f"""
{REPLIES}
SELECT doc_id, coalesce(json_type(v) = 'OBJECT', false) AS is_json, v->>'$.candidato_id' AS candidato_id,
       v->>'$.nivel_experiencia' AS nivel_experiencia, {number_of('anos_experiencia')} AS anos_experiencia,
       CASE WHEN v IS NOT NULL THEN {languages('idiomas')} END AS idiomas, v->>'$.resumen_perfil' AS resumen_perfil
FROM j"""

ORACLE["validate_cv"] = f"{REPLIES} SELECT doc_id, {errors(CV_RULES)} AS errors FROM j"

ORACLE["validate_jd"] = f"""
{_JSON.format(source=f"SELECT p_partkey AS doc_id, {C.JD_REPLY_BODY} AS body FROM part")},
e AS (SELECT doc_id, v, {errors(JD_RULES)} AS errors FROM j)
SELECT doc_id, errors, CASE WHEN errors = '' THEN {number_of('anos_experiencia_min')} END AS years,
       CASE WHEN errors = '' THEN v->>'$.titulo_puesto' END AS title
FROM e"""

ORACLE["split_quarantine"] = f"""
{REPLIES}, e AS (SELECT doc_id, body, {errors(CV_RULES)} AS errors FROM j)
SELECT doc_id, CASE errors WHEN '' THEN 'good' ELSE 'quarantine' END AS side,
       CASE WHEN errors <> '' THEN body END AS raw, errors FROM e"""

ORACLE["write_records_json"] = f"""
{REPLIES}, e AS (SELECT v, {errors(CV_RULES)} AS errors FROM j)
SELECT v->>'$.candidato_id' AS candidato_id, v->>'$.nivel_experiencia' AS nivel_experiencia,
       {number_of('anos_experiencia')} AS anos_experiencia,
       {joined("CAST(v->'$.skills_tecnicos' AS VARCHAR[])")} AS skills_tecnicos,
       CAST(0 AS BIGINT) AS n_certificaciones, {languages('idiomas')} AS idiomas,
       v->>'$.resumen_perfil' AS resumen_perfil
FROM e WHERE errors = ''"""

ORACLE["jd_records_from_replies"] = f"""
{_JSON.format(source=f"SELECT p_partkey AS doc_id, {C.JD_REPLY_BODY} AS body FROM part")},
e AS (SELECT doc_id, v, {errors(JD_RULES)} AS errors FROM j),
s AS (SELECT p_partkey AS doc_id, p_name, CASE WHEN p_partkey % 13 = 0 THEN 'unanswered'
      WHEN {C.JD_REPLY_ECHO} = 'rid-' || CAST(p_partkey AS VARCHAR) THEN 'matched' ELSE 'id_mismatch' END AS status FROM part)
SELECT doc_id, status, CASE status WHEN 'matched' THEN errors ELSE status END AS errors,
       CASE WHEN status = 'matched' AND errors = '' THEN coalesce(nullif(nullif(v->>'$.titulo_puesto', ''), {quoted(T.NO_TITLE)}), p_name) END AS title,
       CASE WHEN status = 'matched' AND errors = '' THEN {number_of('anos_experiencia_min')} END AS years
FROM e JOIN s USING (doc_id)"""

ORACLE["cv_records_from_replies"] = f"""
WITH n AS (SELECT doc_id, i, {VERDICT} AS verdict FROM ({C.TRIES_SQL}) WHERE i <= 3),
f AS (SELECT doc_id, min(i) FILTER (WHERE verdict <> 'retryable') AS stop, max(i) AS last FROM n GROUP BY doc_id),
o AS (SELECT f.doc_id, CASE WHEN stop IS NULL AND last = 3 THEN 'exhausted' WHEN stop IS NULL THEN 'pending' WHEN verdict = 'fatal' THEN 'fatal' ELSE 'ok' END AS outcome,
             coalesce(stop, last)::BIGINT AS attempts,
             (2 ** (1 + CASE WHEN stop IS NULL AND last < 3 THEN last ELSE coalesce(stop, last) - 1 END) - 2)::BIGINT AS wait_s
      FROM f LEFT JOIN n ON n.doc_id = f.doc_id AND n.i = f.stop),
sent AS (SELECT * FROM (SELECT {C.REPLY_DOC} AS doc_id, {C.K} AS k, {C.REPLY_ECHO} AS rid, {C.CV_REPLY} AS body FROM customer) WHERE body IS NOT NULL),
met AS (SELECT doc_id, body, CASE WHEN doc_id < 0 THEN 'unknown' WHEN rid = 'rid-' || k::VARCHAR THEN 'matched' ELSE 'id_mismatch' END AS status FROM sent
        UNION ALL SELECT {C.K}, NULL, 'unanswered' FROM customer WHERE {C.K} NOT IN (SELECT doc_id FROM sent)),
j AS (SELECT met.doc_id, body, attempts, wait_s, CASE WHEN outcome <> 'ok' THEN outcome ELSE status END AS status, TRY_CAST(body AS JSON) AS v FROM met LEFT JOIN o USING (doc_id)),
e AS (SELECT *, CASE status WHEN 'matched' THEN {errors(CV_RULES)} ELSE status END AS errors FROM j)
SELECT CASE errors WHEN '' THEN 'good' ELSE 'quarantine' END AS side, CASE errors WHEN '' THEN v->>'$.candidato_id' ELSE doc_id::VARCHAR END AS key,
       status, CASE WHEN errors <> '' THEN attempts END AS attempts, CASE WHEN errors <> '' THEN wait_s END AS wait_s, errors,
       CASE WHEN errors = '' THEN {number_of('anos_experiencia')} END AS years, CASE WHEN errors <> '' THEN md5(body) END AS digest
FROM e"""

ORACLE["title_or_stem"] = """
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE (
         SELECT string_agg(upper(w[1]) || lower(w[2:]), ' ' ORDER BY i)
         FROM (SELECT unnest(string_split('puesto ' || p_name, ' ')) AS w,
                      generate_subscripts(string_split('puesto ' || p_name, ' '), 1) AS i)) END AS title
FROM part"""

ORACLE["fatal_reason"] = f"""
SELECT event_id, CASE WHEN {VERDICT} <> 'fatal' THEN NULL WHEN lower(message) LIKE '%api\\_key%' ESCAPE '\\'
       OR lower(message) LIKE '%authentication%' THEN 'key'
       WHEN error_class = 'BadRequestError' THEN 'request' ELSE 'reply' END AS reason
FROM ({C.ATTEMPTS_SQL})"""

# Extraction


def folded(text: str) -> str:
    return f"upper(strip_accents({text}))"


def plain(text: str) -> str:
    return f"replace(replace({text}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"


def part_names(part: str) -> str:
    return ", ".join(folded(quoted(name)) for name in L.SECTIONS[part])


def lines_of(source: str, text: str = "text", known: bool = False) -> str:
    """CTEs ending in ``tagged`` (doc_id, pos, line, section) and ``body`` without headings."""
    is_head = r"(regexp_matches(line, '^[\p{Lu} ]+:?$') AND regexp_matches(line, '(?:\p{Lu} *){4}'))"
    name = "trim(rtrim(line, ':'))"
    if known:
        name = folded("trim(rtrim(trim(line), ':'))")
        names = ", ".join(map(part_names, L.SECTIONS))
        is_head = f"(({is_head} AND line LIKE '%:') OR {name} IN ({names}))"
    return rf"""
src AS (SELECT * REPLACE ({plain(text)} AS {text}) FROM ({source})),
ln AS (SELECT doc_id, unnest(string_split({text}, chr(10))) AS line,
              generate_subscripts(string_split({text}, chr(10)), 1) - 1 AS pos FROM src),
tagged AS (SELECT doc_id, pos, line, last_value(CASE WHEN {is_head} THEN {name} END IGNORE NULLS)
             OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS section FROM ln),
body AS (SELECT * FROM tagged WHERE NOT {is_head})"""


_TAGGED = "SELECT doc_id, CAST(pos AS BIGINT) AS pos, line, section FROM tagged"
ORACLE["tag_sections"] = f"WITH {lines_of(f'SELECT doc_id, text FROM ({C.JD_SQL})')} {_TAGGED}"
ORACLE["tag_sections_documents"] = f"WITH {lines_of(DOCS)} {_TAGGED}"


# Where the headings stand in the same CVs written with known ones.
_PARTS = "CASE " + " ".join(f"WHEN section IN ({part_names(p)}) THEN '{p}'" for p in L.SECTIONS) + " ELSE 'lead' END"
ORACLE["segment_sections"] = f"""
WITH {lines_of(C.PLAIN_CV_SQL, known=True)}
SELECT doc_id, min(pos)::INT AS start, {_PARTS} AS part FROM tagged GROUP BY doc_id, section"""


def grams(source: str, text: str = "text") -> str:
    """CTEs ending in ``grams`` (doc_id, term): runs of one to three words."""
    return f"""
toks AS (SELECT doc_id, regexp_extract_all(lower({text}), '{WORDS}') AS w FROM ({source})),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM toks),
grams AS (SELECT DISTINCT doc_id, unnest([w[i], w[i] || ' ' || w[i + 1], w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]]) AS term
          FROM pos)"""


def terms_values(lexicon) -> str:
    return "(VALUES " + ", ".join(f"({quoted(t)}, {quoted(c)})" for t, c in lexicon.items()) + ") AS x(term, category)"


def hits(category: str) -> str:
    return f"coalesce(string_agg(term, '; ' ORDER BY term) FILTER (WHERE category = '{category}'), '')"


_CATEGORIES = list(dict.fromkeys(L.TERMS.values()))
ORACLE["extract_terms"] = f"""
WITH {grams(C.CV_SQL)},
found AS (SELECT doc_id, term, category FROM grams JOIN {terms_values(L.TERMS)} USING (term))
SELECT s.doc_id, {', '.join(f'{hits(c)} AS {c}' for c in _CATEGORIES)}
FROM ({C.CV_SQL}) s LEFT JOIN found f ON s.doc_id = f.doc_id GROUP BY s.doc_id"""

ORACLE["extract_terms_table"] = f"""
WITH {grams(C.JD_SQL)},
lex AS (SELECT DISTINCT lower(p_type) AS term, 'rubro' AS category FROM part
        UNION SELECT DISTINCT CAST(p_size % 9 AS VARCHAR) || '+ años', 'plazo' FROM part),
found AS (SELECT doc_id, term, category FROM grams JOIN lex USING (term))
SELECT s.doc_id, {hits('rubro')} AS rubro, {hits('plazo')} AS plazo
FROM ({C.JD_SQL}) s LEFT JOIN found f ON s.doc_id = f.doc_id GROUP BY s.doc_id"""


def years(text: str = "text") -> str:
    found = rf"regexp_extract_all({text}, '(?i)([0-9]+(?:[.,][0-9]+)?)\+?\s+años', 1)"
    return f"coalesce(list_max(list_transform({found}, lambda y: CAST(replace(y, ',', '.') AS DOUBLE))), 0.0)"


def level(value: str) -> str:
    arms = " ".join(f"WHEN {value} < {b} THEN '{n}'" for b, n in L.LEVEL_BOUNDS)
    return f"CASE {arms} ELSE '{L.TOP_LEVEL}' END"


ORACLE["extract_years"] = f"SELECT doc_id, {years()} AS years FROM ({C.CV_SQL})"
ORACLE["infer_level"] = f"SELECT doc_id, {level(years())} AS level FROM ({C.JD_SQL})"


def education(source: str, text: str = "text") -> str:
    ranks = ", ".join(f"({quoted(w)}, {quoted(d)}, {DEGREES.index(d)})" for w, d in L.DEGREE_WORDS.items())
    return f"""
SELECT t.doc_id, arg_max(degree, r) AS highest, arg_min(degree, r) AS lowest
FROM ({source}) t
LEFT JOIN (SELECT doc_id, unnest(regexp_extract_all(lower({text}), '{WORDS}')) AS word FROM ({source})) w
  ON t.doc_id = w.doc_id AND word IN ({listed(L.DEGREE_WORDS)})
LEFT JOIN (VALUES {ranks}) AS d(word, degree, r) ON w.word = d.word GROUP BY t.doc_id"""


ORACLE["extract_education"] = (
    f"SELECT *, 'cv' AS kind FROM ({education(C.CV_SQL)}) UNION ALL SELECT *, 'jd' FROM ({education(C.JD_SQL)})"
)

_PAIR = r"^[\s-]*(\p{L}[\p{L} ]*?)\s*:\s*([^(:]*[^(:\s])\s*(?:\(.*)?$"
_DATED = r"^[0-9]{4}\s*-\s*[\p{L}\p{N}]+\s*:\s*(\S.*?)\s+—\s+\S"
_BULLET = r"^\s*[-•]\s*(.*\S)\s*$"


def ordered(value: str, where: str) -> str:
    return f"coalesce(string_agg({value}, '; ' ORDER BY pos) FILTER (WHERE {where}), '')"


def dated(part: str) -> str:
    inside = f"section IN ({part_names(part)}) AND regexp_matches(line, '{_DATED}')"
    return ordered(f"regexp_extract(line, '{_DATED}', 1)", inside)


PAIRS = f"""
items AS (SELECT doc_id, unnest(string_split(line, '|')) AS item, pos * 100 + generate_subscripts(string_split(line, '|'), 1) AS pos
          FROM body WHERE section IN ({part_names('languages')})),
pairs AS (SELECT doc_id, pos, regexp_extract(item, '{_PAIR}', 1) || '=' || regexp_extract(item, '{_PAIR}', 2) AS pair
          FROM items WHERE regexp_matches(item, '{_PAIR}'))"""

_CV_TEXT = f"SELECT doc_id, text FROM ({C.CV_SQL})"
_JD_TEXT = f"SELECT doc_id, text FROM ({C.JD_SQL})"

ORACLE["extract_languages"] = f"""
WITH {lines_of(_CV_TEXT, known=True)}, {PAIRS}
SELECT s.doc_id, coalesce(string_agg(pair, '; ' ORDER BY pos), '') AS languages
FROM src s LEFT JOIN pairs p ON s.doc_id = p.doc_id GROUP BY s.doc_id"""

_MENTION = rf"(?i)\b({'|'.join(L.LANGUAGES)})[ \t]*:?[ \t]+([abc][12]|nativo|básico|intermedio|avanzado)\b"
MENTIONS = joined(
    f"list_transform(regexp_extract_all(text, '{_MENTION}'), "
    f"lambda m: regexp_extract(m, '{_MENTION}', 1) || '=' || regexp_extract(m, '{_MENTION}', 2))"
)
ORACLE["language_mentions"] = f"SELECT doc_id, {MENTIONS} AS languages FROM ({C.JD_SQL})"

ORACLE["extract_positions"] = f"""
WITH {lines_of(_CV_TEXT, known=True)} SELECT doc_id, {dated('experience')} AS positions FROM body GROUP BY doc_id"""

ORACLE["extract_careers"] = f"""
WITH {lines_of(_CV_TEXT, known=True)} SELECT doc_id, {dated('education')} AS careers FROM body GROUP BY doc_id"""


def bullets(part: str) -> str:
    inside = f"section IN ({part_names(part)}) AND regexp_matches(line, '{_BULLET}')"
    return ordered(f"regexp_extract(line, '{_BULLET}', 1)", inside)


def technical(items: str) -> str:
    """Technical terms in a '; '-joined list of items."""
    text = f"lower(replace({items}, '; ', ' | '))"
    tokens = f"regexp_extract_all({text}, '{WORDS}')"
    joined_words = f"' ' || array_to_string({tokens}, ' ') || ' '"
    known = f"[{listed(sorted(L.TECHNICAL))}]"
    return joined(f"list_filter({known}, lambda t: contains({joined_words}, ' ' || t || ' '))")


ORACLE["split_requirements"] = f"""
WITH {lines_of(_JD_TEXT, known=True)},
b AS (SELECT doc_id, {bullets('mandatory')} AS must_items, {bullets('desirable')} AS nice_items FROM body GROUP BY doc_id)
SELECT doc_id, must_items, nice_items, {technical('must_items')} AS must_skills, {technical('nice_items')} AS nice_skills
FROM b"""

_TITLE = r"(?im)^(?:posición|puesto|cargo|título)[ \t]*:[ \t]*(\S.*)$"
JOB_TITLE = f"coalesce(nullif(nullif(trim(regexp_extract(text, '{_TITLE}', 1)), ''), {quoted(T.NO_TITLE)}), title)"
ORACLE["extract_job_title"] = f"SELECT doc_id, {JOB_TITLE} AS job_title FROM ({C.JD_SQL})"


def sentence_list(text: str) -> str:
    blank = r"[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]"
    cut = rf"regexp_replace(trim({text}), '([.!?]){blank}+|{blank}*\n{blank}*', '\1' || chr(1), 'g')"
    return f"string_split({cut}, chr(1))"


# Lines that may say who or where somebody is.
PRIVATE = (
    r"regexp_matches(line, '@|(?:EMAIL|DNI|RUC|TELEFONO)_REDACTADO\]|[0-9]{6}|^[^\p{L}]*\[NOMBRE_REDACTADO\][^\p{L}]*$')"
    r" OR regexp_matches(line, '(?i)^[^\p{L}]*(?:(?:av|avenida|jr|jirón|ca|calle|psje|pasaje|urb|urbanización|mz|carretera)(?:\.\s*|\s+)\p{L}|(?:dirección|domicilio|nombres?|apellidos?)\s*:)')"
    r" OR regexp_matches(line, '^\s*(?:\p{Lu}(?:\.|[\p{L}-]*)|\[NOMBRE_REDACTADO\])(?:,? +(?:(?:de|del|la|las|los|y) +)*(?:\p{Lu}(?:\.|[\p{L}-]*)|\[NOMBRE_REDACTADO\])){1,5}\s*$')"
)


def leading(part: str, bare: bool = False) -> str:
    """Leading sentences of the part's prose from body and src; with ``bare`` of the whole where there is no heading."""
    inside = f"section IN ({part_names(part)})"
    if bare:
        inside += " OR doc_id NOT IN (SELECT doc_id FROM tagged WHERE section IS NOT NULL)"
    full = r"regexp_matches(line, '[^\t-\r\x{1c}-\x{20}\x{85}\p{Z}]')"
    if part == "profile" and not bare:
        full += f" AND NOT ({PRIVATE})"
    return f"""
prose AS (SELECT *, regexp_matches(line, '{_BULLET}') AS item FROM body WHERE ({inside}) AND {full}),
lead AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT item),
           string_agg(regexp_extract(line, '{_BULLET}', 1), chr(10) ORDER BY pos)) AS words FROM prose GROUP BY doc_id),
summed AS (SELECT s.doc_id, coalesce(array_to_string(({sentence_list('words')})[1:3], ' '), '') AS summary FROM src s LEFT JOIN lead l ON s.doc_id = l.doc_id)"""


for _name, _source in (("summarize", DOCS), ("summarize_cvs", _CV_TEXT)):
    ORACLE[_name] = f"WITH {lines_of(_source, known=True)}, {leading('profile', _name == 'summarize')} SELECT * FROM summed"

# Two sentences: the one with the heaviest words, then the one that adds most to it.
_RANKED = f"""
cut AS (SELECT doc_id, {sentence_list('words')} AS parts FROM lead),
said AS (SELECT doc_id, unnest(parts) AS s, generate_subscripts(parts, 1) AS nth FROM cut),
toks AS (SELECT DISTINCT doc_id, nth, w FROM (SELECT doc_id, nth, unnest(regexp_extract_all(lower(s), '{WORDS}')) AS w FROM said)),
weights AS (SELECT w, floor(1000 * ln((SELECT count(*) FROM src)::DOUBLE / count(DISTINCT doc_id)))::BIGINT AS weight FROM toks GROUP BY w),
weighed AS (SELECT * FROM toks JOIN weights USING (w)),
gains AS (SELECT doc_id, nth, 1000 * sum(weight) // count(*) AS gain FROM weighed GROUP BY ALL),
firsts AS (SELECT doc_id, nth FROM gains QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY gain DESC, nth) = 1),
taken AS (SELECT doc_id, w, true AS had FROM toks JOIN firsts USING (doc_id, nth)),
added AS (SELECT doc_id, x.nth, 1000 * coalesce(sum(weight) FILTER (had IS NULL), 0) // count(*) AS gain
          FROM weighed x LEFT JOIN taken USING (doc_id, w) JOIN firsts f USING (doc_id) WHERE x.nth <> f.nth GROUP BY ALL),
picks AS (SELECT * FROM firsts UNION ALL
          (SELECT doc_id, nth FROM added QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY gain DESC, nth) = 1)),
ranked AS (SELECT doc_id, string_agg(s, ' ' ORDER BY nth) AS summary FROM said JOIN picks USING (doc_id, nth) GROUP BY doc_id)
SELECT doc_id, coalesce(summary, '') AS summary FROM src LEFT JOIN ranked USING (doc_id)"""
for _name, _source in (("summarize_ranked", DOCS), ("summarize_ranked_cvs", _CV_TEXT)):
    ORACLE[_name] = f"WITH {lines_of(_source, known=True)}, {leading('profile', _name == 'summarize_ranked')}, {_RANKED}"

_MONTH_NAMES = "ene feb mar abr may jun jul ago set oct nov dic"
_MONTH = "(?:(ene|feb|mar|abr|may|jun|jul|ago|sep|set|oct|nov|dic)[a-z]*\\.?\\s*(?:del?\\s+)?|([0-9]{1,2})\\s*[/.]\\s*)?((?:19|20)[0-9]{2})"
_SPAN = f"(?i)^[\\s•*-]*(?:desde\\s+)?{_MONTH}\\s*(?:-|–|—|a|al|hasta)\\s*(?:(?:la\\s+)?(actualidad|actualmente|actual|presente|hoy|fecha)|{_MONTH})(?:[^\\p{{L}}\\p{{N}}_]|$)"


def experience() -> str:
    """CTEs from body and src ending in ``worked`` (doc_id, jobs, months): islands of overlapping spans."""
    g = lambda i: f"regexp_extract(line, '{_SPAN}', {i})"
    number = lambda name, n: f"""CASE WHEN {name} <> '' THEN list_position(string_split('{_MONTH_NAMES}', ' '), replace(lower({name}), 'sep', 'set')) - 1
        WHEN {n} <> '' THEN CASE WHEN {n}::INT BETWEEN 1 AND 12 THEN {n}::INT - 1 END"""
    now = f"(year(DATE '{C.AS_OF}') * 12 + month(DATE '{C.AS_OF}') - 1)"
    return f"""
dates AS (SELECT doc_id, {g(1)} AS n1, {g(2)} AS m1, {g(3)} AS y1, {g(4)} AS still, {g(5)} AS n2, {g(6)} AS m2, {g(7)} AS y2
          FROM body WHERE section IN ({part_names('experience')}) AND regexp_matches(line, '{_SPAN}')),
ends AS (SELECT doc_id, y1::INT * 12 + {number('n1', 'm1')} ELSE 0 END AS s, still <> '' AS still, n2 || m2 = '' AS whole,
         nullif(y2, '')::INT * 12 AS y, {number('n2', 'm2')} END AS m FROM dates),
spans AS (SELECT doc_id, s, CASE WHEN still THEN {now} WHEN whole AND y > s THEN y WHEN whole THEN y + 12 ELSE y + m + 1 END AS e FROM ends),
clipped AS (SELECT doc_id, s, CASE WHEN e > {now} THEN {now} ELSE e END AS e FROM spans WHERE s IS NOT NULL AND e IS NOT NULL AND e > s),
good AS (SELECT * FROM clipped WHERE e > s),
opened AS (SELECT *, coalesce(s > max(e) OVER (PARTITION BY doc_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS new FROM good),
islands AS (SELECT doc_id, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island, s, e FROM opened),
joined AS (SELECT doc_id, island, max(e) - min(s) AS months, count(*) AS jobs FROM islands GROUP BY ALL),
worked AS (SELECT src.doc_id, coalesce(sum(jobs), 0)::BIGINT AS jobs, coalesce(sum(months), 0)::BIGINT AS months
           FROM src LEFT JOIN joined USING (doc_id) GROUP BY src.doc_id)"""


_FREE = f"SELECT doc_id, text FROM ({C.FREE_CV_SQL})"
ORACLE["experience_from_jobs"] = f"""
WITH {lines_of(_FREE, known=True)}, {experience()} SELECT *, round(months / 12, 1) AS years FROM worked"""

_TOKENS = r"regexp_extract_all(stepped, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+')"
_NO_NAMES = f"'NOMBRE', {', '.join(map(part_names, ('profile', 'experience', 'education', 'languages')))}"


def without_names(source: str, breaks: bool = False) -> str:
    """A query (doc_id, text_anon): token by token, those of the text's names become tags and runs of tags one."""
    steps = sub(sub(sub(sub(plain("text") if breaks else "text", EMAIL, R.EMAIL_TAG), DNI, R.DNI_TAG), RUC, R.RUC_TAG), PHONE, R.PHONE_TAG)
    given = rf"regexp_replace(split_part(stepped, chr(10), 1), '^Nombre: ', '')"
    words = rf"list_transform(regexp_extract_all({given}, '\p{{Lu}}\p{{L}}{{2,}}'), lambda w: {folded('w')})"
    tag = R.NAME_TAG
    bare = tag.strip("[]")
    masked_tokens = rf"list_transform({_TOKENS}, lambda t: CASE WHEN regexp_matches(t, '^\p{{Lu}}') AND list_contains(words, {folded('t')}) THEN '{tag}' ELSE t END)"
    tags = rf"regexp_replace(array_to_string({masked_tokens}, ''), '\[{bare}\](?: +(?:(?i:de|del|la|las|los|y) +)*\[{bare}\])+', '{tag}', 'g')"
    return (
        f"SELECT doc_id, text, {named('stepped')} AS text_anon FROM (SELECT doc_id, text, {tags} AS stepped FROM ("
        f"SELECT *, {words} AS words FROM (SELECT doc_id, text, {steps} AS stepped FROM ({source}))))"
    )


ORACLE["mask_names"] = rf"""
SELECT doc_id, len(regexp_extract_all(text_anon, '\[NOMBRE_REDACTADO\]'))::BIGINT AS tags, md5(text_anon) AS digest
FROM ({without_names(_FREE)})"""


def cv_records(masked_texts: str, said: str) -> str:
    return f"""
WITH {lines_of(masked_texts, 'text_anon', known=True)}, {leading('profile')}, {PAIRS}, {experience()},
{grams(masked_texts, 'text_anon')},
found AS (SELECT doc_id, term, category FROM grams JOIN {terms_values(L.TERMS)} USING (term)),
terms AS (SELECT doc_id, {', '.join(f'{hits(c)} AS {c}' for c in _CATEGORIES)} FROM found GROUP BY doc_id),
langs AS (SELECT doc_id, string_agg(pair, '; ' ORDER BY pos) AS languages FROM pairs GROUP BY doc_id),
jobs AS (SELECT doc_id, {dated('experience')} AS positions, {dated('education')} AS careers FROM body GROUP BY doc_id),
grade AS ({education(masked_texts, 'text_anon')}),
yrs AS (SELECT doc_id, greatest({said}, round(months / 12, 1)) AS years FROM src JOIN worked USING (doc_id))
SELECT src.doc_id, {rid('src.doc_id')} AS candidato_id, {level('years')} AS nivel_experiencia, years AS anos_experiencia,
       coalesce(tecnico, '') AS skills_tecnicos, coalesce(blando, '') AS skills_blandos,
       coalesce(industria, '') AS industrias, coalesce(positions, '') AS cargos_anteriores,
       highest AS nivel_educacion, coalesce(careers, '') AS carreras, coalesce(certificacion, '') AS certificaciones,
       coalesce(languages, '') AS idiomas, summary AS resumen_perfil,
       concat_ws('; ', CASE WHEN highest IS NULL THEN 'nivel_educacion' END, CASE WHEN summary = '' THEN 'resumen_perfil' END) AS errors
FROM src JOIN yrs USING (doc_id) JOIN summed USING (doc_id) LEFT JOIN terms USING (doc_id)
LEFT JOIN langs USING (doc_id) LEFT JOIN jobs USING (doc_id) LEFT JOIN grade USING (doc_id)"""


ORACLE["build_cv_records"] = cv_records(masked(C.CV_SQL, lead=True), years("text_anon"))
# The corpus says its years in this phrase only; an age follows it.
ORACLE["build_free_cv_records"] = cv_records(
    without_names(_FREE, breaks=True), "regexp_extract(text_anon, '([0-9]+) años de experiencia', 1)::DOUBLE"
)

ORACLE["build_strange_cv_records"] = cv_records(without_names(C.PLAIN_CV_SQL), "regexp_extract(text_anon, '([0-9]+) años de experiencia', 1)::DOUBLE")

ORACLE["build_jd_records"] = f"""
WITH {lines_of(C.JD_SQL, known=True)}, {leading('role')}, {grams(C.JD_SQL)},
found AS (SELECT doc_id, term, category FROM grams JOIN {terms_values(L.TERMS)} USING (term)),
terms AS (SELECT doc_id, {hits('industria')} AS industria FROM found GROUP BY doc_id),
reqs AS (SELECT doc_id, {bullets('mandatory')} AS must, {bullets('desirable')} AS nice FROM body GROUP BY doc_id),
grade AS ({education(C.JD_SQL)}),
yrs AS (SELECT doc_id, {years()} AS years FROM src)
SELECT src.doc_id, {rid('src.doc_id')} AS jd_id, {JOB_TITLE} AS titulo_puesto, {level('years')} AS nivel_requerido,
       years AS anos_experiencia_min, {technical('must')} AS skills_requeridos, {technical('nice')} AS skills_deseables,
       coalesce(industria, '') AS industria_preferida, coalesce(lowest, '{L.NO_DEGREE}') AS nivel_educacion_minimo,
       {MENTIONS} AS idiomas_requeridos, summary AS descripcion_rol, CASE WHEN summary = '' THEN 'descripcion_rol' ELSE '' END AS errors
FROM src JOIN yrs USING (doc_id) JOIN summed USING (doc_id) LEFT JOIN terms USING (doc_id)
LEFT JOIN reqs USING (doc_id) LEFT JOIN grade USING (doc_id)"""


def _listed_skills(column: str) -> str:
    return f"list_filter(string_split({column}, '; '), lambda t: t <> '')"


_RANKS = ", ".join(map(quoted, DEGREES))
ORACLE["match_cvs_to_jds"] = f"""
WITH cvs AS (SELECT doc_id AS cv, {_listed_skills('skills_tecnicos')} AS skills, round(anos_experiencia * 10)::BIGINT AS has,
                    coalesce(list_position([{_RANKS}], nivel_educacion), 0) AS degree FROM ({ORACLE['build_cv_records']})),
jds AS (SELECT doc_id AS jd, {_listed_skills('skills_requeridos')} AS must, {_listed_skills('skills_deseables')} AS wished,
               round(anos_experiencia_min * 10)::BIGINT AS asked, coalesce(list_position([{_RANKS}], nivel_educacion_minimo), 0) AS least
        FROM ({ORACLE['build_jd_records']})),
asks AS (SELECT * REPLACE (list_filter(wished, lambda t: NOT list_contains(must, t)) AS wished) FROM jds),
met AS (SELECT jd, cv, asked, has, degree, least, len(must) AS m, len(wished) AS n,
               len(list_intersect(must, skills)) AS must_met, len(list_intersect(wished, skills)) AS nice_met
        FROM asks, cvs),
scored AS (SELECT jd, cv, must_met::INT AS must_met, nice_met::INT AS nice_met,
                  700 * (2 * must_met + nice_met) // (2 * m + n) + CASE WHEN asked <= 0 THEN 200 ELSE 200 * least(has, asked) // asked END
                  + CASE WHEN degree >= met.least THEN 100 ELSE 0 END AS score FROM met WHERE must_met + nice_met > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY jd ORDER BY score DESC, cv)::INT AS rank FROM scored)
SELECT jd, rank, cv, score::BIGINT AS score, must_met, nice_met FROM ranked WHERE rank <= 5"""
