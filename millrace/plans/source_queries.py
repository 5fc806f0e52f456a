"""Queries over source files, documents and conversations, each with its SQL."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import lines as L
from millrace.operators import enrich as E
from millrace.operators import imports as I
from millrace.operators import rules as R
from millrace.operators.sft import evidence_text, sft_rows
from millrace.plans.fixtures import CODE_SQL, DOC_LINES_SQL, code_files, document_files
from millrace.session import table

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _longs(df, *cols):
    return df.withColumns({c: F.col(c).cast("long") for c in cols})


# ---------------------------------------------------------------- lines and ids
@query("line_explode", f"WITH {DOC_LINES_SQL} SELECT path, line, text FROM dl")
def line_explode(spark, d):
    return _longs(L.explode_lines(document_files(spark, d)), "line")


@query("snippet_window", f"WITH {DOC_LINES_SQL} SELECT path, string_agg(printf('%4d: %s', line, text), chr(10) ORDER BY line) AS snippet FROM dl WHERE line BETWEEN 2 AND 4 GROUP BY path")
def snippet_window(spark, d):
    files = L.with_lines(document_files(spark, d)).where("n_lines >= 2")
    return files.select("path", L.snippet(F.col("lines"), F.lit(2), F.lit(4)).alias("snippet"))


@query("stable_id", "SELECT doc_id, substr(sha1(source || '||' || lang || '||' || CAST(doc_id AS VARCHAR)), 1, 16) AS id FROM documents")
def stable_id(spark, d):
    return table(spark, d, "documents").select("doc_id", L.stable_id(F.col("source"), F.col("lang"), F.col("doc_id").cast("string")).alias("id"))


@query("content_hash", "SELECT doc_id, substr(sha256(trim(regexp_replace(text, '\\s+', ' ', 'g'))), 1, 16) AS hash FROM documents")
def content_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", L.content_hash(L.squeeze(F.col("text"))).alias("hash"))


@query("head_tail", "SELECT doc_id, CASE WHEN length(text) <= 200 THEN text ELSE substr(text, 1, 150) || chr(10) || '...(truncated)...' || chr(10) || right(text, 50) END AS cut FROM documents")
def head_tail(spark, d):
    return table(spark, d, "documents").select("doc_id", L.head_tail(F.col("text"), 200).alias("cut"))


@query("module_name", f"WITH {CODE_SQL} SELECT DISTINCT path, replace(regexp_replace(regexp_replace(path, '\\.py$', ''), '(^|/)__init__$', ''), '/', '.') AS module FROM code")
def module_name(spark, d):
    return code_files(spark, d).select("path", L.module_name(F.col("path")).alias("module"))


@query("license_lines", f"WITH {DOC_LINES_SQL} SELECT path, line FROM dl WHERE regexp_matches(text, '(?i)licen[sc]e')")
def license_lines(spark, d):
    found = L.matching_lines(document_files(spark, d), "(?i)licen[sc]e")
    return _longs(found.select("path", F.explode("line_numbers").alias("line")), "line")


# ---------------------------------------------------------------- line rules
_PLAIN = {
    "S1_CONFIG_ENV": ("coalesce(nullif(regexp_extract(text, 'os\\.getenv\\(\\s*[\"'']([A-Z0-9_]+)[\"'']', 1), ''), nullif(regexp_extract(text, 'os\\.environ\\.get\\(\\s*[\"'']([A-Z0-9_]+)[\"'']', 1), ''), nullif(regexp_extract(text, 'os\\.environ\\[\\s*[\"'']([A-Z0-9_]+)[\"'']\\s*\\]', 1), ''))", 0),
    "S1_RAISE_EXCEPTION": ("nullif(regexp_extract(text, '^\\s*raise\\s+([A-Za-z_][A-Za-z0-9_]*)', 1), '')", 2),
    "S1_LOGGING": ("nullif(regexp_extract(text, '\\b(?:logger|logging)\\.(debug|info|warning|error|exception)\\(', 1), '')", 0),
    "S1_ENTRYPOINT_MAIN": ("CASE WHEN regexp_matches(text, 'if\\s+__name__\\s*==\\s*[\"'']__main__[\"'']\\s*:') THEN path END", 8),
    "S1_PYTEST": ("CASE WHEN contains(lower(path), 'test') THEN nullif(regexp_extract(text, '^\\s*def\\s+(test_[A-Za-z0-9_]+)\\s*\\(', 1), '') END", 12),
    "S1_FILE_IO": ("CASE WHEN regexp_matches(text, '\\bopen\\(') THEN '' END", 2),
    "S1_REGEX": ("CASE WHEN regexp_matches(text, '\\bre\\.(compile|match|search|findall)\\(') THEN '' END", 0),
    "S1_ASYNC": ("nullif(regexp_extract(text, '^\\s*async\\s+def\\s+([A-Za-z_][A-Za-z0-9_]*)\\s*\\(', 1), '')", 12),
}


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _filled(template: str) -> str:
    before, found, after = template.partition("{}")
    return f"{_text(before)} || name || {_text(after)}" if found else _text(template)


def rule_sql(rule: R.LineRule) -> str:
    kind, title, question = _text(rule.kind), _filled(rule.title), _filled(rule.question)
    if rule.rule_id == "S1_DOCSTRING_CONTRACT":
        hits = """SELECT a.path, a.line, min(q.line) AS end_line, regexp_extract(a.text, '^\\s*(?:def|class)\\s+([A-Za-z_][A-Za-z0-9_]*)\\s*[\\(:]', 1) AS name, 'docstring_contract' AS kind, a.n FROM code a
 JOIN code b ON b.path = a.path AND b.line = a.line + 1 JOIN code q ON q.path = a.path AND q.line BETWEEN a.line + 2 AND a.line + 31 AND contains(q.text, regexp_extract(b.text, '^\\s*([\"'']{3})', 1))
 WHERE regexp_matches(a.text, '^\\s*(def|class)\\s+([A-Za-z_][A-Za-z0-9_]*)\\s*[\\(:]') AND regexp_extract(b.text, '^\\s*([\"'']{3})', 1) <> '' GROUP BY ALL"""
        hits = hits.replace("GROUP BY ALL", "GROUP BY a.path, a.line, a.text, a.n")
    elif rule.rule_id == "S1_VALIDATION":
        title = "CASE kind WHEN 'validation_assert' THEN 'Validation via assert' ELSE 'Validation via if/raise' END"
        question = f"CASE kind WHEN 'validation_assert' THEN {_filled(R.ASSERT_QUESTION)} ELSE {_filled(R.IF_QUESTION)} END"
        kind = "kind"
        hits = """SELECT path, line, line AS end_line, trim(regexp_extract(text, '^\\s*assert\\s+(.+?)(?:,|$)', 1)) AS name, 'validation_assert' AS kind, n FROM code WHERE regexp_matches(text, '^\\s*assert\\s+(.+?)(?:,|$)')
 UNION ALL SELECT path, line, CASE WHEN trim(nxt) <> '' THEN line + 1 ELSE line + 2 END, trim(regexp_extract(text, '^\\s*if\\s+(.+?)\\s*:\\s*$', 1)), 'validation_if_raise', n FROM
 (SELECT *, lead(text) OVER (PARTITION BY path ORDER BY line) AS nxt, first_value(CASE WHEN trim(text) <> '' THEN text END IGNORE NULLS) OVER (PARTITION BY path ORDER BY line ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS full_ FROM code)
 WHERE regexp_matches(text, '^\\s*if\\s+(.+?)\\s*:\\s*$') AND NOT regexp_matches(text, '^\\s*assert\\s') AND starts_with(ltrim(full_), 'raise')"""
    else:
        name, after = _PLAIN[rule.rule_id]
        hits = f"SELECT * FROM (SELECT path, line, least(line + {after}, n) AS end_line, {name} AS name, {kind} AS kind, n FROM code) WHERE name IS NOT NULL"
    cap = f"WHERE r <= {rule.per_file}" if rule.per_file else ""
    total = f"ORDER BY path, line LIMIT {rule.total}" if rule.total else ""
    return f"""WITH {CODE_SQL}, hits AS ({hits}), capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY line) AS r FROM hits) {cap} {total})
SELECT 's1_' || substr(sha1('{rule.rule_id}||' || {title} || '||' || path || '||' || CAST(line AS VARCHAR)), 1, 16) AS id, '{rule.rule_id}' AS rule_id, path, line AS start_line, CAST(end_line AS BIGINT) AS end_line, {kind if kind == 'kind' else kind} AS kind, name, {title} AS title, {question} AS question,
 (SELECT string_agg(printf('%4d: %s', c.line, c.text), chr(10) ORDER BY c.line) FROM code c WHERE c.path = h.path AND c.line BETWEEN h.line AND least(h.end_line, h.n)) AS snippet FROM capped h"""


def _rule(rule: R.LineRule):
    def run(spark, d):
        return _longs(R.line_rule(L.with_lines(code_files(spark, d)), rule), "start_line", "end_line")

    query(rule.rule_id.lower(), rule_sql(rule))(run)


for _r in R.RULES:
    _rule(_r)


@query("s1_all_rules", "WITH " + ", ".join(f"x{i} AS ({rule_sql(r)})" for i, r in enumerate(R.RULES)) + " SELECT rule_id, kind, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT rule_id, kind FROM x{i}" for i in range(len(R.RULES))) + ") GROUP BY rule_id, kind")
def s1_all_rules(spark, d):
    return R.run_line_rules(code_files(spark, d)).groupBy("rule_id", "kind").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- anchors
def anchor_sql(rule: R.AnchorRule, source: str, cte: str) -> str:
    if rule.package_only:
        cond = "path LIKE '%\\_\\_init\\_\\_.py' ESCAPE '\\' AND (regexp_matches(text, '^\\s*__all__\\s*=\\s*\\[') OR (regexp_matches(text, '^\\s*(from\\s+\\S+\\s+import\\s+.+|import\\s+\\S+)\\s*(#.*)?$') AND NOT contains(text, 'logging')) OR regexp_matches(text, '(?i)(public\\s+api|re-export|reexport|stable api)'))"
    else:
        cond = f"regexp_matches(text, {_text('(?i)' + rule.pattern)})"
    question = f"{_text(R.QUESTION_HEAD.format(rule.focus, rule.kind))} || path || {_text(R.QUESTION_TAIL.format(*rule.tasks, rule.never))}"
    return f"""SELECT path, '{rule.rule_id}' AS rule_id, '{rule.kind}' AS kind, {_text(rule.title)} AS title, {question} AS question, 's2_' || substr(sha256(path || '|{rule.kind}'), 1, 16) AS id, n_hits, start_line, end_line,
 (SELECT string_agg(printf('%4d: %s', s.line, rtrim(s.text)), chr(10) ORDER BY s.line) FROM {source} s WHERE s.path = w.path AND s.line BETWEEN w.start_line AND w.end_line) AS snippet
 FROM (SELECT path, count(*) AS n_hits, CAST(greatest(1, list_sort(list(line))[count(*) // 2 + 1] - {rule.soft}) AS BIGINT) AS start_line, CAST(least(any_value(n), list_sort(list(line))[count(*) // 2 + 1] + {rule.soft}) AS BIGINT) AS end_line FROM {source} WHERE {cond} GROUP BY path) w"""


def _anchors(files, rule):
    out = R.anchors(L.with_lines(files), rule)
    return _longs(out.select("path", "rule_id", "kind", "title", "question", "id", "n_hits", "start_line", "end_line", "snippet"), "n_hits", "start_line", "end_line")


_FLOW = R.ANCHORS[2]


@query("s2_flow_anchors", f"WITH {DOC_LINES_SQL} {anchor_sql(_FLOW, 'dl', '')}")
def s2_flow_anchors(spark, d):
    return _anchors(document_files(spark, d), _FLOW)


def _anchor(rule: R.AnchorRule):
    def run(spark, d):
        return _anchors(code_files(spark, d), rule)

    query(f"s2_{rule.kind}", f"WITH {CODE_SQL} {anchor_sql(rule, 'code', '')}")(run)


for _a in R.ANCHORS:
    _anchor(_a)

_ALL = " UNION ALL ".join(f"SELECT {i} AS rule_ord, * FROM ({anchor_sql(a, 'code', '')})" for i, a in enumerate(R.ANCHORS))


@query(
    "s2_dedup_and_caps",
    f"""WITH {CODE_SQL}, a AS ({_ALL}), f AS (SELECT *, substr(sha256(rule_id || '||' || substr(trim(regexp_replace(question, '\\s+', ' ', 'g')), 1, 120) || '||' || substr(sha256(snippet), 1, 16)), 1, 16) AS fingerprint FROM a),
 k AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY fingerprint ORDER BY rule_ord, path) = 1), c AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY path, kind ORDER BY rule_ord) <= 2)
 SELECT id, path, kind, fingerprint FROM (SELECT * FROM c ORDER BY rule_ord, path LIMIT 60)""",
)
def s2_dedup_and_caps(spark, d):
    return R.run_anchor_rules(code_files(spark, d), max_items=60).select("id", "path", "kind", "fingerprint")


@query(
    "s2_window_shrink",
    """WITH r AS (SELECT o_orderkey AS k, 1 + o_custkey % 300 AS n, 1 + o_orderkey % (1 + o_custkey % 300) AS c FROM orders), w AS (SELECT k, greatest(1, c - 55) AS s, least(n, c + 55) AS e, c FROM r),
 x AS (SELECT k, s, e, c - s AS a, e - c AS b, greatest(e - s + 1 - 40, 0) AS excess FROM w), y AS (SELECT *, least(excess, abs(a - b)) AS u FROM x)
 SELECT k, CAST(s + CASE WHEN a > b THEN u ELSE 0 END + (excess - u + 1) // 2 AS BIGINT) AS start_line, CAST(e - CASE WHEN b > a THEN u ELSE 0 END - (excess - u) // 2 AS BIGINT) AS end_line FROM y""",
)
def s2_window_shrink(spark, d):
    n = (1 + F.col("o_custkey") % 300).cast("int")
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), n.alias("n"), F.array((1 + F.col("o_orderkey") % n).cast("int")).alias("hits"))
    s, e = R.window(F.col("hits"), F.col("n"), 55, 40)
    return rows.select("k", s.cast("long").alias("start_line"), e.cast("long").alias("end_line"))


_TRACES = ", ".join(f"('{a.rule_id}', {_text(a.answer)}, {_text(' / '.join(a.steps))})" for a in R.ANCHORS)


@query("s2_items", f"WITH {CODE_SQL}, a AS ({_ALL}), t(rule_id, answer, steps) AS (VALUES {_TRACES}) SELECT a.id, a.rule_id, a.title, a.question, t.answer, t.steps, a.path AS anchor_file, a.snippet FROM a JOIN t USING (rule_id)")
def s2_items(spark, d):
    """Whole items of all anchor rules, before copies and caps."""
    files = L.with_lines(code_files(spark, d))
    items = R.anchor_items(reduce(DataFrame.unionByName, (R.anchors(files, a) for a in R.ANCHORS)))
    steps = F.array_join(F.transform("trace", lambda t: t["content"]), " / ")
    return items.select("id", "rule_id", "title", "question", "answer", steps.alias("steps"), F.element_at("meta.extra", F.lit("anchor_file")).alias("anchor_file"), F.col("evidence")[0]["snippet"].alias("snippet"))


# ---------------------------------------------------------------- imports
_IMPORTS = "i AS (SELECT path, coalesce(nullif(regexp_extract(text, '^\\s*(?:from\\s+([A-Za-z0-9_\\.]+)\\s+import|import\\s+([A-Za-z0-9_\\.]+))', 1), ''), regexp_extract(text, '^\\s*(?:from\\s+([A-Za-z0-9_\\.]+)\\s+import|import\\s+([A-Za-z0-9_\\.]+))', 2)) AS module, count(*) AS n FROM code WHERE regexp_matches(text, '^\\s*(from\\s+[A-Za-z0-9_\\.]+\\s+import|import\\s+[A-Za-z0-9_\\.]+)') GROUP BY 1, 2)"
_EDGES = "k AS (SELECT DISTINCT replace(regexp_replace(regexp_replace(path, '\\.py$', ''), '(^|/)__init__$', ''), '/', '.') AS m FROM code), e AS (SELECT DISTINCT path AS src, module AS dst FROM i WHERE module IN (SELECT m FROM k) OR split_part(module, '.', 1) IN (SELECT split_part(m, '.', 1) FROM k))"


@query("import_counts", f"WITH {CODE_SQL}, {_IMPORTS} SELECT * FROM i")
def import_counts(spark, d):
    return I.line_imports(code_files(spark, d))


@query("import_edges", f"WITH {CODE_SQL}, {_IMPORTS}, {_EDGES} SELECT * FROM e")
def import_edges(spark, d):
    files = code_files(spark, d)
    return I.internal_edges(files, I.line_imports(files))


@query("import_degrees", f"WITH {CODE_SQL}, {_IMPORTS}, {_EDGES} SELECT src AS node, 'out' AS side, count(DISTINCT dst) AS degree FROM e GROUP BY src UNION ALL SELECT dst, 'in', count(DISTINCT src) FROM e GROUP BY dst")
def import_degrees(spark, d):
    files = code_files(spark, d)
    out, into = I.degrees(I.internal_edges(files, I.line_imports(files)))
    return out.select(F.col("src").alias("node"), F.lit("out").alias("side"), F.col("out_degree").alias("degree")).unionByName(into.select(F.col("dst").alias("node"), F.lit("in").alias("side"), F.col("in_degree").alias("degree")))


@query("import_hubs", f"WITH {CODE_SQL}, {_IMPORTS} SELECT path, CAST(sum(n) AS BIGINT) AS n FROM i GROUP BY path ORDER BY n DESC, path LIMIT 10")
def import_hubs(spark, d):
    return I.hubs(I.line_imports(code_files(spark, d)))


@query("parsed_symbols")
def parsed_symbols(spark, d):
    """By the parser: no SQL; tests compare it with ast."""
    return I.parse_files(code_files(spark, d)).groupBy("path", "kind").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- enrichment and chat rows
@query("resume_anti_join", "SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti_join(spark, d):
    items, done = table(spark, d, "documents").select(F.col("doc_id").alias("id")), table(spark, d, "labels").select(F.col("doc_id").alias("id"))
    return E.remaining(items, done)


@query("resume_retry_failed", "SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def resume_retry_failed(spark, d):
    done = table(spark, d, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("llm_enriched"))
    return E.remaining(table(spark, d, "documents").select(F.col("doc_id").alias("id")), done, retry_failed=True)


@query("enrich_counts", "SELECT count(*) AS total, count(*) FILTER (WHERE quality = 1) AS ok, count(*) FILTER (WHERE quality <> 1) AS failed FROM labels")
def enrich_counts(spark, d):
    return E.counters(table(spark, d, "labels").select((F.col("quality") == 1).alias("llm_enriched")))


@query("trace_pad_cap", "SELECT o_orderkey AS id, CAST(CASE WHEN o_custkey % 12 + 1 < 4 THEN o_custkey % 12 + 2 ELSE least(o_custkey % 12 + 1, 8) END AS BIGINT) AS n, 's' || CAST(o_custkey % 12 + 1 AS VARCHAR) AS last FROM orders")
def trace_pad_cap(spark, d):
    step = lambda i: F.struct(i.alias("step"), F.lit("reason").alias("kind"), F.concat(F.lit("s"), i.cast("string")).alias("content"), F.array(F.lit(0)).alias("evidence_refs"))
    trace = F.transform(F.sequence(F.lit(1), (F.col("o_custkey") % 12 + 1).cast("int")), step).cast(E.STEP_TYPE)
    done = E.renumber(E.cap_steps(E.pad_steps(trace)))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.size(done).cast("long").alias("n"), F.element_at(done, -1)["content"].alias("last"))


def _doc_evidence():
    return F.transform(L.split_lines(F.col("text")), lambda x, i: R.evidence(F.lit("f"), i + 1, i + 1, x))


@query(
    "evidence_budget",
    """WITH b AS (SELECT doc_id, unnest(range(0, len(ls))) AS i, unnest(ls) AS x FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
 t AS (SELECT doc_id, i, '[evidence ' || i || '] file=f lines=' || (i + 1) || '-' || (i + 1) || chr(10) || x AS blk FROM b), s AS (SELECT *, sum(length(blk)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM t),
 f AS (SELECT doc_id, min(i) AS over_ FROM s WHERE run > 600 GROUP BY doc_id)
 SELECT s.doc_id, string_agg(CASE WHEN i = over_ THEN '[evidence ' || i || '] <omitted: evidence budget exceeded; add narrower spans if needed>' ELSE blk END, chr(10) || chr(10) ORDER BY i) AS block FROM s LEFT JOIN f ON f.doc_id = s.doc_id WHERE over_ IS NULL OR i <= over_ GROUP BY s.doc_id""",
)
def evidence_budget(spark, d):
    return table(spark, d, "documents").select("doc_id", E.evidence_block(_doc_evidence(), 100000, 600).alias("block"))


@query("json_extract_fenced", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract_fenced(spark, d):
    @F.pandas_udf("long")
    def value(replies: pd.Series) -> pd.Series:
        return replies.map(lambda r: E.first_object(r)["k"])

    kind = F.col("event_id") % 3
    reply = F.when(kind == 0, F.col("props")).when(kind == 1, F.concat(F.lit("Sure:\n```json\n"), "props", F.lit("\n```\nDone."))).otherwise(F.concat(F.lit("Here it is: "), "props", F.lit(" as asked.")))
    return table(spark, d, "events").select("event_id", value(reply).alias("k"))


@query(
    "sft_rows",
    """WITH t AS (SELECT conv_id, turn, role, text, lead(role) OVER w AS next_role, lead(text) OVER w AS answer FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, text))
 SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id, trim(text) || chr(10) || chr(10) || '--- Evidence ---' || chr(10) || '[evidence 0] file=conv lines=' || turn || '-' || turn || chr(10) || text || chr(10) AS user, trim(answer) AS target FROM t WHERE role = 'user' AND next_role = 'assistant' AND length(text) > 0 AND length(answer) > 0""",
)
def sft(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn", "text")
    t = table(spark, d, "conversations").withColumn("next_role", F.lead("role").over(w)).withColumn("answer", F.lead("text").over(w)).where("role = 'user' and next_role = 'assistant'")
    items = t.select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), F.col("text").alias("question"), "answer", F.array(R.evidence(F.lit("conv"), F.col("turn"), F.col("turn"), F.col("text"))).alias("evidence"))
    return sft_rows(items).select("id", "user", "target")


@query("evidence_text_cut", """WITH l AS (SELECT doc_id, unnest(range(0, len(ls))) AS i, unnest(ls) AS x FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)), b AS (SELECT doc_id, string_agg('[evidence ' || i || '] file=f lines=' || (i + 1) || '-' || (i + 1) || chr(10) || x, chr(10) || chr(10) ORDER BY i) AS b FROM l GROUP BY doc_id)
 SELECT doc_id, CASE WHEN length(b) > 300 THEN substr(b, 1, 300) || chr(10) || chr(10) || '...<truncated>...' ELSE b END AS block FROM b""")
def evidence_text_cut(spark, d):
    return table(spark, d, "documents").select("doc_id", evidence_text(_doc_evidence(), 300).alias("block"))
