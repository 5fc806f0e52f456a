"""Declarative rules over source files: drafts with evidence, in one pass over the files.

Files carry their lines as an array, so a rule is a projection: a filter over the lines,
a cap, and a slice as evidence. Rules run together over a file's lines. Nothing is shuffled but for
caps over all files, which are top-n in (path, line) order.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import lines as L
from millrace.functions.text import let

# Patterns, titles, questions and caps of the line rules.
ENV = (r"os\.getenv\(\s*[\"']([A-Z0-9_]+)[\"']\s*,?", r"os\.environ\.get\(\s*[\"']([A-Z0-9_]+)[\"']\s*,?", r"os\.environ\[\s*[\"']([A-Z0-9_]+)[\"']\s*\]")
DEF = r"^\s*(?:def|class)\s+([A-Za-z_][A-Za-z0-9_]*)\s*[\(:]"
QUOTE = r"^\s*([\"']{3})"
ASSERT = r"^\s*assert\s+(.+?)(?:,|$)"
IF = r"^\s*if\s+(.+?)\s*:\s*$"
HEAD = 16384  # lines of a long file that are looked at first


@dataclass(frozen=True)
class LineRule:
    """after: lines of evidence behind the hit; per_file and total: caps, 0 for none."""

    rule_id: str
    kind: str
    pattern: tuple[str, ...]
    title: str
    question: str
    key: str = ""
    after: int = 0
    per_file: int = 0
    total: int = 0
    tests_only: bool = False


# Fixed values, in the order in which the rules run.
RULES = (
    LineRule("S1_CONFIG_ENV", "config_env", ENV, "Config from env: {}", "In this repository, what behavior/rule is controlled by environment variable `{}`? Explain using the given code evidence.", "key", per_file=30),
    LineRule("S1_DOCSTRING_CONTRACT", "docstring_contract", (DEF,), "Docstring contract: {}", "What does `{}` claim to do according to its docstring/contract? Summarize the contract using only the evidence.", "name", total=300),
    LineRule("S1_RAISE_EXCEPTION", "raise_exception", (r"^\s*raise\s+([A-Za-z_][A-Za-z0-9_]*)",), "Exception behavior: raise {}", "Under what condition does the code raise `{}` here, and what does that imply about expected inputs/state?", "exception", after=2, per_file=30),
    LineRule("S1_VALIDATION", "validation", (ASSERT, IF), "Validation via {}", "", "condition", per_file=30),
    LineRule("S1_LOGGING", "logging", (r"\b(?:logger|logging)\.(debug|info|warning|error|exception)\(",), "Logging at {}", "What event/state is logged at `{}` level here, and what does that tell us about the business flow?", "level", per_file=30),
    LineRule("S1_ENTRYPOINT_MAIN", "entrypoint_main", (r"if\s+__name__\s*==\s*['\"]__main__['\"]\s*:",), "Entrypoint: {}", "What is the program entrypoint behavior in `{}`? Describe what gets executed when run as a script.", "file", after=8, per_file=1, total=100),
    LineRule("S1_PYTEST", "pytest", (r"^\s*def\s+(test_[A-Za-z0-9_]+)\s*\(",), "Test behavior: {}", "What behavior or rule does test `{}` verify? Summarize the expected behavior using only the evidence.", "test_name", after=12, total=300, tests_only=True),
    LineRule("S1_FILE_IO", "file_io", (r"\bopen\(", r"\bPath\([^)]+\)\.(?:read_text|write_text|open)\("), "File I/O behavior", "What file I/O behavior is performed here (read/write path, format, side effects) based on the evidence?", after=2, per_file=20),
    LineRule("S1_REGEX", "regex", (r"\bre\.(?:compile|match|search|findall)\(",), "Regex rule", "What pattern matching rule is applied here, and what inputs would it accept/reject (based on evidence only)?", per_file=20),
    LineRule("S1_ASYNC", "async", (r"^\s*async\s+def\s+([A-Za-z_][A-Za-z0-9_]*)\s*\(",), "Async behavior: {}", "What asynchronous behavior does `{}` implement (awaited calls, sequencing) based on the evidence?", "name", after=12, total=150),
)
ASSERT_QUESTION = "What validation does this `assert` enforce (`{}`), and what would happen if it fails?"
IF_QUESTION = "What invalid condition is being checked (`{}`), and what is the expected behavior when it is met?"
DRAFT_ANSWER = "(draft) Summarize the behavior/rule implied by the evidence snippet(s)."
TRACE = (
    (1, "extract", "Locate the relevant code evidence."),
    (2, "reason", "Derive the rule/behavior from conditions, branches, and calls in evidence."),
    (3, "answer", "State the conclusion and key triggers/inputs/outputs based on evidence."),
)


def _fill(template: str, value: Column) -> Column:
    before, found, after = template.partition("{}")
    return F.concat(F.lit(before), value, F.lit(after)) if found else F.lit(template)


def _first_group(x: Column, patterns: tuple[str, ...]) -> Column:
    """Group 1 of the first pattern that is found, null if none is."""
    return F.coalesce(*(F.when(x.rlike("(?U)" + p), F.regexp_extract(x, "(?U)" + p, 1)) for p in patterns))


def _hit(line: Column, end: Column, name: Column, kind: Column) -> Column:
    return F.struct(line.cast("int").alias("line"), end.cast("int").alias("end"), name.alias("name"), kind.alias("kind"))


def _hits(rule: LineRule) -> Column:
    """Array of (line, end, name, kind) of a file's hits, up to the rule's caps; with a cap, lines behind a head of the file are looked at only if the head has too few."""
    most = min((c for c in (rule.per_file, rule.total) if c), default=0)
    found = _found(rule)
    if not most:
        return found
    return let(_found(rule, HEAD), lambda h: F.slice(F.when((F.size(h) >= most) | (F.col("n_lines") <= HEAD), h).otherwise(found), 1, most))


def _found(rule: LineRule, head: int = 0) -> Column:
    """All hits of a file, or those of its first lines; in a longer file without the last of these that is not blank, whose following line is not among them."""
    lines, n = F.col("lines"), F.col("n_lines")
    first = F.slice(lines, 1, head) if head else lines
    kind = F.lit(rule.kind)
    if rule.rule_id == "S1_DOCSTRING_CONTRACT":

        def doc(x, i):
            quote = F.regexp_extract(F.get(lines, i + 1), "(?U)" + QUOTE, 1)
            more = F.array_position(F.transform(F.slice(lines, i + 3, 30), lambda y: F.contains(y, quote)), True).cast("int")
            ok = x.rlike("(?U)" + DEF) & (i + 1 < n) & (quote != "") & (more > 0)
            return F.when(ok, _hit(i + 1, i + 2 + more, F.regexp_extract(x, "(?U)" + DEF, 1), kind))

        found = F.transform(first, doc)
    elif rule.rule_id == "S1_VALIDATION":

        # blank lines hit nothing, so the line after a hit is the next of those that are not blank
        solid = F.filter(F.transform(first, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: s["x"].rlike(r"(?U)\S"))

        def check(all_, s, k):
            x, i, following = s["x"], s["i"], F.get(all_, k + 1)["x"]
            end = i + F.when(F.get(lines, i + 1).rlike(r"(?U)\S"), 2).otherwise(3)
            by_assert = x.rlike("(?U)" + ASSERT)
            by_if = x.rlike("(?U)" + IF) & F.coalesce(following.rlike(r"(?U)^\s*raise"), F.lit(False))
            if head:
                by_assert = by_assert & ((k + 1 < F.size(all_)) | (n <= head))
            condition = lambda p: F.regexp_replace(F.regexp_extract(x, "(?U)" + p, 1), r"(?U)^\s+|\s+$", "")
            return F.when(by_assert, _hit(i + 1, i + 1, condition(ASSERT), F.lit("validation_assert"))).when(by_if, _hit(i + 1, end, condition(IF), F.lit("validation_if_raise")))

        found = let(solid, lambda all_: F.transform(all_, lambda s, k: check(all_, s, k)))
    else:

        def plain(x, i):
            end = F.least(i + 1 + rule.after, n)
            if rule.key in ("", "file"):
                ok = reduce(lambda a, b: a | b, (x.rlike("(?U)" + p) for p in rule.pattern))
                return F.when(ok, _hit(i + 1, end, F.col("path") if rule.key else F.lit(""), kind))
            name = _first_group(x, rule.pattern)
            return F.when(name.isNotNull(), _hit(i + 1, end, name, kind))

        found = F.transform(first, plain)
    return F.filter(found, lambda h: h.isNotNull())


def evidence(path: Column, start: Column, end: Column, text: Column) -> Column:
    span = F.struct(path.alias("file_path"), start.cast("int").alias("start_line"), end.cast("int").alias("end_line"))
    return F.struct(span.alias("span"), text.alias("snippet"))


def _drafts(rule: LineRule) -> Column:
    """A file's drafts of one rule, as an array of rows; only the evidence leaves the file's lines."""
    path = F.col("path")

    def draft(h):
        name = h["name"]
        if rule.rule_id == "S1_VALIDATION":
            by_assert = h["kind"] == "validation_assert"
            title = F.when(by_assert, F.lit("Validation via assert")).otherwise(F.lit("Validation via if/raise"))
            question = F.when(by_assert, _fill(ASSERT_QUESTION, name)).otherwise(_fill(IF_QUESTION, name))
        else:
            title, question = _fill(rule.title, name), _fill(rule.question, name)
        key = F.concat(F.lit("s1_"), L.stable_id(F.lit(rule.rule_id), title, path, h["line"].cast("string")))
        return F.struct(
            key.alias("id"), F.lit(rule.rule_id).alias("rule_id"), path.alias("path"), h["line"].alias("start_line"), h["end"].alias("end_line"), h["kind"].alias("kind"), name.alias("name"), title.alias("title"), question.alias("question"),
            L.snippet(F.col("lines"), h["line"], h["end"]).alias("snippet"),
        )

    found = F.transform(_hits(rule), draft)
    if rule.tests_only:
        found = F.when(F.contains(F.lower("path"), F.lit("test")), found).otherwise(F.array())
    return found


def _flat(files: DataFrame, drafts: list[Column]) -> DataFrame:
    """All drafts of some rules: each file is read and split once, and its drafts are one array."""
    return files.select(F.explode(F.concat(*drafts)).alias("d")).select("d.*")


def line_rule(files: DataFrame, rule: LineRule) -> DataFrame:
    """Flat drafts of one rule over files (path, lines, n_lines)."""
    rows = _flat(files, [_drafts(rule)])
    return rows.orderBy("path", "start_line").limit(rule.total) if rule.total else rows


def run_line_rules(files: DataFrame, rules: tuple[LineRule, ...] = RULES) -> DataFrame:
    """Flat drafts of all rules; files as (path, text). A rule whose plan cannot be made gives one error row.

    One scan for the rules without a cap over all files, which shuffles nothing, and one for the others, where
    a task sends at most the cap's number of rows of each rule."""
    from pyspark.sql import Window

    files = L.with_lines(files)
    parts, made = [], []
    for rule in rules:
        try:
            made.append((rule, _drafts(rule)))
        except Exception as e:  # the other rules still run
            parts.append(error_row(files, rule, str(e)))
    able = made
    try:
        files.select(*(d for _, d in made)).schema  # all plans at once: made, but not run
    except Exception:
        able = []
        for rule, drafts in made:
            try:
                files.select(drafts).schema
                able.append((rule, drafts))
            except Exception as e:
                parts.append(error_row(files, rule, str(e)))
    free, capped = [d for r, d in able if not r.total], [r for r, _ in able if r.total]
    if free:
        parts.append(_flat(files, free))
    if capped:
        caps = F.element_at(F.create_map(*(F.lit(x) for r in capped for x in (r.rule_id, r.total))), F.col("rule_id"))
        rows = _flat(files, [d for r, d in able if r.total]).withColumn("_r", F.row_number().over(Window.partitionBy("rule_id").orderBy("path", "start_line")))
        parts.append(rows.where(F.col("_r") <= max(r.total for r in capped)).where(F.col("_r") <= caps).drop("_r"))
    return reduce(DataFrame.unionByName, parts)


def error_row(files: DataFrame, rule: LineRule, error: str) -> DataFrame:
    one = files.sparkSession.range(1)
    return one.select(
        F.concat(F.lit("s1_"), L.stable_id(F.lit("RULE_ERROR"), F.lit(rule.kind))).alias("id"), F.lit("S1_RULE_ERROR").alias("rule_id"), F.lit("").alias("path"), F.lit(0).alias("start_line"), F.lit(0).alias("end_line"),
        F.lit("rule_error").alias("kind"), F.lit(error).alias("name"), F.lit(f"Rule failure: {rule.kind}").alias("title"), F.lit(f"Rule `{rule.kind}` failed to run.").alias("question"), F.lit("").alias("snippet"),
    )


def as_items(flat: DataFrame, scenario: str = "scenario1") -> DataFrame:
    """Items (id, scenario, rule_id, title, question, answer, evidence, trace, meta) from flat drafts."""
    trace = F.array(*(F.struct(F.lit(s).alias("step"), F.lit(k).alias("kind"), F.lit(c).alias("content"), F.array(F.lit(0)).alias("evidence_refs")) for s, k, c in TRACE))
    meta = F.struct(F.col("kind").alias("kind"), F.create_map(F.lit("name"), F.col("name")).alias("extra"))
    return flat.select("id", F.lit(scenario).alias("scenario"), "rule_id", "title", "question", F.lit(DRAFT_ANSWER).alias("answer"), F.array(evidence(F.col("path"), F.col("start_line"), F.col("end_line"), F.col("snippet"))).alias("evidence"), trace.alias("trace"), meta.alias("meta"))


# ---------------------------------------------------------------- anchors and windows
@dataclass(frozen=True)
class AnchorRule:
    """tasks, never: the question's tasks and what an answer must not invent; steps: the draft's trace."""

    rule_id: str
    kind: str
    title: str
    focus: str
    tasks: tuple[str, str, str]
    never: str
    steps: tuple[str, str, str]
    answer: str
    pattern: str
    soft: int
    hard: int
    package_only: bool = False


# Fixed values, in the order in which the rules run.
ANCHORS = (
    AnchorRule(
        "S2_ARCH_RATIONALE_PUBLIC_API",
        "public_api",
        "Architecture rationale: public API",
        "Public API surface / stability / exports",
        (
            "Explain what public API surface is visible in the evidence (exports, __all__, re-exports).",
            "Infer what stability/compatibility constraint this API design implies. If evidence is insufficient, say 'Insufficient evidence' and list what is missing.",
            "Propose a backward-compatible evolution plan: what to add/change, where (by files/modules seen in evidence), migration steps, tests, risks, rollback.",
        ),
        "Do NOT invent new public APIs not present in evidence.",
        (
            "Extract what is actually exported/re-exported or declared stable in the evidence.",
            "Infer implied compatibility/stability constraints. If missing, state Insufficient evidence.",
            "Propose backward-compatible evolution (additions only, deprecation path, tests, rollback).",
        ),
        "(draft) Provide a design rationale and an evolution plan using ONLY the evidence. If evidence is insufficient, say 'Insufficient evidence' and list what is missing.",
        "",
        40,
        140,
        True,
    ),
    AnchorRule(
        "S2_ARCH_RATIONALE_EXTENSION",
        "extension_point",
        "Architecture rationale: extension mechanism",
        "Extension mechanism / registry / factory / strategy",
        (
            "Explain what architecture/design choice is visible in the evidence.",
            "Infer the most likely goal/requirement/constraint this design is addressing (reverse-infer). If evidence is insufficient, say 'Insufficient evidence' and list what is missing.",
            "Propose an evolution plan aligned with the architecture: what to change/add, where (by files/modules seen in evidence), how to keep compatibility, what to test, risks, and rollback.",
        ),
        "Do NOT invent APIs/mechanisms not present in evidence.",
        (
            "Extract extension/registry/factory/strategy signals from evidence.",
            "Reverse-infer likely goal/constraint; if unclear, Insufficient evidence.",
            "Propose aligned evolution plan: add new impl via existing mechanism, compat, tests, risks, rollback.",
        ),
        "(draft) Provide a design rationale and evolution plan using ONLY the evidence. If evidence is insufficient, say 'Insufficient evidence' and list what is missing.",
        "(registry|register|factory|strategy|plugin|extension)",
        55,
        160,
    ),
    AnchorRule(
        "S2_ARCH_RATIONALE_FLOW",
        "flow_pipeline",
        "Architecture rationale: pipeline/flow",
        "Flow / pipeline / orchestration",
        (
            "Explain what pipeline/flow structure is visible in the evidence (stages, boundaries, sequencing).",
            "Infer the likely goal/constraint this flow is addressing. If evidence is insufficient, say 'Insufficient evidence' and list what is missing.",
            "Propose an evolution plan: where to integrate a new step safely, compatibility constraints, tests, risks, rollback.",
        ),
        "Do NOT invent modules/APIs not present in evidence.",
        (
            "Extract stages/sequence/boundaries visible in the evidence.",
            "Infer goal/constraint; if unclear, mark Insufficient evidence and list missing info.",
            "Propose a safe evolution plan: insertion point, compatibility, tests, risks, rollback.",
        ),
        "(draft) Provide a design rationale and an evolution plan using ONLY the evidence. If evidence is insufficient, say 'Insufficient evidence' and list what is missing.",
        "(pipeline|stage|step|first|then|finally|second stage)",
        55,
        160,
    ),
    AnchorRule(
        "S2_ARCH_RATIONALE_PERF",
        "performance_scalability",
        "Architecture rationale: performance/scalability",
        "Performance / scalability / memory / caching / batching",
        (
            "Explain what performance/scalability tradeoffs are visible in the evidence (batching, cache, memory footprint, data structures).",
            "Infer the likely constraint driving these choices (e.g., memory/time). If evidence is insufficient, say 'Insufficient evidence' and list what is missing.",
            "Propose an evolution plan: how to improve performance safely, where to change, compatibility constraints, tests, risks, rollback.",
        ),
        "Do NOT invent new configuration keys or flags not present in evidence.",
        (
            "Extract concrete perf patterns (batching/cache/chunk/memory notes) from evidence.",
            "Infer the constraint (memory/time/IO). If unclear, Insufficient evidence.",
            "Propose a safe perf evolution plan: where to change, keep compatibility, tests, risks, rollback.",
        ),
        "(draft) Provide a design rationale and an evolution plan using ONLY the evidence. If evidence is insufficient, say 'Insufficient evidence' and list what is missing.",
        r"(batch|cache|chunk|memory\s+footprint|tqdm|float16|imap|lazy)",
        50,
        150,
    ),
    AnchorRule(
        "S2_ARCH_RATIONALE_POLICY",
        "algorithm_policy",
        "Architecture rationale: algorithmic policy",
        "Algorithmic policy / special cases / fallback / compatibility hacks",
        (
            "Explain what policy/strategy is visible in the evidence (rules, special cases, fallbacks, merging decisions).",
            "Infer the likely requirement/constraint this policy addresses. If evidence is insufficient, say 'Insufficient evidence' and list what is missing.",
            "Propose an evolution plan: how to adjust/replace policies safely, where to change, compatibility, tests, risks, rollback.",
        ),
        "Do NOT invent behavior not present in evidence.",
        (
            "Extract explicit policies/special cases/fallbacks visible in evidence.",
            "Infer which constraint the policy targets; if unclear, Insufficient evidence.",
            "Propose safe evolution: how to replace/adjust, tests, compatibility, risks, rollback.",
        ),
        "(draft) Provide a design rationale and an evolution plan using ONLY the evidence. If evidence is insufficient, say 'Insufficient evidence' and list what is missing.",
        r"(special case|fallback|backward-compat|compatibility|TODO\(|policy|rule\s*\()",
        55,
        160,
    ),
)
# The frame of the questions, and the kind of the items.
QUESTION_HEAD = "You are given architecture/design evidence extracted from a local repository.\nFocus area: {}\nAnchor kind: {}\nAnchor file: "
QUESTION_TAIL = "\n\nTask:\n1) {}\n2) {}\n3) {}\n\nConstraints:\n- Use ONLY the provided evidence snippets.\n- {}\n- Provide a rationale trace where EACH step cites evidence_refs.\n"
ANCHOR_ITEM_KIND = "arch_first_design_task"
STEP_KINDS = ("extract", "reason", "answer")
REEXPORT = r"^\s*(from\s+\S+\s+import\s+.+|import\s+\S+)\s*(#.*)?$"
ALL_LIST = r"^\s*__all__\s*=\s*\["
API_COMMENT = r"(public\s+api|re-export|reexport|stable api)"


def anchor_lines(rule: AnchorRule) -> Column:
    def hit(x):
        if rule.package_only:
            return x.rlike("(?U)" + ALL_LIST) | (x.rlike("(?U)" + REEXPORT) & ~F.contains(x, F.lit("logging"))) | x.rlike("(?iU)" + API_COMMENT)
        return x.rlike("(?iU)" + rule.pattern)

    return F.filter(F.transform("lines", lambda x, i: F.when(hit(x), i + 1)), lambda i: i.isNotNull())


def window(hits: Column, n: Column, soft: int, hard: int) -> tuple[Column, Column]:
    """First and last line around the upper median hit: `soft` lines on both sides, at most `hard`
    in all, the longer side shortened first and the side before on ties; the head without hits."""
    center = F.element_at(hits, (F.floor(F.size(hits) / 2) + 1).cast("int"))
    start, end = F.greatest(F.lit(1), center - soft), F.least(n, center + soft)
    before, behind = center - start, end - center
    excess = F.greatest(end - start + 1 - hard, F.lit(0))
    uneven = F.least(excess, F.abs(before - behind))
    rest = excess - uneven
    start = start + F.when(before > behind, uneven).otherwise(0) + F.ceil(rest / 2).cast("int")
    end = end - F.when(behind > before, uneven).otherwise(0) - F.floor(rest / 2).cast("int")
    none = F.size(hits) == 0
    return F.when(none, 1).otherwise(start).cast("int"), F.when(none, F.least(n, F.lit(hard))).otherwise(end).cast("int")


def anchors(files: DataFrame, rule: AnchorRule) -> DataFrame:
    """Flat drafts of one anchor rule over files (path, lines, n_lines): at most one per file."""
    if rule.package_only:
        files = files.where(F.col("path").endswith("__init__.py"))
    # generators keep the optimizer from copying the hits into every place that uses them
    rows = files.select("path", "lines", "n_lines", F.explode(F.array(anchor_lines(rule))).alias("hits")).where(F.size("hits") > 0)
    start, end = window(F.col("hits"), F.col("n_lines"), rule.soft, rule.hard)
    rows = rows.select("path", "lines", "hits", F.inline(F.array(F.struct(start.alias("start_line"), end.alias("end_line")))))
    question = F.concat(F.lit(QUESTION_HEAD.format(rule.focus, rule.kind)), F.col("path"), F.lit(QUESTION_TAIL.format(*rule.tasks, rule.never)))
    item = F.struct(
        F.concat(F.lit("s2_"), L.content_hash(F.concat("path", F.lit("|"), F.lit(rule.kind)))).alias("id"), F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.kind).alias("kind"), F.lit(rule.title).alias("title"),
        "path", F.size("hits").alias("n_hits"), "start_line", "end_line", L.snippet(F.col("lines"), F.col("start_line"), F.col("end_line"), rstrip=True).alias("snippet"), question.alias("question"),
    )
    return rows.select(F.inline(F.array(item)))


def fingerprint() -> Column:
    """Hash of the rule, the first 120 characters of the question (they end before the file's name) and the evidence."""
    head = F.left(L.squeeze(F.col("question")), F.lit(120))
    return L.content_hash(F.concat_ws("||", F.col("rule_id"), head, L.content_hash(F.col("snippet"))))


def anchor_items(flat: DataFrame, rules: tuple[AnchorRule, ...] = ANCHORS) -> DataFrame:
    """Items as of `as_items` from flat drafts of anchor rules, with each rule's own draft answer and trace."""
    of = lambda values: F.element_at(F.create_map(*(x for r, v in zip(rules, values) for x in (F.lit(r.rule_id), v))), F.col("rule_id"))
    steps = lambda r: F.array(*(F.struct(F.lit(i).alias("step"), F.lit(k).alias("kind"), F.lit(c).alias("content"), F.array(F.lit(0)).alias("evidence_refs")) for i, (k, c) in enumerate(zip(STEP_KINDS, r.steps), 1)))
    extra = F.create_map(F.lit("anchor_kind"), F.col("kind"), F.lit("anchor_file"), F.col("path"), F.lit("llm_enriched"), F.lit("false"))
    meta = F.struct(F.lit(ANCHOR_ITEM_KIND).alias("kind"), extra.alias("extra"))
    return flat.select(
        "id", F.lit("scenario2").alias("scenario"), "rule_id", "title", "question", of([F.lit(r.answer) for r in rules]).alias("answer"),
        F.array(evidence(F.col("path"), F.col("start_line"), F.col("end_line"), F.col("snippet"))).alias("evidence"), of([steps(r) for r in rules]).alias("trace"), meta.alias("meta"),
    )


def run_anchor_rules(files: DataFrame, rules: tuple[AnchorRule, ...] = ANCHORS, max_items: int = 200, per_file_kind: int = 2) -> DataFrame:
    """Drafts of all anchor rules: the first of each fingerprint, at most so many of a file and kind and in all, in (rule, path) order."""
    from pyspark.sql import Window

    files = L.with_lines(files)
    rows = reduce(DataFrame.unionByName, (anchors(files, r).withColumn("rule_ord", F.lit(i)) for i, r in enumerate(rules)))
    rows = rows.withColumn("fingerprint", fingerprint())
    first = rows.groupBy("fingerprint").agg(F.min(F.struct("rule_ord", "path")).alias("f"))
    rows = rows.join(first, "fingerprint").where(F.struct("rule_ord", "path") == F.col("f")).drop("f")
    rank = F.row_number().over(Window.partitionBy("path", "kind").orderBy("rule_ord"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= per_file_kind).drop("rank").orderBy("rule_ord", "path").limit(max_items)


def named_definition(files: DataFrame, name: str, hard_max: int = 140) -> DataFrame:
    """(path, start_line, end_line) from the first line that defines `name`."""
    import re

    pattern = rf"(?U)^\s*def\s+{re.escape(name)}\s*\("
    at = F.array_position(F.transform("lines", lambda x: x.rlike(pattern)), True).cast("int")
    return L.with_lines(files).select("path", at.alias("start_line"), F.least(F.col("n_lines"), at + hard_max - 1).alias("end_line")).where("start_line > 0")
