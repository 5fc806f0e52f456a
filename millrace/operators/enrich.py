"""Enrichment of drafts by a language model: prompts, reply repair, validation, resume.

The model is any callable from (system, user) to text, called in Arrow batches; everything
else is expressions. A failed item stays as it was, with its error, and counts as done
unless `retry_failed` is asked for.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.lines import head_tail, squeeze

# Fixed values.
SNIPPET_CHARS, EVIDENCE_CHARS = 2500, 12000
MIN_STEPS, MAX_STEPS, ATTEMPTS = 4, 8, 3
KINDS = ("extract", "reason", "answer")
PAD = "If the evidence does not show a mechanism explicitly, state 'Insufficient evidence' and list what is missing."
STEP_TYPE = "array<struct<step:int,kind:string,content:string,evidence_refs:array<int>>>"
SYSTEM = "Use only the evidence given. Output one JSON object with question, answer and trace."


def evidence_block(evidence: Column, per_snippet: int = SNIPPET_CHARS, total: int = EVIDENCE_CHARS) -> Column:
    """Evidence as text within a budget: blocks are added until one does not fit, which is noted as omitted."""
    blocks = F.transform(evidence, lambda e, i: F.concat(F.lit("[evidence "), i.cast("string"), F.lit("] file="), e["span"]["file_path"], F.lit(" lines="), e["span"]["start_line"].cast("string"), F.lit("-"), e["span"]["end_line"].cast("string"), F.lit("\n"), head_tail(F.coalesce(e["snippet"], F.lit("")), per_snippet)))
    start = F.struct(F.lit(0).alias("n"), F.array().cast("array<string>").alias("out"), F.lit(False).alias("full"))

    def step(acc, b):
        fits = acc["n"] + F.length(b) <= total
        note = F.concat(F.lit("[evidence "), F.size(acc["out"]).cast("string"), F.lit("] <omitted: evidence budget exceeded; add narrower spans if needed>"))
        more = F.struct((acc["n"] + F.length(b)).alias("n"), F.concat(acc["out"], F.array(b)).alias("out"), F.lit(False).alias("full"))
        over = F.struct(acc["n"].alias("n"), F.concat(acc["out"], F.array(note)).alias("out"), F.lit(True).alias("full"))
        return F.when(acc["full"], acc).when(fits, more).otherwise(over)

    return F.array_join(F.aggregate(blocks, start, step, lambda acc: acc["out"]), "\n\n")


def prompt(items: DataFrame) -> DataFrame:
    """items plus `user`: mode, draft and evidence."""
    free = F.coalesce(F.lower(F.element_at("meta.extra", F.lit("llm_generate_question"))) == "true", F.lit(False))
    mode = F.when(free, "MODE: intent-driven (the question is to be written)").otherwise("MODE: requirement-driven (the question stays unchanged)")
    hint = F.trim(F.coalesce(F.element_at("meta.extra", F.lit("intent_hint")), F.lit("")))
    hint = F.when(free & (hint != ""), F.concat(F.lit("\n--- Intent hint ---\n"), hint)).otherwise("")
    body = F.concat_ws("\n", mode, F.concat(F.lit("id: "), "id"), F.concat(F.lit("rule_id: "), "rule_id"), F.concat(F.lit("title: "), "title"), F.lit("--- Draft question ---"), "question", F.lit("--- Draft answer ---"), F.concat("answer", hint), F.lit("--- Evidence ---"), evidence_block(F.col("evidence")))
    return items.withColumn("user", body)


def first_object(text: str) -> dict:
    """The JSON object of a reply: the whole text, else a fenced block (which then must parse), else the first balanced braces, with strings respected."""
    text = (text or "").strip()
    if not text:
        raise ValueError("empty reply")
    try:
        whole = json.loads(text)
        if isinstance(whole, dict):
            return whole
    except json.JSONDecodeError:
        pass
    if "```" in text:
        block = text.split("```")[1]
        block = block[4:] if block[:4].lower() == "json" else block
        try:
            found = json.loads(block.strip())
        except json.JSONDecodeError as e:
            raise ValueError(f"fenced block does not parse: {e.msg}") from e
        if isinstance(found, dict):
            return found
        raise ValueError("fenced block is no object")
    start = text.find("{")
    if start < 0:
        raise ValueError("no JSON object")
    depth, quoted, skip = 0, False, False
    for i, c in enumerate(text[start:], start):
        if skip:
            skip = False
        elif quoted:
            skip, quoted = c == "\\", c != '"'
        elif c == '"':
            quoted = True
        elif c in "{}":
            depth += 1 if c == "{" else -1
            if not depth:
                try:
                    return json.loads(text[start : i + 1])
                except json.JSONDecodeError as e:
                    raise ValueError(f"JSON does not parse: {e.msg}") from e
    raise ValueError("JSON object is not closed")


REPLY = "question string, answer string, trace array<struct<step:int,kind:string,content:string,evidence_refs:array<int>>>, error string, attempts int"


def parse_reply(text: str) -> tuple:
    j = first_object(text)
    if not {"question", "answer", "trace"} <= set(j):
        raise LookupError("reply lacks question, answer or trace")
    if not isinstance(j["trace"], list) or not j["trace"]:
        raise LookupError("trace is no list or empty")
    steps = []
    for i, t in enumerate(j["trace"], 1):
        if not isinstance(t, dict):
            raise LookupError("trace element is no object")
        refs = t.get("evidence_refs")
        try:
            refs = [int(x) for x in refs] if isinstance(refs, list) else None
        except (TypeError, ValueError) as e:
            raise LookupError("evidence_refs are no numbers") from e
        steps.append({"step": i, "kind": str(t.get("kind", "")), "content": str(t.get("content", "")).strip(), "evidence_refs": refs})
    return str(j["question"]).strip(), str(j["answer"]).strip(), steps


def call_model(prompts: DataFrame, model: Callable[[str, str], str], attempts: int = ATTEMPTS, pause: float = 0.8) -> DataFrame:
    """(id, question, answer, trace, error, attempts): replies that do not parse are asked for again, after a growing pause; other errors are not."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, user in zip(batch["id"], batch["user"]):
                q = a = t = error = None
                n = 0
                while n < attempts:
                    n += 1
                    try:
                        q, a, t = parse_reply(model(SYSTEM, user))
                        error = None
                        break
                    except ValueError as e:
                        error = str(e)
                        if n < attempts:
                            time.sleep(pause * n)
                    except Exception as e:
                        error = str(e)
                        break
                rows.append((key, q, a, t, error, n))
            yield pd.DataFrame(rows, columns=["id", "question", "answer", "trace", "error", "attempts"])

    return prompts.select("id", "user").mapInPandas(run, f"id string, {REPLY}")


def pad_steps(trace: Column) -> Column:
    """One more `reason` step before the last of traces with fewer than MIN_STEPS."""
    refs = F.coalesce(F.get(F.filter(F.transform(trace, lambda t: t["evidence_refs"]), lambda r: F.size(r) > 0), 0), F.array(F.lit(0)))
    extra = F.array(F.struct(F.lit(0).alias("step"), F.lit("reason").alias("kind"), F.lit(PAD).alias("content"), F.slice(refs, 1, 1).alias("evidence_refs"))).cast(STEP_TYPE)
    n = F.size(trace)
    before = F.slice(trace, 1, F.greatest(n - 1, F.lit(0)))
    return F.when(n >= MIN_STEPS, trace).otherwise(F.concat(before, extra, F.slice(trace, F.greatest(n, F.lit(1)), F.lit(1))))


def cap_steps(trace: Column) -> Column:
    """At most MAX_STEPS: the first two, what fits of the middle, and the last."""
    n = F.size(trace)
    return F.when(n <= MAX_STEPS, trace).otherwise(F.concat(F.slice(trace, 1, MAX_STEPS - 1), F.slice(trace, -1, 1)))


def renumber(trace: Column) -> Column:
    return F.transform(trace, lambda t, i: F.struct((i + 1).cast("int").alias("step"), t["kind"].alias("kind"), t["content"].alias("content"), t["evidence_refs"].alias("evidence_refs")))


def trace_error(trace: Column, n_evidence: Column, strict: bool = True) -> Column:
    """NULL for a valid trace, else what is wrong. strict: kinds, contents, references, and two sources where there are two."""
    refs = F.flatten(F.transform(trace, lambda t: F.coalesce(t["evidence_refs"], F.array().cast("array<int>"))))
    out = F.when(F.exists(refs, lambda r: (r < 0) | (r >= n_evidence)), "evidence_refs out of range")
    if not strict:
        return out
    return (
        F.when(F.exists(trace, lambda t: ~t["kind"].isin(*KINDS)), "bad trace kind")
        .when(F.exists(trace, lambda t: F.coalesce(F.size(t["evidence_refs"]), F.lit(0)) < 1), "step without evidence_refs")
        .when(F.exists(refs, lambda r: (r < 0) | (r >= n_evidence)), "evidence_refs out of range")
        .when(F.exists(trace, lambda t: F.length(F.trim(t["content"])) == 0), "empty step")
        .when((n_evidence >= 2) & (F.size(F.array_distinct(refs)) < 2), "fewer than two sources cited")
    )


def apply_replies(items: DataFrame, replies: DataFrame, scenario2: bool = True) -> DataFrame:
    """items with what valid replies say; others unchanged, with `error`. All or nothing per item.

    scenario2: traces are padded, capped and checked strictly, and the question is kept unless the item asks for one (and `rolled_back` tells that the reply changed it)."""
    r = replies.select(F.col("id").alias("_id"), F.col("question").alias("_q"), F.col("answer").alias("_a"), F.col("trace").alias("_t"), F.col("error").alias("_e"), "attempts")
    j = items.join(r, F.col("id") == F.col("_id"), "left")
    t = renumber(cap_steps(pad_steps(F.col("_t")))) if scenario2 else F.col("_t")
    j = j.withColumn("_t", t).withColumn("error", F.coalesce("_e", F.when(F.col("_id").isNull(), "no reply"), trace_error(F.col("_t"), F.size("evidence"), scenario2)))
    ok = F.col("error").isNull()
    free = F.coalesce(F.lower(F.element_at("meta.extra", F.lit("llm_generate_question"))) == "true", F.lit(False)) if scenario2 else F.lit(True)
    changed = ok & ~free & (squeeze(F.col("_q")) != squeeze(F.col("question")))
    return j.select(
        "id", "scenario", "rule_id", "title", F.when(ok & free, F.col("_q")).otherwise(F.col("question")).alias("question"), F.when(ok, F.col("_a")).otherwise(F.col("answer")).alias("answer"), "evidence",
        F.when(ok, F.col("_t")).otherwise(F.col("trace").cast(STEP_TYPE)).alias("trace"), "meta", ok.alias("llm_enriched"), F.col("error").alias("llm_error"), F.col("attempts").alias("llm_attempts"), changed.alias("llm_question_rolled_back"),
        F.when(ok, F.size(F.array_distinct(F.flatten(F.transform("_t", lambda s: F.coalesce(s["evidence_refs"], F.array().cast("array<int>"))))))).alias("llm_trace_unique_evidence_count"),
    )


def remaining(items: DataFrame, done: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Items that are still to do; done: (id) or, to retry failures, (id, llm_enriched)."""
    if retry_failed:
        done = done.where("llm_enriched")
    return items.join(done.select(F.col("id").alias("_id")), F.col("id") == F.col("_id"), "left_anti")


def counters(enriched: DataFrame) -> DataFrame:
    return enriched.agg(F.count("*").alias("total"), F.count_if(F.col("llm_enriched")).alias("ok"), F.count_if(~F.col("llm_enriched")).alias("failed"))


def enrich(items: DataFrame, model: Callable[[str, str], str], done: DataFrame | None = None, scenario2: bool = True, pause: float = 0.8) -> DataFrame:
    """Drafts to enriched items, those in `done` left out."""
    todo = remaining(items, done) if done is not None else items
    return apply_replies(todo, call_model(prompt(todo), model, pause=pause), scenario2)


# The prompt of answers that are taken as they come, and the mark of those that failed.
PLAIN_PROMPT = """You are given architecture/design evidence extracted from a local repository.

Task:
Answer the question STRICTLY using ONLY the evidence. If evidence is insufficient, say "Insufficient evidence" and list what is missing.

Question:
{question}

Evidence:
{evidence}
"""
FAILED_MARK = "\n\n[LLM_ENRICH_FAILED] "


def enrich_inline(items: DataFrame, complete: Callable[[str], str] | None = None) -> DataFrame:
    """items (id, question, answer, evidence, meta, ...) whose answer is the model's, and `llm_enriched` in meta.extra.

    A failure keeps the draft and adds the mark and the error; without a model the drafts stay. Prompts go to the tasks in
    Arrow batches; nothing else of an item leaves the plan."""
    marked = lambda ok: F.map_zip_with(F.col("meta.extra"), F.create_map(F.lit("llm_enriched"), ok), lambda k, old, new: F.coalesce(new, old))
    meta = lambda ok: F.struct(F.col("meta.kind").alias("kind"), marked(ok).alias("extra")).alias("meta")
    if complete is None:
        return items.select(*(meta(F.lit("false")) if c == "meta" else F.col(c) for c in items.columns))

    @F.pandas_udf("answer string, error string")
    def ask(prompts: pd.Series) -> pd.DataFrame:
        rows = []
        for p in prompts:
            try:
                rows.append((complete(p), None))
            except Exception as e:  # the draft stays
                rows.append((None, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(rows, columns=["answer", "error"])

    before, rest = PLAIN_PROMPT.split("{question}")
    between, after = rest.split("{evidence}")
    snippets = F.array_join(F.transform("evidence", lambda e: e["snippet"]), "\n\n")
    asked = items.withColumn("_r", ask(F.concat(F.lit(before), F.col("question"), F.lit(between), snippets, F.lit(after))))
    answer = F.when(F.col("_r.error").isNull(), F.col("_r.answer")).otherwise(F.concat("answer", F.lit(FAILED_MARK), F.col("_r.error")))
    ok = F.col("_r.error").isNull().cast("string")
    return asked.select(*(meta(ok) if c == "meta" else answer.alias("answer") if c == "answer" else F.col(c) for c in items.columns))


def error_rows(enriched: DataFrame) -> DataFrame:
    """(value): a line for the error log of each item that failed, as JSON with its id, error and attempts."""
    failed = enriched.where(~F.col("llm_enriched"))
    return failed.select(F.to_json(F.struct("id", F.col("llm_error").alias("error"), F.col("llm_attempts").alias("attempts"))).alias("value"))


def append_errors(enriched: DataFrame, path: str) -> None:
    """Appends the error rows to the log, a folder of text files."""
    error_rows(enriched).write.mode("append").text(path)


def chat_model(url: str, name: str, key: str | None = None, timeout: float = 60, temperature: float = 0.2) -> Callable[[str, str], str]:
    """A model behind a chat-completions address, for `call_model`: two messages out, the first choice's text back."""

    def ask(system: str, user: str) -> str:
        import urllib.request

        body = {"model": name, "temperature": temperature, "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}]}
        head = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})
        request = urllib.request.Request(url.rstrip("/") + "/chat/completions", json.dumps(body).encode(), head)
        with urllib.request.urlopen(request, timeout=timeout) as reply:
            return json.loads(reply.read())["choices"][0]["message"]["content"]

    return ask
