import json
import time

import pytest
from pyspark.sql import functions as F

from millrace.operators import enrich as E
from millrace.operators.sft import sft_rows
from millrace.schema import ITEM
from millrace.sources import jsonl

GOOD = {"question": "Q?", "answer": "A", "trace": [{"step": 9, "kind": k, "content": "c", "evidence_refs": [0]} for k in ("extract", "reason", "reason", "answer")]}


def item(i, n_evidence=1, **extra):
    ev = [{"span": {"file_path": "f.py", "start_line": 1, "end_line": 2}, "snippet": "   1: x"}] * n_evidence
    return dict(id=i, scenario="scenario2", rule_id="R", title="t", question="Q?", answer="draft", evidence=ev, trace=[], meta={"kind": "k", "extra": extra})


def test_reply_forms():
    text = json.dumps(GOOD)
    for reply in (text, f"```json\n{text}\n```", f"Sure: {text} done", 'note {"a": "}"}'):
        assert isinstance(E.first_object(reply), dict)
    for bad in ("", "no braces", "{ open", "{,}", "[1, 2]", "```json\n{,}\n```"):
        with pytest.raises(ValueError):
            E.first_object(bad)


def test_enrich_paths(spark, tmp_path):
    seen = str(tmp_path / "calls")

    def model(system, user):
        key = user.split("id: ")[1].split("\n")[0]
        with open(seen, "a") as f:
            f.write(key + "\n")
        if key == "garbled":
            return "no json"
        if key == "down":
            raise RuntimeError("unavailable")
        reply = json.loads(json.dumps(GOOD))
        if key == "changed":
            reply["question"] = "Other?"
        if key == "short":
            reply["trace"] = reply["trace"][:1]
        if key == "long":
            reply["trace"] = reply["trace"][:1] * 12
        if key == "range":
            reply["trace"][0]["evidence_refs"] = [5]
        return json.dumps(reply)

    items = spark.createDataFrame([item(k) for k in ("ok", "garbled", "down", "changed", "short", "long", "range")] + [item("two", 2), item("free", llm_generate_question="true")], ITEM)
    rows = {r["id"]: r for r in E.enrich(items, model, pause=0).collect()}
    assert rows["ok"]["llm_enriched"] and [t["step"] for t in rows["ok"]["trace"]] == [1, 2, 3, 4] and rows["ok"]["answer"] == "A"
    assert not rows["garbled"]["llm_enriched"] and rows["garbled"]["llm_attempts"] % 3 == 0 and rows["garbled"]["answer"] == "draft"
    assert rows["down"]["llm_attempts"] == 1 and "unavailable" in rows["down"]["llm_error"]
    assert rows["changed"]["question"] == "Q?" and rows["changed"]["llm_question_rolled_back"]
    assert len(rows["short"]["trace"]) == 2 and len(rows["long"]["trace"]) == 8
    assert rows["range"]["llm_error"] == "evidence_refs out of range" and rows["two"]["llm_error"] == "fewer than two sources cited"
    done = spark.createDataFrame([("ok", True), ("down", False)], "id string, llm_enriched boolean")
    assert E.remaining(items, done).count() == 7 and E.remaining(items, done, retry_failed=True).count() == 8


def test_jsonl_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    items = spark.createDataFrame([item("a"), item("é")], ITEM)
    jsonl.write_items(items, path)
    assert {r["id"] for r in jsonl.read_items(spark, path).collect()} == {"a", "é"}
    assert {r["id"] for r in jsonl.done_ids(spark, path).collect()} == {"a", "é"}
    assert jsonl.done_ids(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "bad.jsonl").write_text('{"id": "x"}\n\n{"id": \n')
    assert {r["id"] for r in jsonl.done_ids(spark, str(tmp_path / "bad.jsonl")).collect()} == {"x"}
    with pytest.raises(Exception):
        jsonl.read_items(spark, str(tmp_path / "bad.jsonl")).collect()


def test_keyed_json(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"1": {"cluster_id": "1", "signature_ids": ["0", "1"]}}')
    (tmp_path / "s.json").write_text('{"0": {"1": "disallow"}, "1": {"2": "require"}}')
    assert {tuple(r) for r in jsonl.read_clusters(spark, str(tmp_path / "c.json")).collect()} == {("1", "0"), ("1", "1")}
    assert {tuple(r) for r in jsonl.read_seeds(spark, str(tmp_path / "s.json")).collect()} == {("0", "1", "disallow"), ("1", "2", "require")}


def test_sft(spark):
    rows = sft_rows(spark.createDataFrame([item("a"), {**item("b"), "answer": ""}, item("c", 0)], ITEM), include_trace=True).collect()
    assert [r["id"] for r in rows] == ["a"] and rows[0]["target"].startswith("draft\n\n--- RATIONALE_TRACE_JSON ---") and len(rows[0]["messages"]) == 3


def test_stream_appends_each_id_once(spark, tmp_path):
    from millrace.streaming.enrich_stream import enrich_stream

    drafts, out, check = (str(tmp_path / n) for n in ("drafts", "out", "check"))
    for batch in (["a", "b"], ["b", "c"]):
        jsonl.write_items(spark.createDataFrame([item(k) for k in batch], ITEM), drafts, append=True)
        q = enrich_stream(spark, drafts, out, check, lambda s, u: json.dumps(GOOD), pause=0)
        t = time.time()
        while q.isActive and time.time() - t < 60:
            time.sleep(0.2)
        assert q.exception() is None
    assert sorted(r["id"] for r in spark.read.json(out).collect()) == ["a", "b", "c"]
    assert spark.read.json(out).where(F.col("llm_enriched")).count() == 3


def test_answers_as_they_come(spark):
    """The draft stays with a mark where the model fails; without a model it stays as it is."""
    from millrace.operators import rules as R

    files = spark.createDataFrame([("a.py", "# first stage\nx = 1\n# then the next step"), ("b.py", "cache = {}")], "path string, text string")
    items = R.anchor_items(R.run_anchor_rules(files))
    drafts = {r["id"]: r for r in items.collect()}
    assert {r["rule_id"] for r in drafts.values()} == {"S2_ARCH_RATIONALE_FLOW", "S2_ARCH_RATIONALE_PERF"}
    assert all(r["meta"]["kind"] == "arch_first_design_task" and r["meta"]["extra"]["llm_enriched"] == "false" and len(r["trace"]) == 3 for r in drafts.values())

    def complete(prompt):
        if "cache" in prompt.split("Evidence:")[1]:
            raise TimeoutError("too late")
        return "answer to " + prompt.splitlines()[0]

    rows = {r["rule_id"]: r for r in E.enrich_inline(items, complete).collect()}
    flow, perf = rows["S2_ARCH_RATIONALE_FLOW"], rows["S2_ARCH_RATIONALE_PERF"]
    assert flow["answer"].startswith("answer to You are given") and flow["meta"]["extra"]["llm_enriched"] == "true"
    assert perf["answer"] == drafts[perf["id"]]["answer"] + "\n\n[LLM_ENRICH_FAILED] TimeoutError: too late" and perf["meta"]["extra"]["llm_enriched"] == "false"
    assert perf["meta"]["extra"]["anchor_file"] == "b.py"
    assert {r["id"]: r["answer"] for r in E.enrich_inline(items).collect()} == {k: r["answer"] for k, r in drafts.items()}


def test_error_log(spark, tmp_path):
    import json

    rows = spark.createDataFrame([("i1", True, None, 1), ("i2", False, "no brace", 3)], "id string, llm_enriched boolean, llm_error string, llm_attempts int")
    for _ in range(2):
        E.append_errors(rows, f"file://{tmp_path}/log")
    log = [json.loads(r["value"]) for r in spark.read.text(f"file://{tmp_path}/log").collect()]
    assert log == [{"id": "i2", "error": "no brace", "attempts": 3}] * 2
