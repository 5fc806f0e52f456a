"""Command line, loaders, facets and pair splits."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import numpy as np
from pyspark.sql import functions as F

from millrace import __main__ as cli
from millrace.operators import entities as N
from millrace.operators import imports as I
from millrace.operators import metrics as M
from millrace.sources import jsonl
from test_resolve import people


class Service(BaseHTTPRequestHandler):
    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        fails = "cache" in body["messages"][1]["content"] or self.headers["Authorization"] != "Bearer k1"
        trace = [{"step": 1, "kind": k, "content": "c", "evidence_refs": [0]} for k in ("extract", "reason", "reason", "answer")]
        text = "no" if fails else "Sure: " + json.dumps({"question": "Q?", "answer": "done by " + body["model"], "trace": trace})
        reply = json.dumps({"choices": [{"message": {"content": text}}]}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(reply)

    def log_message(self, *_):
        pass


def test_from_tree_to_chat_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("time.sleep", lambda s: None)
    (tmp_path / "tree").mkdir()
    (tmp_path / "tree" / "a.py").write_text("# first stage\nimport os\nk = os.getenv('APP')\n# then the next step\n")
    (tmp_path / "tree" / "b.py").write_text("x = {}  # lazy cache\n")
    (tmp_path / "key").write_text("k1\n")
    at = lambda n: f"file://{tmp_path}/{n}"
    do = lambda *a: cli.run(spark, cli.parser().parse_args(a))
    assert do("line-drafts", "--tree", str(tmp_path / "tree"), "--out", at("s1")) == 1
    assert do("anchor-drafts", "--tree", str(tmp_path / "tree"), "--out", at("s2")) == 2
    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    ask = ["enrich", "--items", at("s2"), "--out", at("done"), "--errors", at("log"), "--url", f"http://127.0.0.1:{server.server_port}/v1/", "--model", "m", "--key-file", str(tmp_path / "key")]
    assert do(*ask) == 2 and do(*ask) == 0  # what is done is left out
    server.shutdown()
    log = [json.loads(r["value"]) for r in spark.read.text(at("log")).collect()]
    assert len(log) == 1 and log[0]["attempts"] == 3
    assert {r["answer"][:9] for r in spark.read.json(at("done")).collect()} == {"done by m", "(draft) P"}
    assert do("chat-rows", "--items", at("done"), at("s1"), "--out", at("chat")) == 3


def test_loaders(spark, tmp_path):
    (tmp_path / "counts.json").write_text(json.dumps({"first_dict": {"ann": 3}, "last_dict": {"lee": 5, "poe": 1}, "first_last_dict": {}, "last_first_initial_dict": {"lee a": 2}}))
    got = jsonl.read_name_counts(spark, f"file://{tmp_path}/counts.json")
    assert {k: sorted(map(tuple, v.collect())) for k, v in got.items()} == {"first": [("ann", 3)], "last": [("lee", 5), ("poe", 1)], "first_last": [], "last_first_initial": [("lee a", 2)]}
    (tmp_path / "names.txt").write_text("bill,william\n\nbob,robert\nbill,william\nalone\n")
    assert sorted(map(tuple, jsonl.read_aliases(spark, f"file://{tmp_path}/names.txt").collect())) == [("bill", "william"), ("bob", "robert")]
    np.savez(tmp_path / "v.npz", vectors=np.arange(6.0).reshape(3, 2), keys=np.array(["p1", "p2", "p3"]))
    keys = spark.createDataFrame([("p3",), ("p1",), ("x",)], "key string")
    rows = jsonl.read_vectors(spark, f"file://{tmp_path}/v.npz", keys)
    assert {r["key"]: r["vector"] for r in rows.collect()} == {"p1": [0.0, 1.0], "p3": [4.0, 5.0]}
    rows.write.parquet(f"file://{tmp_path}/v")
    assert jsonl.read_vectors(spark, f"file://{tmp_path}/v").count() == 2


def test_pair_splits_and_samples(spark):
    rows = spark.createDataFrame([("k", i, "ann" if i % 3 else "bo", i % 4) for i in range(12)] + [("m", 50, "ann", 1)], "block string, id long, name string, person long")
    pairs = N.sample_pairs(rows, "block", "id", "name", "person", 20, 3).collect()
    assert len(pairs) == 4 * 5 - sum(max(0, 5 - c) for c in _kinds(rows, "block").values()) and all(r["a"] < r["b"] and r["label"] == (r["a"] % 4 == r["b"] % 4) for r in pairs)
    assert N.sample_pairs(rows, "block", "id", "name", "person", 500, 3, balanced=False).count() == 66
    assert N.sample_pairs(rows, "block", "id", "name", "person", 500, 3, balanced=False, within=False).count() == 78
    splits = spark.createDataFrame([(i, "train" if i < 6 else "test") for i in range(12)], "id long, split string")
    out = N.split_pairs(N.sample_pairs(rows, "block", "id", "name", "person", 500, 3, balanced=False), splits)
    assert out.groupBy("split").count().orderBy("split").collect() == [("test", 15), ("train", 15)]


def _kinds(rows, block):
    out = {}
    data = rows.collect()
    for x in data:
        for y in data:
            if x["id"] < y["id"] and x[block] == y[block]:
                key = (x["name"] == y["name"], x["person"] == y["person"])
                out[key] = out.get(key, 0) + 1
    return out


def test_facets_by_enumeration(spark):
    sigs, papers = people(spark, ["D", "David", "David", "Donald", "David"])
    truth = spark.createDataFrame([("c1", "s00"), ("c1", "s01"), ("c2", "s02"), ("c2", "s04"), ("c2", "other")], "cluster_id string, signature_id string")
    rows = {r["item"]: r for r in M.signature_facets(sigs, papers, truth).collect()}
    assert set(rows) == {"s00", "s01", "s02", "s04"}  # Donald has no true cluster
    assert [rows[i]["homonymity"] for i in ("s00", "s01", "s02", "s04")] == [None, 0.67, 0.33, 0.33]
    assert [rows[i]["synonymity"] for i in ("s00", "s01", "s02", "s04")] == [0.33, 0.33, None, None]
    assert [rows["s00"][c] for c in ("block_size", "cluster_size", "n_authors", "year", "first_name", "affiliation", "email", "abstract", "venue", "references", "multiple_authors")] == [5, 2, 1, 2000, 0, 0, 0, 0, 1, 0, 0]
    assert rows["s02"]["cluster_size"] == 3 and rows["s02"]["first_name"] == 1 and rows["s02"]["gender"] is None
    scores = spark.createDataFrame([("s00", 0.5), ("s01", 1.0), ("s02", 0.0), ("s04", 1.0)], "item string, f1 double")
    got = {(r["facet"], r["value"]): (r["n"], r["f1"]) for r in M.facet_eval(sigs, papers, truth, scores).collect()}
    assert got["first_name", "0"] == (1, 0.5) and got["cluster_size", "3"] == (2, 0.5) and not any(f == "gender" for f, _ in got)


def test_module_files(spark):
    files = spark.createDataFrame([("pkg/__init__.py", ""), ("pkg/a.py", ""), ("b.py", "")], "path string, text string")
    assert [[r["path"] for r in I.module_files(files, m).collect()] for m in ("pkg", "pkg.a", "c")] == [["pkg/__init__.py"], ["pkg/a.py"], []]
    assert files.where(F.col("path") == "b.py").count() == 1
