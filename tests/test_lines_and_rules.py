import hashlib

from pyspark.sql import functions as F

from millrace.functions import lines as L
from millrace.operators import imports as I
from millrace.operators import rules as R


def test_lines_follow_splitlines(spark):
    texts = [None, "", "a", "a\n", "a\r\nb\rc", "\n\n", "x\x0cy\x1cz\x85w w", "é\n😀"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", L.split_lines(F.col("t")).alias("x")).collect()
    assert {r["i"]: r["x"] for r in got} == {i: (t or "").splitlines() for i, t in enumerate(texts)}


def test_snippet_clamps_and_numbers(spark):
    df = spark.createDataFrame([("a\nb  \nc",)], "text string").withColumn("path", F.lit("p"))
    row = L.with_lines(df).select(L.snippet(F.col("lines"), F.lit(0), F.lit(9)).alias("a"), L.snippet(F.col("lines"), F.lit(2), F.lit(1), rstrip=True).alias("b"), L.snippet(F.col("lines"), F.lit(2), F.lit(3), numbered=False).alias("c")).first()
    assert row["a"] == "   1: a\n   2: b  \n   3: c" and row["b"] == "   2: b" and row["c"] == "b  \nc"


def test_ids(spark):
    row = spark.range(1).select(L.stable_id(F.lit("x"), F.lit("é")).alias("a"), L.content_hash(F.lit("x")).alias("b")).first()
    assert row["a"] == hashlib.sha1("x||é".encode()).hexdigest()[:16] and row["b"] == hashlib.sha256(b"x").hexdigest()[:16]


def _window(c, n, soft, hard):
    s, e = max(1, c - soft), min(n, c + soft)
    while e - s + 1 > hard:
        if e - c > c - s:
            e -= 1
        else:
            s += 1
    return s, e


def test_window_shrinks_as_the_loop_does(spark):
    cases = [(c, n, soft, hard) for n in (1, 5, 30) for c in range(1, n + 1, 3) for soft in (2, 9, 40) for hard in (1, 4, 11)]
    for soft in (2, 9, 40):
        for hard in (1, 4, 11):
            mine = [x for x in cases if x[2:] == (soft, hard)]
            df = spark.createDataFrame([(c, n) for c, n, _, _ in mine], "c int, n int")
            s, e = R.window(F.array("c"), F.col("n"), soft, hard)
            assert [(r[0], r[1]) for r in df.coalesce(1).select(s, e).collect()] == [_window(*x) for x in mine]


def test_rules_on_a_small_file(spark):
    text = 'import os\nkey = os.getenv("APP_KEY")\ndef f(x):\n    """Doc\n    more"""\n    if x:\n\n        raise ValueError("a")\n    assert x, "b"\n    logger.info("x")\nif __name__ == "__main__":\n    f(1)\n'
    files = spark.createDataFrame([("tests/m.py", text), ("empty.py", ""), ("none.py", None)], "path string, text string")
    got = {(r["rule_id"], r["start_line"], r["end_line"], r["name"]) for r in R.run_line_rules(files).collect()}
    assert got == {("S1_CONFIG_ENV", 2, 2, "APP_KEY"), ("S1_DOCSTRING_CONTRACT", 3, 5, "f"), ("S1_RAISE_EXCEPTION", 8, 10, "ValueError"), ("S1_VALIDATION", 6, 8, "x"), ("S1_VALIDATION", 9, 9, "x"), ("S1_LOGGING", 10, 10, "info"), ("S1_ENTRYPOINT_MAIN", 11, 12, "tests/m.py")}
    items = R.as_items(R.run_line_rules(files)).collect()
    assert all(len(i["evidence"]) == 1 and len(i["trace"]) == 3 and i["id"].startswith("s1_") for i in items)


def test_caps_bind(spark):
    files = spark.createDataFrame([("a.py", "\n".join("    raise E" for _ in range(50)))], "path string, text string")
    assert R.line_rule(L.with_lines(files), R.RULES[2]).count() == 30


def test_symbols_by_the_parser(spark):
    text = "import a.b, c\nfrom . import d\nfrom e import f\ndef g():\n    import h\nclass K: pass\nx, y = 1, 2\nz = 3\n"
    got = {(r["kind"], r["name"]) for r in I.parse_files(spark.createDataFrame([("m.py", text), ("bad.py", "def (")], "path string, text string")).collect()}
    assert got == {("import", "a.b"), ("import", "c"), ("import", "h"), ("from", ""), ("from", "e"), ("function", "g"), ("class", "K"), ("assign", "z"), ("unparsed", None)}


def test_source_tree_sees_all_files(spark, tmp_path):
    from millrace.sources.pyfiles import source_tree

    for name, data in {"pkg/__init__.py": b"from x import y\n", "pkg/m.py": b"a\r\nb", "pkg/bad.py": b"\xff\xfeok", "pkg/empty.py": b"", "pkg/.hid/h.py": b"x", "build/x.py": b"x", "README": b"r", "notes.txt": b"n", "big.py": b"#" * 2_000_001}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    python = {r["path"] for r in source_tree(spark, str(tmp_path)).collect()}
    assert python == {"pkg/__init__.py", "pkg/m.py", "pkg/bad.py", "pkg/empty.py", "big.py"}
    documents = {r["path"]: r["text"] for r in source_tree(spark, str(tmp_path), "documents").collect()}
    assert set(documents) == {"pkg/__init__.py", "pkg/m.py", "pkg/bad.py", "pkg/empty.py", "pkg/.hid/h.py", "README", "notes.txt"}
    assert "�" in documents["pkg/bad.py"]
    assert R.anchors(L.with_lines(source_tree(spark, str(tmp_path))), R.ANCHORS[0]).count() == 1
