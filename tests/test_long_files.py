import random

from pyspark.sql import functions as F

from millrace.functions import lines as L
from millrace.operators import rules as R


def test_a_file_gives_no_more_than_the_caps(spark):
    """Before, every hit of a rule with a cap over all files became a draft with its evidence, which was shuffled."""
    files = L.with_lines(spark.createDataFrame([("test_a.py", "\n".join(f"async def f{i}():" for i in range(1000)))], "path string, text string"))
    rule = next(r for r in R.RULES if r.rule_id == "S1_ASYNC")
    assert files.select(F.size(R._hits(rule))).first()[0] == rule.total == 150


def test_heads_of_files_change_nothing(spark, monkeypatch):
    rnd = random.Random(3)
    some = ["if x:", "  raise E(x)", "", "  ", "assert x, 1", "def test_f():", '  """d', '  """', "async def g():", "logger.info(1)", "k = os.getenv('A')", "open(p)", "re.compile(p)", "if __name__ == '__main__':", "y = 1"]
    texts = [(f"{'test' * (i % 2)}{i}.py", "\n".join(rnd.choice(some if i % 3 else some[:5]) for _ in range(rnd.randrange(400)))) for i in range(60)]
    files = spark.createDataFrame(texts, "path string, text string").repartition(2).localCheckpoint()
    got = {}
    for head in (1, 7, 100, 1000):
        monkeypatch.setattr(R, "HEAD", head)
        got[head] = sorted(map(tuple, R.run_line_rules(files).collect()))
    assert got[1] == got[7] == got[100] == got[1000] and {r[1] for r in got[1]} == {r.rule_id for r in R.RULES}
