"""Drafts as a stream: new files of a folder are enriched and appended, each id once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.enrich import apply_replies, call_model, prompt, remaining
from millrace.schema import ITEM
from millrace.sources.jsonl import done_ids


def enrich_stream(spark: SparkSession, drafts: str, out: str, checkpoint: str, model: Callable[[str, str], str], pause: float = 0.8, scenario2: bool = True) -> StreamingQuery:
    """Each micro-batch leaves out ids that `out` holds, so a batch that is run again writes nothing twice."""

    def batch(rows, _):
        todo = remaining(rows.dropDuplicates(["id"]), done_ids(spark, out))
        apply_replies(todo, call_model(prompt(todo), model, pause=pause), scenario2).write.mode("append").json(out)

    stream = spark.readStream.schema(ITEM).json(drafts)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
