"""Schemas of the grounded items; explicit on every read."""

from pyspark.sql import types as T

SPAN = T.StructType([T.StructField("file_path", T.StringType()), T.StructField("start_line", T.IntegerType()), T.StructField("end_line", T.IntegerType())])
EVIDENCE = T.StructType([T.StructField("span", SPAN), T.StructField("snippet", T.StringType())])
STEP = T.StructType([T.StructField("step", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("content", T.StringType()), T.StructField("evidence_refs", T.ArrayType(T.IntegerType()))])
META = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("extra", T.MapType(T.StringType(), T.StringType())), T.StructField("llm_enriched", T.BooleanType()), T.StructField("llm_error", T.StringType()),
    T.StructField("llm_attempts", T.IntegerType()), T.StructField("llm_question_rolled_back", T.BooleanType()), T.StructField("llm_trace_unique_evidence_count", T.IntegerType()),
])
ITEM = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("scenario", T.StringType()), T.StructField("rule_id", T.StringType()), T.StructField("title", T.StringType()), T.StructField("question", T.StringType()), T.StructField("answer", T.StringType()),
    T.StructField("evidence", T.ArrayType(EVIDENCE)), T.StructField("trace", T.ArrayType(STEP)), T.StructField("meta", META),
])
FILE = T.StructType([T.StructField("path", T.StringType()), T.StructField("text", T.StringType()), T.StructField("size", T.LongType())])
