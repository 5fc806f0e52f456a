"""Chat rows for supervised fine-tuning from enriched items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The prompt format and its limits.
SYSTEM = (
    "You are a repository-grounded assistant. Use ONLY the provided evidence snippets. Do NOT invent APIs, file names, functions, config keys, or behaviors not present in evidence. "
    "If evidence is insufficient, say 'Insufficient evidence' and list what is missing."
)
MOST_CHARS = 8000


def evidence_text(evidence: Column, most: int = MOST_CHARS) -> Column:
    number = lambda c: F.coalesce(c.cast("string"), F.lit("?"))
    block = lambda e, i: F.concat(F.lit("[evidence "), i.cast("string"), F.lit("] file="), F.coalesce(e["span"]["file_path"], F.lit("UNKNOWN_FILE")), F.lit(" lines="), number(e["span"]["start_line"]), F.lit("-"), number(e["span"]["end_line"]), F.lit("\n"), F.coalesce(e["snippet"], F.lit("")))
    text = F.regexp_replace(F.array_join(F.transform(evidence, block), "\n\n"), r"^\s+|\s+$", "")
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("\n\n...<truncated>..."))).otherwise(text)


def sft_rows(items: DataFrame, include_trace: bool = False) -> DataFrame:
    """(id, system, user, target, messages) of items with a question, an answer and evidence."""
    kept = items.where((F.length("question") > 0) & (F.length("answer") > 0) & (F.size("evidence") > 0))
    user = F.concat(F.trim("question"), F.lit("\n\n--- Evidence ---\n"), evidence_text(F.col("evidence")), F.lit("\n"))
    target = F.trim("answer")
    if include_trace:
        target = F.concat(target, F.lit("\n\n--- RATIONALE_TRACE_JSON ---\n"), F.to_json("trace"))
    rows = kept.select("id", F.lit(SYSTEM).alias("system"), user.alias("user"), target.alias("target"))
    message = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    return rows.withColumn("messages", F.array(message("system", "system"), message("user", "user"), message("assistant", "target")))
