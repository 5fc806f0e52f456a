"""Language of short texts from up to two detectors that check each other; the detectors are injected."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "un"
Detector = Callable[[str], str | None]


def _told(detector: Detector | None, text: str) -> str | None:
    try:
        found = detector(text) if detector is not None else None
    except Exception:  # a detector that gives up has nothing to say
        return None
    return None if not found or found == UNKNOWN else found


def detect(text: str | None, first: Detector | None, second: Detector | None) -> tuple[bool, bool, str]:
    """(reliable, english, language): what both say, or the only one that says something; else unknown.

    Texts of one word or without a letter are unknown. The first detector gets texts in small letters if over nine
    tenths of their letters are capitals, and both get them without line breaks where that matters to the first."""
    letters = [c.isupper() for c in text or "" if c.isalpha()]
    if len((text or "").split()) <= 1 or not letters:
        return False, False, UNKNOWN
    plain = text.replace("\n", " ")
    a = _told(first, plain.lower() if sum(letters) > 0.9 * len(letters) else plain)
    b = _told(second, text)
    language = a or b if a is None or b is None or a == b else None
    return (False, False, UNKNOWN) if language is None else (True, language == "en", language)


def language_of(text: Column, first: Detector | None = None, second: Detector | None = None) -> Column:
    """struct(reliable, english, language) of a text column, in Arrow batches."""

    @F.pandas_udf("reliable boolean, english boolean, language string")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([detect(t, first, second) for t in texts], columns=["reliable", "english", "language"])

    return run(text)
