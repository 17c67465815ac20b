"""Four ways to clean a text before it is cut into terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagwright.functions.charsets import SPACE, WORD

#: characters each cleaner keeps besides white space
KEPT = {
    "ascii": "a-zA-Z0-9",
    "word": WORD,
    "word_dash_dot": WORD + r"\-.",
    "strict": WORD + r"\-.",
}


def clean(text: Column, mode: str) -> Column:
    """Lower-case, blank out what the mode does not keep, squeeze the blanks.

    ``strict`` also removes links first and words of one or two characters last.
    """
    t = F.lower(text)
    if mode == "strict":
        t = F.regexp_replace(t, f"http[^{SPACE}]+|www[^{SPACE}]+", "")
    squeezed = F.trim(F.regexp_replace(t, f"[^{KEPT[mode]}]+", " "))
    if mode != "strict":
        return squeezed
    long_words = F.filter(F.split(squeezed, " "), lambda w: F.length(w) > 2)
    return F.array_join(long_words, " ")
