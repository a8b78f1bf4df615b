"""Text column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def whole_word_pattern(keyword: str) -> str:
    """Whole-word pattern that ignores the case of all letters. The word edges are spelled out
    because \\b means different things next to accented letters. They are tested
    after the word, which is the cheaper thing to look for."""
    word, letter = re.escape(keyword), r"[\p{L}\p{N}_]"
    return f"(?iu){word}(?<!{letter}{word})(?!{letter})"


def mentions(keyword: str, columns: Sequence[str]) -> Column:
    """True where any of the text columns holds the keyword; never NULL."""
    pattern = whole_word_pattern(keyword)
    found = [F.coalesce(F.col(c).rlike(pattern), F.lit(False)) for c in columns]
    return reduce(lambda left, right: left | right, found)
