"""Typographic dialogue test for one line of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textstyle.functions.text import _col

# Marks that open a dialogue line, and a quoted fragment inside one.
LEADING_MARKS = r"«\"„—–\-"
# From the first opening mark only: where that one finds no closing mark, none later does.
QUOTED = r'^[^«"]*+[«"][^»"]*+[»"]'


def is_dialogue(line: Column | str, leading_marks: str = LEADING_MARKS) -> Column:
    """True when a line opens with a dialogue mark or holds a quoted fragment.

    White space before the mark is skipped in the Unicode sense, including
    no-break spaces and the four information separators.
    """
    line = _col(line)
    opens = r"(?U)^[\s\x1C-\x1F]*[" + leading_marks + "]"
    return line.rlike(opens) | line.rlike(QUOTED)
