"""Syllable estimates: vowel groups per word, at least one.

``hyphens="count"`` (the default) also counts every hyphen inside a word as one
group, ``hyphens="ignore"`` counts vowel groups only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textstyle.functions.text import TOKEN_SEPARATOR, _col

# Fixed value: letters that open or continue a syllable.
VOWELS = "aeiouyàâéèêëîïôùûü"


def _groups(joined: Column, hyphens: str) -> Column:
    """Replace every counted group by one ``-``; keep token separators, drop the rest."""
    if hyphens not in ("count", "ignore"):
        raise ValueError(f"hyphens must be 'count' or 'ignore', not {hyphens!r}")
    kept = VOWELS + TOKEN_SEPARATOR + ("-" if hyphens == "count" else "")
    gaps_marked = F.regexp_replace(F.lower(joined), f"[^{kept}]+", ".")
    grouped = F.regexp_replace(gaps_marked, f"[{VOWELS}]+", "-")
    return F.replace(grouped, F.lit("."), F.lit(""))


def word_syllables(word: Column | str, hyphens: str = "count") -> Column:
    """Syllables of one word."""
    return F.greatest(F.length(_groups(_col(word), hyphens)), F.lit(1))


def token_syllables(token_array: Column | str, hyphens: str = "count") -> Column:
    """``array<int>``: syllables of each token.

    All tokens of a document are processed as one joined string, so the regex
    work is three passes per document rather than per token.
    """
    array = _col(token_array)
    groups = F.split(_groups(F.array_join(array, TOKEN_SEPARATOR), hyphens), TOKEN_SEPARATOR)
    counts = F.transform(groups, lambda group: F.greatest(F.length(group), F.lit(1)))
    return F.when(F.size(array) > 0, counts).otherwise(F.array().cast("array<int>"))


def text_syllables(token_array: Column | str, hyphens: str = "count") -> Column:
    """Syllables of a whole token array."""
    return F.aggregate(
        token_syllables(token_array, hyphens), F.lit(0), lambda total, count: total + count
    )
