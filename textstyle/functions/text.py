"""Text -> sentences, tokens, normalised words and lines, as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on these patterns character by character.
# Possessive and anchored, so that matching needs neither a deep stack nor a second look at
# the same characters, whatever the text.
SENTENCE_END = r"(?<![.!?…])[.!?…]++(?:[ \n\r\t]+|\z)"
WORD = r"[\p{L}\p{M}\p{N}]++(?:['’\-][\p{L}\p{M}\p{N}]++)*+"
PUNCTUATION = r"[^\s\p{L}\p{M}\p{N}]"
LINE_END = r"(?:\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029])"
# The letters kept are a-z, A-Z and À-ÿ. Their complement is spelt out because Java matches a
# negated class of three ranges several times slower.
NOT_A_LETTER = r"[\x00-@\[-`\{-¿Ā-\x{10FFFF}]"
# The same without the line feed. An intersection of classes says so too, but is several times
# slower.
NOT_A_LETTER_NOR_SEPARATOR = r"[\x00-\x09\x0B-@\[-`\{-¿Ā-\x{10FFFF}]"

# French function words left out of word statistics.
STOPWORDS = (
    "le la les de du des un une et en à au aux que qui dans il elle ils elles on nous vous "
    "je tu se sa son ses ce est pas ne plus par sur mais ou donc or ni car avec pour me "
    "ma mon mes te ton ta tes leur leurs"
).split()

# Tokens never hold white space, so a line feed can separate them in a joined string.
TOKEN_SEPARATOR = "\n"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def sentences(text: Column | str) -> Column:
    """Sentences of a text; NULL text has none."""
    parts = F.split(F.coalesce(_col(text), F.lit("")), SENTENCE_END)
    return F.filter(parts, lambda part: F.length(F.trim(part)) > 0)


def tokens(text: Column | str, words_only: bool = False) -> Column:
    """Words and, unless ``words_only``, single punctuation marks, in text order."""
    pattern = WORD if words_only else f"{WORD}|{PUNCTUATION}"
    return F.regexp_extract_all(F.coalesce(_col(text), F.lit("")), F.lit(pattern), F.lit(0))


def normalise_word(word: Column | str, drop: str = NOT_A_LETTER) -> Column:
    """Lower-cased letters of one token."""
    return F.lower(F.regexp_replace(_col(word), drop, ""))


def normalised_words(
    token_array: Column | str, stopwords: Iterable[str] = STOPWORDS, drop: str = NOT_A_LETTER
) -> Column:
    """Normalised non-empty words of a token array, stopwords removed.

    ``drop`` is the character class of what is deleted from tokens.
    The tokens are cleaned as one joined string: two regex passes per document
    instead of one interpreted call per token.
    """
    joined = F.array_join(_col(token_array), TOKEN_SEPARATOR)
    dropped = (
        NOT_A_LETTER_NOR_SEPARATOR if drop == NOT_A_LETTER else f"[{drop}&&[^{TOKEN_SEPARATOR}]]"
    )
    cleaned = F.lower(F.regexp_replace(joined, f"{dropped}+", ""))
    unwanted = ["", *stopwords]
    return F.filter(F.split(cleaned, TOKEN_SEPARATOR), lambda word: ~word.isin(unwanted))


def lines(text: Column | str) -> Column:
    """Lines of a text under all Unicode line ends; no empty line after a final line end."""
    whole = F.coalesce(_col(text), F.lit(""))
    last_end = (
        F.when(whole.endswith("\r\n"), 2)
        .when(F.substring(whole, -1, 1).rlike(LINE_END), 1)
        .otherwise(0)
    )
    without_last_end = F.substring(whole, F.lit(1), F.length(whole) - last_end)
    return F.when(whole == "", F.array().cast("array<string>")).otherwise(
        F.split(without_last_end, LINE_END)
    )
