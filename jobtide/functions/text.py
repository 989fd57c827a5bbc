"""Whole-word matching with Unicode word characters, and display formats."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = r"[\p{L}\p{N}_]"


def _is_word(char: str) -> bool:
    return char.isalnum() or char == "_"


def whole_word_pattern(term: str) -> str:
    """Java pattern for *term* between word boundaries.

    A boundary lies between a word and a non-word character, so after the last letter of ``java`` no word
    character may follow, while after ``c++`` one must. Look-arounds on letter and number classes say this
    without depending on what the JVM version means by ``\\b``.
    """
    before = rf"(?<!{_WORD})" if _is_word(term[0]) else rf"(?<={_WORD})"
    after = rf"(?!{_WORD})" if _is_word(term[-1]) else rf"(?={_WORD})"
    return before + re.sub(r"([^\w\s])", r"\\\1", term) + after


def words_of(term: str) -> list[str]:
    """Maximal runs of word characters. Where *term* matches as a whole word, each of them is a word of the text."""
    return re.findall(r"\w+", term)


def split_words(lowered: Column) -> Column:
    """Words of a text in order, in one pass."""
    return F.split(lowered, rf"[^{_WORD[1:-1]}]+")


def contains_word(lowered: Column, words: Column, term: str) -> Column:
    """True where *term* occurs as a whole word in the lower-cased text whose (relevant) words are *words*.

    A term that is one word is looked up. Any other term is searched for only where all its words occur: first as
    bytes, then by its pattern.
    """
    parts = words_of(term)
    test = None
    for part in parts:
        present = F.array_contains(words, part)
        test = present if test is None else test & present
    if parts == [term]:
        return test
    spelled = lowered.contains(term) & lowered.rlike(whole_word_pattern(term))
    return spelled if test is None else test & spelled


def fmt_salary(value: Column) -> Column:
    return F.when(value.isNull(), F.lit("N/A")).otherwise(F.concat(F.lit("$"), F.format_number(value, 0)))


def fixed(value: Column, digits: int) -> Column:
    """Fixed decimals without grouping; ties follow the binary value, half to even."""
    return F.replace(F.format_number(value.cast("double"), digits), F.lit(","), F.lit(""))


def fmt_number(value: Column) -> Column:
    number = value.cast("double")
    return (
        F.when(number >= 1_000_000, F.concat(fixed(number / 1_000_000, 1), F.lit("M")))
        .when(number >= 1_000, F.concat(fixed(number / 1_000, 1), F.lit("K")))
        .otherwise(F.format_number(number, 0))
    )
