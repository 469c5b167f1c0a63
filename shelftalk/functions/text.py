"""Text functions on columns: cleaning rules of the two dialog pipelines, word tokens."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Sequence
from functools import lru_cache
from string import ascii_letters

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default analyser's word (two or more letters, digits or underscores).
WORD = r"[\p{L}\p{N}_]{2,}"


def strip_space(c: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(c, r"^[\s\h\x{85}]+|[\s\h\x{85}]+$", "")


def space_before_stops(c: Column) -> Column:
    return F.regexp_replace(c, "([.!?])", " $1")


def space_around_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, "([?.!,])", " $1 ")


def collapse_space(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", " ")


def collapse_blanks_and_quotes(c: Column) -> Column:
    return F.regexp_replace(c, '[" ]+', " ")


def keep_letters(c: Column, also: str = ".!?") -> Column:
    """Everything but ASCII letters and the characters in ``also`` becomes one blank.

    The letters are listed singly: Java then tests them with one bit table, which is several
    times as fast as a class of two ranges.
    """
    return F.regexp_replace(c, f"[^{ascii_letters}{also}]+", " ")


@F.pandas_udf(T.StringType())
def fold_marks(texts: pd.Series) -> pd.Series:
    """Canonical decomposition without non-spacing marks, for any script."""

    def fold(s):
        if s is None or s.isascii():
            return s
        return "".join(
            ch for ch in unicodedata.normalize("NFD", s) if unicodedata.category(ch) != "Mn"
        )

    return texts.map(fold)


@lru_cache(maxsize=1)
def _latin_folding() -> tuple[str, str]:
    """Characters that fold to one ASCII letter, and those letters."""
    accented, plain = [], []
    for point in range(0x80, sys.maxunicode + 1):
        ch = chr(point)
        if unicodedata.decomposition(ch):
            base = "".join(
                d for d in unicodedata.normalize("NFD", ch) if unicodedata.category(d) != "Mn"
            )
            if len(base) == 1 and base.isascii() and base.isalpha():
                accented.append(ch)
                plain.append(base)
    return "".join(accented), "".join(plain)


def fold_latin(c: Column) -> Column:
    """Accent folding of Latin letters inside the JVM.

    Equal to :func:`fold_marks` wherever the result is an ASCII letter or a mark is
    dropped; letters of other scripts stay as they are. That is all a cleaning rule that
    afterwards keeps ASCII letters only can observe.
    """
    return F.regexp_replace(F.translate(c, *_latin_folding()), r"\p{Mn}+", "")


def clean_folded(c: Column) -> Column:
    """Cleaning A: lower case, accents folded, blank before ``. ! ?``, rest blanked.

    Blanking leaves no two white-space characters next to each other, so collapsing them
    is not a step of its own.
    """
    return F.trim(keep_letters(space_before_stops(fold_latin(F.lower(c)))))


def clean_plain(c: Column) -> Column:
    """Cleaning B: lower case, blanks around ``? . ! ,``, rest (accents too) blanked.

    Quotes and runs of blanks are among what the last step blanks.
    """
    return F.trim(keep_letters(space_around_punctuation(F.lower(c)), "?.!,"))


def word_tokens(c: Column, stop_words: Sequence[str] = ()) -> Column:
    """Lower-cased words of two or more characters, stop words removed, in order."""
    tokens = F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))
    if stop_words:
        tokens = F.filter(tokens, lambda t: ~t.isin(list(stop_words)))
    return tokens


def with_bigrams(tokens: Column) -> Column:
    """The tokens followed by the pairs of neighbours joined by a blank."""
    after = F.slice(tokens, F.lit(2), F.size(tokens))
    pairs = F.zip_with(tokens, after, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(tokens, F.filter(pairs, lambda p: p.isNotNull()))


def starts_upper_or_digit(c: Column) -> Column:
    return c.rlike(r"^[\p{Lu}\p{Nd}]")


def starts_lower(c: Column) -> Column:
    return c.rlike(r"^\p{Ll}")


def id_list(c: Column) -> Column:
    """Array from the text of a list of quoted ids, e.g. ``['L1', 'L2']``.

    Text that is no such list is an error; null stays null.
    """
    kind = T.ArrayType(T.StringType())
    bad = F.raise_error(F.concat(F.lit("not a list of ids: "), c)).cast(kind)
    read = F.from_json(c, kind, {"allowSingleQuotes": "true"})
    return F.when(c.isNotNull(), F.coalesce(read, bad))


def recode(c: Column, numbers: dict[str, int]) -> Column:
    """Number of a label; null for a label outside the dictionary."""
    entries = [F.lit(v) for pair in numbers.items() for v in pair]
    return F.create_map(*entries)[c]
