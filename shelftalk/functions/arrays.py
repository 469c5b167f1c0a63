"""Functions on id sequences: markers, padding, transposition, masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ids of the marker words.
PAD, SOS, EOS = 0, 1, 2
MARKERS = {"PAD": PAD, "SOS": SOS, "EOS": EOS}


def pad_to(ids: Column, width: int | Column, fill: int = PAD) -> Column:
    """Fill up at the end to ``width`` ids; longer sequences lose their head."""
    width = F.lit(width) if isinstance(width, int) else width
    missing = F.greatest(width - F.size(ids), F.lit(0))
    kept = F.when(F.size(ids) > width, F.slice(ids, -width, width)).otherwise(ids)
    return F.concat(kept, F.array_repeat(F.lit(fill), missing))


def time_major(rows: Column, length: Column, fill: int = PAD) -> Column:
    """Transpose sequences to one array per position, padded to ``length``."""
    steps = F.sequence(F.lit(0), length - 1)
    return F.transform(
        steps, lambda t: F.transform(rows, lambda r: F.coalesce(F.get(r, t), F.lit(fill)))
    )


def mask(ids: Column) -> Column:
    """1 where a position holds a word, 0 where it is padding."""
    return F.transform(ids, lambda x: F.when(x == PAD, 0).otherwise(1))


def bracket(ids: Column, start: int | Column, end: int | Column) -> Column:
    """Sequence between a start and an end id."""
    as_col = [F.lit(v) if isinstance(v, int) else v for v in (start, end)]
    return F.concat(F.array(as_col[0]), ids, F.array(as_col[1]))


def without_markers(words: Column) -> Column:
    return F.filter(words, lambda w: ~w.isin("EOS", "PAD"))
