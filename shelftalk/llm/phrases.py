"""Substring dedup by repeated-phrase automata: words of 50-word windows seen earlier go."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelftalk.llm.common import arrow_rows
from shelftalk.llm.windows import Units, covered_units, covered_windows, numbered

WORDS = Units(words=True)


def confirm_by_automata(size: int):
    """Confirming function for :func:`covered_windows`.

    Every window of the passages of one block is a phrase of an Aho-Corasick automaton over
    word numbers, marked with the smallest id that holds it; every passage then runs through
    the automaton of its block, which finds all phrases in it.
    """

    def confirm(_, doc: np.ndarray, texts: list[bytes]) -> list[np.ndarray]:
        numbers: dict[bytes, int] = {}
        passages = [
            tuple([numbers.setdefault(w, len(numbers) + 1) for w in t.split(b" ")]) for t in texts
        ]
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        least: list[int] = []
        known: dict[tuple, int] = {}
        for own, passage in zip(doc.tolist(), passages, strict=True):
            if known.get(passage, own + 1) <= own:
                continue  # its windows are in, with a smaller id
            known[passage] = own
            for at in range(len(passage) - size + 1):
                phrase = passage[at : at + size]
                number = automaton.get(phrase, -1)
                if number < 0:
                    automaton.add_word(phrase, len(least))
                    least.append(own)
                elif own < least[number]:
                    least[number] = own
        automaton.make_automaton()
        return [
            np.array([end - size + 1 for end, number in automaton.iter(passage) if least[number] < own], dtype=np.int64)
            for own, passage in zip(doc.tolist(), passages, strict=True)
        ]

    return confirm


_DIGEST = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
        ("kept_sha256", pa.string()),
    ]
)


def repeated_words(df: DataFrame, units: Units = WORDS) -> DataFrame:
    """Counts and digest of every row without its repeated words.

    A word goes if a window of 50 consecutive words over it also starts in a document with a
    smaller id; all is judged on the input. Words are runs without ASCII white space, a null
    text has none. A null id counts as larger than any other. Rows of one id never cover each
    other. An empty table gives an empty result. Columns: doc_id, n_words, n_removed,
    kept_sha256 (of the kept words joined by a blank).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, data in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                words = units.cut(text.as_py())
                covered = covered_units(data.as_py(), len(words), units.size)
                kept = [words[i] for i in np.flatnonzero(~covered).tolist()] if covered.any() else words
                rows.append((doc, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            if rows:
                yield arrow_rows(_DIGEST, **dict(zip(_DIGEST.names, zip(*rows, strict=True), strict=True)))

    found = covered_windows(numbered(df), units, confirm_by_automata(units.size), block=1 << 20)
    return found.select("doc_id", "text", "data").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )
