"""Subword vocabulary of a corpus and subword encoding of sentence pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftalk.functions.arrays import bracket, pad_to
from shelftalk.sources.scratch import delete_tables, materialize, spread

END = "_"  # closes every word, so that pieces can be put together again
BYTES = 256  # ids after the pieces: bytes of what no piece holds
_MEMO = 8_000_000  # characters and ids remembered per task


def vocabulary_size(subwords: DataFrame) -> int:
    """Ids in use besides padding: one per piece, then one per byte."""
    return subwords.count() + BYTES


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """Words of the corpus, closed by the end mark, with their counts.

    A word that holds the mark itself counts as the parts between its marks.
    """
    parts = F.transform(
        F.filter(F.split(text, " "), lambda w: w != ""),
        lambda w: F.split(F.concat(w, F.lit(END * 2)), END),
    )
    # a word "a_b" gives a, b, "", "": the part before the last two closes the word
    closed = F.transform(
        parts,
        lambda p: F.transform(
            F.slice(p, 1, F.size(p) - 2),
            lambda x, i: F.when(i == F.size(p) - 3, F.concat(x, F.lit(END))).otherwise(x),
        ),
    )
    words = texts.select(F.explode(F.flatten(closed)).alias("word")).where("word != ''")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def merge_pairs(parts: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Neighbours joined from left to right, each ranked pair unless the next one ranks better."""
    known = [ranks.get(pair) for pair in zip(parts, parts[1:])] + [None]
    out, at = [], 0
    while at < len(parts):
        rank, after = known[at], known[at + 1] if at + 1 < len(known) else None
        if rank is not None and (after is None or rank <= after):
            out.append(parts[at] + parts[at + 1])
            at += 2
        else:
            out.append(parts[at])
            at += 1
    return out


def _merged(words: DataFrame, ranks: dict[tuple[str, str], int]) -> DataFrame:
    """``(parts, n)`` after a round, without the words that are one piece by now."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [merge_pairs(p, ranks) for p in batch.column("parts").to_pylist()]
            open_ = pa.array([len(p) > 1 for p in done], pa.bool_())
            made = pa.array(done, pa.list_(pa.string()))
            table = pa.RecordBatch.from_arrays([made, batch.column("n")], ["parts", "n"])
            yield table.filter(open_)

    return words.mapInArrow(run, "parts array<string>, n long")


def build_subwords(
    texts: DataFrame,
    target_size: int = 2**13,
    text: str = "text",
    share: int = 4,
    least: int = 2,
) -> DataFrame:
    """``(piece, id, n)``: the characters, and pieces made by joining frequent neighbours.

    Every distinct word starts as its characters, of which the ``target_size`` most frequent
    enter the vocabulary. A round counts neighbouring pieces by the words' counts and takes all
    pairs with at least 1/``share`` of the largest count, and ``least``, as far as there are
    places; they enter the vocabulary with that count and are joined in all words
    (:func:`merge_pairs`). So the minimum count comes down from round to round until the
    vocabulary is full or no pair is frequent enough; neither the number of rounds nor the length
    of a piece is limited. Ties go by the pieces. Ids count from 1, longest piece first; 0 is
    padding. Null and empty texts have no words; without words the result is empty.

    A round reads the words that are still more than one piece. The driver receives at most
    as many pairs as places are left.
    """
    words = materialize(word_counts(texts, text))
    letters = words.select(F.explode(F.split("word", "")).alias("piece"), "n").groupBy("piece")
    chosen = {
        r["piece"]: r["n"]
        for r in letters.agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece")
        .limit(target_size)
        .collect()
    }
    parts = spread(words, "word").where(F.length("word") > 1).select(
        F.split("word", "").alias("parts"), "n"
    )
    stored = [words]
    while len(chosen) < target_size:
        pairs = parts.select(
            F.explode(
                F.arrays_zip(
                    F.slice("parts", 1, F.size("parts") - 1).alias("a"),
                    F.slice("parts", 2, F.size("parts") - 1).alias("b"),
                )
            ).alias("p"),
            "n",
        )
        best = (
            pairs.groupBy("p.a", "p.b")
            .agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least)
            .orderBy(F.desc("n"), "a", "b")
            .limit(target_size - len(chosen))
            .collect()
        )
        if not best:
            break
        taken = [r for r in best if r["n"] * share >= best[0]["n"]]
        for r in taken:
            chosen.setdefault(r["a"] + r["b"], r["n"])
        ranks = {(r["a"], r["b"]): i for i, r in enumerate(taken)}
        parts = materialize(_merged(parts, ranks))
        delete_tables(texts.sparkSession, stored)
        stored = [parts]
    delete_tables(texts.sparkSession, stored)
    entries = sorted(chosen.items(), key=lambda e: (-len(e[0]), -e[1], e[0]))  # target_size
    return texts.sparkSession.createDataFrame(
        [(p, i, n) for i, (p, n) in enumerate(entries, 1)], "piece string, id int, n long"
    )


def _trie(ids: dict[str, int]) -> dict:
    """Pieces as nested dicts by character; a piece's id is under the empty string."""
    root: dict = {}
    for piece, number in ids.items():
        node = root
        for char in piece:
            node = node.setdefault(char, {})
        node[""] = number
    return root


def split_word(word: str, trie: dict, size: int) -> list[int]:
    """Ids of a word and its end mark: the longest piece at each place, else the bytes there.

    Marks within the word are always bytes; an end that no piece holds is the byte of a blank.
    Byte ``b`` has the id ``size + 1 + b``.
    """
    out, at, end = [], 0, len(word)
    marked = word + END
    while at <= end:
        node, found, stop, look = trie, None, at, at
        while look <= end and (look == end or marked[look] != END):
            node = node.get(marked[look])
            if node is None:
                break
            look += 1
            if "" in node:
                found, stop = node[""], look
        if found is None:
            out += [size + 1 + b for b in (marked[at] if at < end else " ").encode()]
            stop = at + 1
        else:
            out.append(found)
        at = stop
    return out


def subword_encoder(subwords: DataFrame) -> Callable[[Column], Column]:
    """Function from a sentence column to an array of subword ids.

    The vocabulary is as large as its target size, so it travels with the task. Of each batch
    only the distinct words are split, of each task only those it does not remember, and their
    ids are taken back to the sentences by place. Characters outside the vocabulary become their
    UTF-8 bytes. A null sentence has null ids, one without words none.
    """
    ids = {r["piece"]: r["id"] for r in subwords.select("piece", "id").collect()}
    size = len(ids)

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trie, memo, held = _trie(ids), {}, 0
        for batch in batches:
            sentences = pc.split_pattern(batch, " ")
            first, last = sentences.offsets[0].as_py(), sentences.offsets[-1].as_py()
            coded = sentences.values.slice(first, last - first).dictionary_encode()
            made = []
            for word in coded.dictionary.to_pylist():
                known = memo.get(word)
                if known is None:
                    known = split_word(word, trie, size) if word else []
                    held += len(word) + len(known)
                    if held > _MEMO:
                        memo.clear()
                        held = len(word) + len(known)
                    memo[word] = known
                made.append(known)
            by_word = pa.array(made, pa.list_(pa.int32())).take(coded.indices)
            bounds = by_word.offsets.to_numpy()[sentences.offsets.to_numpy() - first]
            yield pa.ListArray.from_arrays(
                pa.array(bounds.astype(np.int32)), by_word.values, mask=batch.is_null()
            )

    return encode


def encode_padded(
    pairs: DataFrame, subwords: DataFrame, max_length: int = 40
) -> DataFrame:
    """Pairs as padded id arrays between start and end ids; too long pairs drop out.

    The start id is the first one after pieces and bytes, the end id the next.
    """
    encode = subword_encoder(subwords)
    both = pairs.withColumns({f"{s}_ids": encode(F.col(s)) for s in ("input", "target")})
    return padded(both, vocabulary_size(subwords), max_length)


def padded(encoded: DataFrame, size: int, max_length: int = 40) -> DataFrame:
    """``input_ids`` and ``target_ids`` between ``size + 1`` and ``size + 2``, filled up with 0.

    Rows where one of them, with its marks, is longer than ``max_length`` drop out, as do rows
    without one.
    """
    sides = ("input_ids", "target_ids")
    marked = encoded.withColumns({c: bracket(F.col(c), size + 1, size + 2) for c in sides})
    fits = (F.size("input_ids") <= max_length) & (F.size("target_ids") <= max_length)
    present = F.col("input_ids").isNotNull() & F.col("target_ids").isNotNull()
    return marked.where(present & fits).withColumns(
        {c: pad_to(F.col(c), max_length) for c in sides}
    )


def decode_subwords(sequences: DataFrame, subwords: DataFrame, key: str, ids: str) -> DataFrame:
    """``(key, text)`` from subword ids; start, end and padding ids are skipped.

    Any other id outside the vocabulary is an error. A sequence without pieces is an empty text.
    """
    size = subwords.count()
    unknown = F.raise_error(F.concat(F.lit("unknown subword id "), F.col("id").cast("string")))
    marker = F.col("id").isNull() | F.col("id").isin(0, size + BYTES + 1, size + BYTES + 2)
    byte = F.col("id").between(size + 1, size + BYTES)
    at = sequences.select(key, F.posexplode_outer(ids).alias("at", "id"))
    named = at.join(subwords.select("id", "piece"), "id", "left")
    # bytes in hexadecimal, so that those of one character meet again before they are read
    piece = F.hex(F.encode(F.replace("piece", F.lit(END), F.lit(" ")), "UTF-8"))
    whole = (
        named.withColumn(
            "piece",
            F.when(F.col("piece").isNotNull(), piece)
            .when(byte, F.lpad(F.hex(F.col("id") - (size + 1)), 2, "0"))
            .when(marker, F.lit(""))
            .otherwise(unknown.cast("string")),
        )
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("_p"))
    )
    text = F.unhex(F.array_join("_p.piece", "")).cast("string")
    return whole.select(key, F.trim(text).alias("text"))
