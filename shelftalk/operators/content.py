"""Tag-based content similarity of books (or of any documents)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelftalk.functions.scores import ranking_key
from shelftalk.functions.text import with_bigrams, word_tokens
from shelftalk.operators.collab import best_per
from shelftalk.operators.rows import row_product
from shelftalk.operators.similarity import best_cosines, cosines_from, shared_cells
from shelftalk.operators.tables import ordered_concat
from shelftalk.sources.scratch import materialize

_ROWS = 1_000  # documents counted at once


def tag_usage(book_tags: DataFrame, tags: DataFrame) -> DataFrame:
    """Rows per tag name. Counted by id first, so the join sees one row per tag."""
    counted = book_tags.groupBy("tag_id").agg(F.count("goodreads_book_id").alias("n"))
    return (
        counted.join(tags, "tag_id").groupBy("tag_name").agg(F.sum("n").alias("number"))
    )


def genre_tags(tags: DataFrame, genres: DataFrame) -> DataFrame:
    """Tags whose name is a known genre."""
    return tags.join(genres.select("tag_name"), "tag_name", "left_semi")


def author_words(authors):
    """Every author as one lower-case word: blanks removed, commas to blanks."""
    joined = F.replace(F.coalesce(authors.cast("string"), F.lit("")), F.lit(" "), F.lit(""))
    return F.lower(F.replace(joined, F.lit(","), F.lit(" ")))


def tag_documents(
    book_tags: DataFrame, genre_tags: DataFrame, books: DataFrame
) -> DataFrame:
    """Genre tags of a book in row order, followed by its authors.

    ``book_tags.goodreads_book_id`` is ``books.book_id``, not ``books.id``.
    """
    named = book_tags.join(genre_tags.select("tag_id", "tag_name"), "tag_id")
    texts = ordered_concat(named, "goodreads_book_id", "pos", "tag_name", "tag_names")
    return texts.join(books, texts.goodreads_book_id == books.book_id).select(
        "goodreads_book_id",
        "title",
        F.concat("tag_names", F.lit(" "), author_words(F.col("authors"))).alias("all_tags"),
    )


def _with_terms(docs: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    tokens = docs.select("id", word_tokens(F.col("text"), stop_words).alias("_tokens"))
    return tokens.select("id", with_bigrams(F.col("_tokens")).alias("terms"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, term, tf)`` of every row's terms."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            ids, terms = batch.slice(at, _ROWS).columns
            lengths = np.asarray(terms.value_lengths().fill_null(0))
            coded = terms.flatten().dictionary_encode()
            words = max(1, len(coded.dictionary))
            cell = np.repeat(np.arange(len(lengths)), lengths) * words + coded.indices.to_numpy()
            cell, tf = np.unique(cell, return_counts=True)
            made = [ids.take(pa.array(cell // words)), coded.dictionary.take(pa.array(cell % words)), pa.array(tf)]
            yield pa.RecordBatch.from_arrays(made, names=["id", "term", "tf"])


def term_counts(docs: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """Unigram and bigram counts ``(id, term, tf)`` of documents ``(id, text)``.

    Tokens, neighbours and counts are formed inside the row of a document; a document without
    any token has no row. Only the counts of an id that several rows have are added up by a shuffle.
    """

    def counts(some: DataFrame) -> DataFrame:
        kind = T.StructType([some.schema["id"]]).add("term", "string").add("tf", "long")
        return _with_terms(some, stop_words).mapInArrow(_counted, kind)

    rows = docs.groupBy(F.col("id").alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    several = materialize(rows.where("_n > 1").select("_id"))
    if several.isEmpty():
        return counts(docs)
    same = F.col("id").eqNullSafe(F.col("_id"))
    again = counts(docs.join(several, same, "left_semi")).groupBy("id", "term").agg(F.sum("tf").alias("tf"))
    return counts(docs.join(several, same, "left_anti")).unionByName(again)


def same_terms(docs: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """``(id, profile)``: documents with the same terms share the lowest id among them.

    Each text is read once, into a stored signature; documents without terms drop out.
    """
    sign = F.sha2(F.array_join(F.sort_array("terms"), "\n"), 256)
    signed = materialize(
        _with_terms(docs, stop_words).select(
            "id", F.when(F.size("terms") > 0, sign).alias("_sign")
        )
    )
    lowest = signed.groupBy("_sign").agg(F.min("id").alias("profile"))
    return signed.join(lowest, "_sign").select("id", "profile")


def _unit_cells(terms: DataFrame) -> DataFrame:
    """Term counts as cells of unit-length vectors."""
    lengths = terms.groupBy("id").agg(F.sqrt(F.sum(F.col("tf") * F.col("tf"))).alias("len"))
    return terms.join(lengths, "id").select(
        F.col("term").alias("key"), "id", (F.col("tf") / F.col("len")).alias("x")
    )


def profile_cells(docs: DataFrame, members: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    """Stored unit-length cells of one document of each profile."""
    profiles = members.where(F.col("id") == F.col("profile")).select("id")
    distinct = docs.join(profiles, "id", "left_semi")
    return materialize(_unit_cells(term_counts(distinct, stop_words)))


def cosine_pairs(
    docs: DataFrame,
    members: DataFrame,
    stop_words: Sequence[str] = (),
    least: float | None = None,
) -> DataFrame:
    """Cosine of every pair of distinct term profiles that share a term.

    Copies are one profile (see :func:`same_terms`), so a group of copies adds no pairs.
    Returns ``(item_a, item_b, score)`` over profile ids; with ``least`` only the pairs that
    reach that score, found without forming all others.
    """
    cells = profile_cells(docs, members, stop_words)
    if least is not None:
        return cosines_from(cells, least)
    return row_product(shared_cells(cells), stats=("sxy",)).select(
        F.col("id_a").alias("item_a"), F.col("id_b").alias("item_b"), F.col("sxy").alias("score")
    )


def similar_documents(
    docs: DataFrame, target_id: int, n: int = 9, stop_words: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` documents closest to one document by cosine, ties by id.

    Linear in the term rows, which are read once: each meets the terms of the target only,
    and the same grouping adds up the products and the lengths.
    """
    wanted = term_counts(docs.where(F.col("id") == target_id), stop_words).select(
        "term", F.col("tf").alias("target_tf")
    )
    own = wanted.agg(F.sqrt(F.sum(F.col("target_tf") * F.col("target_tf")))).scalar()
    sums = (
        term_counts(docs, stop_words)
        .join(F.broadcast(wanted), "term", "left")  # the terms of one document
        .groupBy("id")
        .agg(
            F.sum(F.col("tf") * F.col("target_tf")).alias("dot"),
            F.sum(F.col("tf") * F.col("tf")).alias("len2"),
        )
    )
    return (
        sums.where(F.col("dot").isNotNull() & (F.col("id") != target_id))
        .select("id", (F.col("dot") / (own * F.sqrt("len2"))).alias("score"))
        .orderBy(F.desc(ranking_key(F.col("score"))), "id")
        .limit(n)
    )


def titles_like(
    docs: DataFrame, titles: DataFrame, title: str, n: int = 9, stop_words: Sequence[str] = ()
) -> DataFrame:
    """Titles similar to a title; of several books with that title the lowest id counts."""
    row = titles.where(F.col("title") == title).agg(F.min("id")).first()
    if row[0] is None:
        raise KeyError(title)
    return similar_documents(docs, row[0], n, stop_words).join(titles, "id")


def similar_documents_all(
    docs: DataFrame, n: int = 9, stop_words: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` closest documents of every document: ``(id, rank, other_id, score)``.

    Neighbours are ranked between profiles, and each profile keeps ``n + 1`` documents:
    its own copies (score 1) and the first copies of its best profiles. A document then
    takes the list of its profile without itself. This is exact: at a given score only
    the ``n + 1`` lowest ids of a profile, and the ``n + 1`` profiles with the lowest
    first id, can be among the ``n + 1`` best.
    """
    members = materialize(same_terms(docs, stop_words))
    edges = best_cosines(profile_cells(docs, members, stop_words), n + 1)
    selves = members.where(F.col("id") == F.col("profile")).select(
        F.col("id").alias("item_id"), F.col("id").alias("other_id"), F.lit(1.0).alias("score")
    )
    near = best_per(edges.unionByName(selves), "item_id", "other_id", n + 1)
    firsts = best_per(
        members.select("profile", "id", F.lit(1.0).alias("score")), "profile", "id", n + 1
    ).select(F.col("profile").alias("other_id"), F.col("id").alias("doc_id"))
    ranked = best_per(
        near.select("item_id", "other_id", "score").join(firsts, "other_id"),
        "item_id", "doc_id", n + 1,
    )
    lists = ranked.groupBy("item_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "doc_id", "score"))).alias("_list")
    )  # n + 1 entries each
    others = F.filter("_list", lambda e: e["doc_id"] != F.col("id"))
    return (
        members.join(lists, members.profile == lists.item_id)
        .select("id", F.posexplode(F.slice(others, 1, n)))
        .select(
            "id",
            (F.col("pos") + 1).alias("rank"),
            F.col("col.doc_id").alias("other_id"),
            F.col("col.score").alias("score"),
        )
    )
