"""Dialog flows: from dialog files or utterances to padded id batches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shelftalk.functions.text import clean_folded
from shelftalk.operators import batches, dialog, subwords, vocabulary as V
from shelftalk.sources import files
from shelftalk.sources.scratch import materialize


def utterances(spark: SparkSession, lines_path: str, conversations_path: str) -> DataFrame:
    """Utterances ``(conv_id, pos, text)`` of the two dialog files."""
    lines = files.read_lines(spark, lines_path, keep=("lineID", "text"))
    return dialog.assemble(files.read_conversations(spark, conversations_path), lines)


@dataclass(frozen=True)
class Prepared:
    """Numbered pairs and the vocabulary they are written in."""

    pairs: DataFrame
    vocabulary: DataFrame

    def batches(self, n_iteration: int = 4000, batch_size: int = 64, seed: int = 0) -> DataFrame:
        return batches.training_batches(
            self.pairs, self.vocabulary, n_iteration, batch_size, seed
        )


def prepare(said: DataFrame, max_words: int = 10, min_count: int = 3) -> Prepared:
    """Pairs cleaned, cut by length and by rare words, with the trimmed vocabulary."""
    cleaned = dialog.clean_pairs(dialog.dialog_pairs(said), clean_folded)
    # Stored first: numbering reads its input twice, and most pairs are gone by now.
    short = dialog.numbered_pairs(materialize(dialog.shorter_than(cleaned, max_words)))
    words = V.trim(V.vocabulary(short), min_count)
    kept = V.pairs_in_vocabulary(short, words)
    return Prepared(dialog.numbered_pairs(kept), words)


def prepare_subwords(
    said: DataFrame, cap: int = 50_000, target_size: int = 2**13, max_length: int = 40
) -> tuple[DataFrame, DataFrame]:
    """Subword vocabulary and padded pairs of the capped second cleaning."""
    pairs = materialize(dialog.dialog_pairs_capped(said, cap))
    corpus = pairs.selectExpr("input AS text").unionAll(pairs.selectExpr("target AS text"))
    pieces = subwords.build_subwords(corpus, target_size)
    return pieces, subwords.encode_padded(pairs, pieces, max_length)
