"""From conversations to sentence pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftalk.functions.text import clean_plain, id_list, strip_space
from shelftalk.operators.ordering import dense_index, with_next


def assemble(conversations: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines of every conversation in order: ``(conv_id, pos, text)``.

    Conversations are numbered in file order. An id without a line is an error.
    """
    numbered = dense_index(
        conversations.select("utteranceIDs", "_file", "_block", "_at").withColumnRenamed(
            "_at", "_row"
        ),
        ["_file", "_block", "_row"],
        "conv_id",
    )
    said = numbered.select(
        "conv_id", F.posexplode(id_list(F.col("utteranceIDs"))).alias("pos", "lineID")
    )
    found = said.join(lines.select("lineID", "text"), "lineID", "left")
    unknown = F.raise_error(F.concat(F.lit("unknown line id "), F.col("lineID")))
    return found.select(
        "conv_id",
        F.col("pos").cast("long").alias("pos"),
        F.coalesce("text", unknown.cast("string")).alias("text"),
    )


def _answered(utterances: DataFrame) -> DataFrame:
    """Utterances that have an answer, with their place ``_ord`` in the whole table."""
    paired = with_next(utterances, ["conv_id"], ["pos"], {"target": "text"})
    return paired.where("_has_next").select(
        "_ord", "conv_id", "pos", F.col("text").alias("input"), "target"
    )


def consecutive(utterances: DataFrame) -> DataFrame:
    """Each utterance with its answer; the last one of a conversation has none."""
    return _answered(utterances).drop("_ord")


def dialog_pairs(utterances: DataFrame) -> DataFrame:
    """Consecutive pairs, stripped, both sides non-blank."""
    stripped = consecutive(utterances).withColumns(
        {side: strip_space(F.col(side)) for side in ("input", "target")}
    )
    return stripped.where((F.col("input") != "") & (F.col("target") != ""))


def dialog_pairs_capped(utterances: DataFrame, cap: int = 50_000) -> DataFrame:
    """The first ``cap`` consecutive pairs in order, cleaned; blank sides stay.

    The place of the last of them is found from the places alone, numbered in parallel. Texts
    are then filtered by it where they lie, so no task gathers them.
    """
    if cap < 1:
        raise ValueError("cap must be at least 1")
    answered = _answered(utterances)
    numbered = dense_index(answered.select("_ord"), ["_ord"], "_pair")
    last = numbered.where(F.col("_pair") == cap - 1).first()
    kept = answered if last is None else answered.where(F.col("_ord") <= last["_ord"])
    first = kept.drop("_ord")
    return first.withColumns({side: clean_plain(F.col(side)) for side in ("input", "target")})


def clean_pairs(pairs: DataFrame, clean) -> DataFrame:
    """Both sides cleaned. Passed through a generator, so that a filter on the result does
    not repeat the cleaning."""
    cleaned = F.struct(*[clean(F.col(side)).alias(side) for side in ("input", "target")])
    others = [c for c in pairs.columns if c not in ("input", "target")]
    return pairs.select(*others, F.inline(F.array(cleaned)))


def shorter_than(pairs: DataFrame, max_words: int = 10) -> DataFrame:
    """Pairs with fewer than ``max_words`` words on both sides."""
    words = [F.size(F.split(side, " ")) for side in ("input", "target")]
    return pairs.where((words[0] < max_words) & (words[1] < max_words))


def numbered_pairs(pairs: DataFrame, order: Sequence[str] = ("conv_id", "pos")) -> DataFrame:
    """Pairs with a dense ``pair_id`` in their order; a former ``pair_id`` is replaced."""
    return dense_index(pairs.drop("pair_id"), order, "pair_id")


def sample_pairs(pairs: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` pairs, for a look at them."""
    return pairs.orderBy("conv_id", "pos").limit(n)
