"""Delimited tables, dialog files and pair files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Separator and field names of the dialog files.
FIELD_SEPARATOR = " +++$+++ "
LINE_FIELDS = ("lineID", "characterID", "movieID", "character", "text")
CONVERSATION_FIELDS = ("character1ID", "character2ID", "movieID", "utteranceIDs")

# The columns used of the book tables.
RATINGS = "book_id long, user_id long, rating int"
TAGS = "tag_id long, tag_name string"
TO_READ = "user_id long, book_id long"
GENRES = "_c0 long, tag_name string"
OWN_RATINGS = "_c0 long, title string, rating int"

_PLACE = ("_file", "_block", "_at")
_RECORD = "_record"  # text of a record whose number of fields differs


def read_table(spark: SparkSession, path: str, schema: str, drop_index: bool = False) -> DataFrame:
    """CSV with a header and doubled quotes; the unnamed row-number column can be dropped."""
    df = spark.read.schema(schema).csv(path, header=True, quote='"', escape='"')
    return df.drop("_c0") if drop_index else df


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.csv(path, header=True, quote='"', escape='"', mode=mode)


def with_place(df: DataFrame) -> DataFrame:
    """File, block and row position, which order the rows of a scan as in its files."""
    return df.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_at": F.monotonically_increasing_id(),
        }
    )


def read_fields(
    spark: SparkSession, path: str, fields: Sequence[str], encoding: str = "ISO-8859-1"
) -> DataFrame:
    """Lines split at the dialog separator, fields named by position, with row places.

    A record with fewer fields is an error; fields beyond the named ones are left out, and so
    are empty lines.
    """
    schema = T.StructType([T.StructField(f, T.StringType()) for f in (*fields, _RECORD)])
    # Without column pruning, so that fields are counted however few are selected.
    raw = spark.read.schema(schema).option("columnPruning", False).csv(
        path, sep=FIELD_SEPARATOR, encoding=encoding, quote="", escape="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        columnNameOfCorruptRecord=_RECORD,
    )
    n_fields = F.size(F.split(_RECORD, re.escape(FIELD_SEPARATOR)))
    short = F.raise_error(F.concat(F.lit("record with too few fields: "), _RECORD)).cast("string")
    whole = {
        f: F.when(n_fields < len(fields), short).otherwise(F.coalesce(f, F.lit("")))
        for f in fields
    }
    return with_place(raw).withColumns(whole).drop(_RECORD)


def read_lines(
    spark: SparkSession, path: str, keep: Sequence[str] = LINE_FIELDS, encoding="ISO-8859-1"
) -> DataFrame:
    """Line records keyed by ``lineID``; of repeated ids the last line in the file stays.

    Bytes that are not valid in ``encoding`` are left out of the text.
    """
    rows = read_fields(spark, path, LINE_FIELDS, encoding)
    values = F.struct(*[c for c in keep if c != "lineID"])
    last = rows.groupBy("lineID").agg(F.max_by(values, F.struct(*_PLACE)).alias("_last"))
    df = last.select("lineID", "_last.*")
    return df.withColumn("text", F.replace(F.col("text"), F.lit("�"), F.lit("")))


def read_conversations(
    spark: SparkSession, path: str, encoding: str = "ISO-8859-1"
) -> DataFrame:
    """Conversation records with their row places; the id list is still text."""
    return read_fields(spark, path, CONVERSATION_FIELDS, encoding)


def write_fields(df: DataFrame, path: str, encoding: str = "ISO-8859-1") -> None:
    """Write columns in the dialog format."""
    line = F.concat_ws(FIELD_SEPARATOR, *df.columns)
    df.select(line.alias("value")).write.option("encoding", encoding).csv(
        path, quote="", escape="", sep="\x01", ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_pairs(pairs: DataFrame, path: str) -> None:
    """Sentence pairs as tab-separated UTF-8 with CSV quoting."""
    pairs.select("input", "target").write.csv(path, sep="\t", quote='"', escape='"')


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Pairs split at line ends and tabs only; quotes stay in the text. With row places."""
    raw = spark.read.schema("input string, target string").csv(
        path, sep="\t", quote="", escape="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return with_place(raw).fillna("", ["input", "target"])


def preview(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    return spark.read.text(path).limit(n)


def write_vocabulary(vocabulary: DataFrame, path: str, mode: str = "errorifexists") -> None:
    vocabulary.write.parquet(path, mode=mode)


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("word string, index long, n long").parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("page_id long, url string, html string").parquet(path)
