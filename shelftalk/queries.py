"""Every operator as a query over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftalk.functions import text as X
from shelftalk.operators import batches as B
from shelftalk.operators import collab, content, dialog, subwords, tables, web
from shelftalk.operators import ratings as R
from shelftalk.operators import vocabulary as V
from shelftalk.operators.ordering import with_next
from shelftalk.plans import dialogs, pages as page_plans, recommend, standins as S
from shelftalk.sources import files
from shelftalk.sources.scratch import materialize, new_path

Query = Callable[[SparkSession, str], DataFrame]

SUPPORT = 20
SWEEP = (200, 160, 25, 20)
MAX_WORDS = 60
TITLE = "red widget"
LEAST = 0.3  # minimum cosine of a pair
POPULAR = 460
CAP = 20
PADDED = 40  # ids of a padded sequence, its marks included
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _rounded(c: str | Column, name: str | None = None) -> Column:
    return F.round(c, 6).alias(name or str(c))


def _joined(ids: Column) -> Column:
    return F.array_join(F.transform(ids, lambda i: i.cast("string")), " ")


# ---------------------------------------------------------------- ratings


@query
def own_ratings_merge(spark, d):
    return R.merge_own(S.ratings(spark, d), S.own(spark, d), S.books(spark, d), S.USER)


@query
def ratings_duplicates(spark, d):
    return R.duplicate_report(own_ratings_merge(spark, d))


@query
def most_duplicated(spark, d):
    counted = ratings_duplicates(spark, d)
    return counted.orderBy(F.desc("n_ratings"), "user_id", "book_id").limit(10)


@query
def ratings_collapse(spark, d):
    return R.collapse(own_ratings_merge(spark, d))


def _active(spark, d):
    return R.keep_active(materialize(ratings_collapse(spark, d)))


def _cleaned(spark, d):
    return recommend.clean_ratings(S.ratings(spark, d), S.books(spark, d), S.own(spark, d), S.USER)


def _title_ratings(spark, d):
    return recommend.TitleRatings.build(_cleaned(spark, d), S.books(spark, d))


def _model(spark, d, support: int = SUPPORT):
    return recommend.ItemModel.build(_cleaned(spark, d), S.books(spark, d), support)


@query
def active_users(spark, d):
    return _active(spark, d)


@query
def popular_items(spark, d):
    return _cleaned(spark, d)


@query
def popular_items_strict(spark, d):
    return R.keep_popular(materialize(_active(spark, d)), POPULAR)


@query
def rating_totals(spark, d):
    return R.with_totals(materialize(ratings_collapse(spark, d)), "user_id", "total_ratings")


@query
def top_rated(spark, d):
    best = R.top_rated(_cleaned(spark, d), S.books(spark, d))
    return best.withColumn("mean_rating", F.round("mean_rating", 6))


@query
def catalogue_top(spark, d):
    return R.catalogue_top(S.books(spark, d))


@query
def profile_tables(spark, d):
    return tables.profiles(
        [
            ("ratings", S.ratings(spark, d), ["user_id", "book_id"]),
            ("books", S.books(spark, d), ["id", "book_id"]),
            ("orders", S.table(spark, d, "orders"), ["o_orderkey", "o_custkey"]),
            ("part", S.table(spark, d, "part"), ["p_partkey", "p_size"]),
        ]
    )


@query
def below_threshold(spark, d):
    counted = R.ratings_per(ratings_collapse(spark, d), "user_id", "total_ratings")
    return tables.count_true(counted, F.col("total_ratings") <= 20)


def _histogram(counted: DataFrame, value: str) -> DataFrame:
    return tables.histogram(counted, value).select(
        "bin", _rounded("bin_from"), _rounded("bin_to"), "n"
    )


@query
def activity_histogram(spark, d):
    return _histogram(
        R.ratings_per(ratings_collapse(spark, d), "user_id", "total_ratings"), "total_ratings"
    )


@query
def book_activity_histogram(spark, d):
    return _histogram(
        R.ratings_per(ratings_collapse(spark, d), "book_id", "received_ratings"),
        "received_ratings",
    )


@query
def recode_frequency(spark, d):
    orders = S.table(spark, d, "orders").select(
        X.recode(F.col("o_orderpriority"), S.PRIORITY_NUMBERS).alias("rating")
    )
    return tables.frequency(orders, "rating")


# ---------------------------------------------------------------- collaborative filtering


@query
def ratings_by_title(spark, d):
    found = collab.ratings_by_title(_cleaned(spark, d), S.books(spark, d))
    return found.select("user_id", "item_id", _rounded("rating"))


@query
def item_pearson(spark, d):
    return _model(spark, d).edges.select("item_a", "item_b", _rounded("score"), "n")


@query
def support_sweep(spark, d):
    swept = collab.support_sweep(_model(spark, d).edges, SWEEP)
    return swept.select("min_support", "item_a", "item_b", _rounded("score"), "n")


@query
def similar_items(spark, d):
    known = _title_ratings(spark, d)
    first = known.titles.select(F.min("title")).scalar()
    return known.similar(first, min_support=SUPPORT).select("other_id", _rounded("score"))


@query
def similar_items_all(spark, d):
    near = collab.similar_items_all(_model(spark, d).edges)
    return near.select("item_id", "rank", "other_id", _rounded("score"))


@query
def user_ratings(spark, d):
    by_title = collab.ratings_by_title(_cleaned(spark, d), S.books(spark, d))
    return collab.user_ratings(by_title, S.USER)


@query
def candidate_scores(spark, d):
    found = _title_ratings(spark, d).candidates(S.USER, SUPPORT)
    return found.select("item_id", "other_id", _rounded("score"))


@query
def user_recommendations(spark, d):
    best = _title_ratings(spark, d).recommend(S.USER, min_support=SUPPORT)
    return best.withColumn("score", F.round("score", 6))


@query
def all_user_recommendations(spark, d):
    return _model(spark, d).recommend_all().withColumn("score", F.round("score", 6))


# ---------------------------------------------------------------- tags and content


def _tags(spark, d):
    tag_table = S.tags(spark, d)
    return tag_table, S.book_tags(spark, d, tag_table)


def _tag_texts(spark, d):
    tag_table, book_tags = _tags(spark, d)
    return recommend.tag_texts(book_tags, tag_table, S.genres(spark), S.part_books(spark, d))


@query
def tag_usage(spark, d):
    tag_table, book_tags = _tags(spark, d)
    return content.tag_usage(book_tags, tag_table)


@query
def top_tags(spark, d):
    return tables.top(tag_usage(spark, d), "number", 10, "tag_name")


@query
def profile_tag_tables(spark, d):
    tag_table, book_tags = _tags(spark, d)
    return tables.profiles(
        [
            ("tags", tag_table, ["tag_id"]),
            ("book_tags", book_tags, ["goodreads_book_id", "tag_id"]),
        ]
    )


@query
def genre_tags(spark, d):
    return content.genre_tags(S.tags(spark, d), S.genres(spark)).select("tag_id", "tag_name")


@query
def tag_documents(spark, d):
    return _tag_texts(spark, d)


@query
def term_counts(spark, d):
    return content.term_counts(_tag_texts(spark, d).select("id", "text"), S.STOP_WORDS)


@query
def document_term_counts(spark, d):
    return content.term_counts(S.documents(spark, d), S.STOP_WORDS)


@query
def same_terms(spark, d):
    return content.same_terms(S.documents(spark, d), S.STOP_WORDS)


def _cosine(docs):
    members = materialize(content.same_terms(docs, S.STOP_WORDS))
    edges = content.cosine_pairs(docs, members, S.STOP_WORDS)
    return edges.select("item_a", "item_b", _rounded("score"))


@query
def cosine_pairs(spark, d):
    return _cosine(_tag_texts(spark, d).select("id", "text"))


@query
def document_cosine_pairs(spark, d):
    return _cosine(S.documents(spark, d))





def _cosine_from(docs):
    members = materialize(content.same_terms(docs, S.STOP_WORDS))
    edges = content.cosine_pairs(docs, members, S.STOP_WORDS, least=LEAST)
    return edges.select("item_a", "item_b", _rounded("score"))


@query
def cosine_pairs_from(spark, d):
    return _cosine_from(_tag_texts(spark, d).select("id", "text"))


@query
def document_cosine_pairs_from(spark, d):
    return _cosine_from(S.documents(spark, d))


@query
def similar_titles(spark, d):
    found = recommend.titles_like(_tag_texts(spark, d), TITLE, stop_words=S.STOP_WORDS)
    return found.select("id", "title", _rounded("score"))


@query
def similar_documents(spark, d):
    docs = S.documents(spark, d)
    return content.similar_documents(docs, 0, 9, S.STOP_WORDS).select("id", _rounded("score"))


def _nearest(docs):
    near = content.similar_documents_all(docs, 9, S.STOP_WORDS)
    return near.select("id", "rank", "other_id", _rounded("score"))


@query
def similar_titles_all(spark, d):
    return _nearest(_tag_texts(spark, d).select("id", "text"))


@query
def similar_documents_all(spark, d):
    return _nearest(S.documents(spark, d))


# ---------------------------------------------------------------- text and dialogs


@query
def clean_a(spark, d):
    return S.documents(spark, d).select("id", X.clean_folded(F.col("text")).alias("cleaned"))


@query
def clean_b(spark, d):
    return S.documents(spark, d).select("id", X.clean_plain(F.col("text")).alias("cleaned"))


@query
def fold_accents(spark, d):
    return S.documents(spark, d).select("id", X.fold_marks(F.lower("text")).alias("folded"))


@query
def next_utterance(spark, d):
    said = with_next(S.utterances(spark, d), ["conv_id"], ["pos"], {"next_text": "text"})
    return said.select("conv_id", "pos", "next_text")


@query
def dialog_pairs(spark, d):
    return dialog.dialog_pairs(S.utterances(spark, d))


@query
def dialog_pairs_capped(spark, d):
    return dialog.dialog_pairs_capped(S.utterances(spark, d))


@query
def dialog_pairs_first(spark, d):
    return dialog.dialog_pairs_capped(S.utterances(spark, d), CAP)


def _cleaned_pairs(spark, d):
    return dialog.clean_pairs(dialog.dialog_pairs(S.utterances(spark, d)), X.clean_folded)


def _short_pairs(spark, d):
    return dialog.numbered_pairs(
        materialize(dialog.shorter_than(_cleaned_pairs(spark, d), MAX_WORDS))
    )


@query
def pair_length_filter(spark, d):
    return dialog.shorter_than(_cleaned_pairs(spark, d), MAX_WORDS)


@query
def vocabulary(spark, d):
    return V.vocabulary(_short_pairs(spark, d))


@query
def vocabulary_trimmed(spark, d):
    return V.trim(vocabulary(spark, d))


@query
def pairs_in_vocabulary(spark, d):
    short = _short_pairs(spark, d)
    return V.pairs_in_vocabulary(short, V.trim(V.vocabulary(short), 2)).drop("pair_id")


@query
def trim_stats(spark, d):
    short = _short_pairs(spark, d)
    words = V.vocabulary(short)
    trimmed = V.trim(words, 2)
    kept = V.pairs_in_vocabulary(short, trimmed)
    return V.trim_statistics(words, trimmed, short, kept).withColumn("ratio", F.round("ratio", 6))


def _prepared(spark, d, min_count: int = 1):
    return dialogs.prepare(S.utterances(spark, d), MAX_WORDS, min_count)


@query
def encode_pairs(spark, d):
    ready = _prepared(spark, d)
    return B.encode_pairs(ready.pairs, ready.vocabulary).select(
        "pair_id",
        _joined(F.col("input_ids")).alias("input_ids"),
        _joined(F.col("target_ids")).alias("target_ids"),
    )


@query
def draw_pairs(spark, d):
    return B.draws(_prepared(spark, d).pairs, 64 * 400, seed=7)


@query
def batches(spark, d):
    made = _prepared(spark, d).batches(400, 64, seed=7)

    def matrix(c: str) -> Column:
        return F.array_join(F.transform(c, _joined), ";")

    return made.select(
        "batch",
        _joined(F.col("pair_ids")).alias("pair_ids"),
        matrix("inputs").alias("inputs"),
        _joined(F.col("lengths")).alias("lengths"),
        matrix("targets").alias("targets"),
        matrix("mask").alias("mask"),
        F.col("max_target_len").cast("long").alias("max_target_len"),
    )


@query
def draw_trimmed_pairs(spark, d):
    return B.draws(_prepared(spark, d, 2).pairs, 64 * 400, seed=7)


@query
def decode_ids(spark, d):
    ready = _prepared(spark, d)
    encoded = B.encode_pairs(ready.pairs, ready.vocabulary)
    return B.decode(encoded, ready.vocabulary, "pair_id", "input_ids")


@query
def padded_pairs(spark, d):
    ready = _prepared(spark, d)
    encoded = B.encode_pairs(ready.pairs, ready.vocabulary)
    made = subwords.padded(encoded, ready.vocabulary.count(), max_length=PADDED)
    return made.select(
        "pair_id",
        _joined(F.col("input_ids")).alias("input_ids"),
        _joined(F.col("target_ids")).alias("target_ids"),
    )


def _corpus(pairs: DataFrame) -> DataFrame:
    return pairs.selectExpr("input AS text").unionAll(pairs.selectExpr("target AS text"))


@query
def subword_vocabulary(spark, d):
    pairs = materialize(dialog.dialog_pairs_capped(S.utterances(spark, d)))
    return subwords.build_subwords(_corpus(pairs))


@query
def subword_encode(spark, d):
    _, encoded = dialogs.prepare_subwords(S.utterances(spark, d))
    return encoded.select(
        "conv_id", "pos",
        _joined(F.col("input_ids")).alias("input_ids"),
        _joined(F.col("target_ids")).alias("target_ids"),
    )


@query
def subword_round_trip(spark, d):
    pairs = materialize(dialog.dialog_pairs_capped(S.utterances(spark, d)))
    pieces = subwords.build_subwords(_corpus(pairs))
    encode = subwords.subword_encoder(pieces)
    sides = ("input", "target")
    ids = materialize(
        pairs.select(F.struct("conv_id", "pos").alias("place"), *[encode(F.col(s)).alias(s) for s in sides])
    )
    texts = [
        subwords.decode_subwords(ids, pieces, "place", s).withColumnRenamed("text", s) for s in sides
    ]
    return texts[0].join(texts[1], "place").select("place.*", "input", "target")


@query
def sample_pairs(spark, d):
    return dialog.sample_pairs(_cleaned_pairs(spark, d))


# ---------------------------------------------------------------- pages


@query
def page_links(spark, d):
    return web.links(S.pages(spark, d), "/[A-Za-z]")


@query
def page_links_parsed(spark, d):
    return web.attribute_values_parsed(S.pages(spark, d), "a", "href")


@query
def attribute_values(spark, d):
    return web.attribute_values(S.pages(spark, d), "div", "class")


@query
def page_slugs(spark, d):
    urls = S.pages(spark, d).select("page_id", F.lit(0).alias("pos"), F.col("url").alias("href"))
    return web.distinct_slugs(urls)


@query
def page_table(spark, d):
    path = new_path(spark)
    S.pages(spark, d).write.parquet(path)
    return files.read_pages(spark, path)


@query
def page_genres(spark, d):
    return page_plans.genres(S.genre_pages(spark, d))


@query
def first_char_class(spark, d):
    words = web.links(S.pages(spark, d), "/").select(
        "page_id", "pos", F.expr("substring(href, 2)").alias("word")
    )
    named = F.when(X.starts_upper_or_digit(F.col("word")), "upper or digit").when(
        X.starts_lower(F.col("word")), "lower"
    )
    return words.withColumn("kind", named)


@query
def zip_lists(spark, d):
    found = web.attribute_values(S.pages(spark, d), "a", "href")
    labels = found.withColumn("value", F.concat(F.lit("to "), F.col("value")))
    return web.zip_lists(found, labels, ("href", "label"))


# ---------------------------------------------------------------- files


@query
def ratings_of_book_and_value(spark, d):
    both = (F.col("book_id") == 7) & (F.col("rating") == 4)
    return S.ratings(spark, d).where(both).select("book_id", "user_id", "rating")


@query
def csv_round_trip(spark, d):
    path = new_path(spark)
    files.write_table(S.ratings(spark, d).select("book_id", "user_id", "rating"), path)
    return files.read_table(spark, path, files.RATINGS)


@query
def csv_index_dropped(spark, d):
    path = new_path(spark)
    indexed = S.own(spark, d).select(F.lit(0).alias("_c0"), "title", "rating")
    files.write_table(indexed, path)
    return files.read_table(spark, path, files.OWN_RATINGS, drop_index=True)


@query
def dialog_files(spark, d):
    said = S.utterances(spark, d)
    line_id = F.concat(F.lit("L"), F.col("conv_id"), F.lit("_"), F.col("pos"))
    lines = said.select(
        line_id.alias("lineID"), F.lit("u0"), F.lit("m0"), F.lit("X"), X.collapse_space(F.col("text"))
    )
    ids = F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "conv_id"))),
        lambda e: F.concat(F.lit("'L"), e["conv_id"], F.lit("_"), e["pos"], F.lit("'")),
    )
    conversations = said.groupBy("conv_id").agg(ids.alias("ids")).repartitionByRange(
        "conv_id"
    ).sortWithinPartitions("conv_id").select(
        F.lit("u0"), F.lit("u1"), F.lit("m0"),
        F.concat(F.lit("["), F.array_join("ids", ", "), F.lit("]")),
    )
    lines_path, conversations_path = new_path(spark), new_path(spark)
    files.write_fields(lines, lines_path)
    files.write_fields(conversations, conversations_path)
    return dialog.dialog_pairs(dialogs.utterances(spark, lines_path, conversations_path))


@query
def pairs_file(spark, d):
    path = new_path(spark)
    pairs = dialog.dialog_pairs(S.utterances(spark, d))
    files.write_pairs(dialog.clean_pairs(pairs, X.collapse_space), path)
    return dialog.clean_pairs(
        files.read_pairs(spark, path).select("input", "target"), X.clean_folded
    )


@query
def vocabulary_file(spark, d):
    path = new_path(spark)
    files.write_vocabulary(vocabulary(spark, d), path)
    return files.read_vocabulary(spark, path)
