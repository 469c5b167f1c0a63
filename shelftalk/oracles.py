"""The registered queries as SQL over the same tables."""

from __future__ import annotations

from shelftalk.plans import standins as S
from shelftalk.queries import CAP, LEAST, MAX_WORDS, PADDED, POPULAR, SUPPORT, SWEEP, TITLE


def _values(words, column: str) -> str:
    return f"(VALUES {', '.join(f"('{w}')" for w in words)}) v({column})"


def _with(ctes: str, rest: str) -> str:
    """``rest`` is the query, or more common tables (led by a comma) and the query."""
    return f"WITH {ctes}{rest}" if rest.startswith(",") else f"WITH {ctes} {rest}"


# ---------------------------------------------------------------- ratings

_BOOKS = """books AS (
  SELECT s_suppkey AS id, s_suppkey + 100000 AS book_id, n_name AS authors, s_name AS title,
         s_acctbal AS average_rating, CAST(s_nationkey AS BIGINT) AS ratings_count
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

_RATINGS = f"""ratings AS (
  SELECT o_custkey AS user_id, l_suppkey AS book_id, CAST(ceil(l_quantity / 10) AS INTEGER) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
{_BOOKS},
merged AS (
  SELECT * FROM ratings
  UNION ALL
  SELECT {S.USER}, b.id, CAST(1 + s_nationkey % 5 AS INTEGER)
  FROM supplier s JOIN books b ON b.title = 'Supplier#' || lpad(CAST(3 * s_suppkey AS VARCHAR), 9, '0')),
collapsed AS (
  SELECT user_id, book_id, round_even(avg(rating), 0) AS rating FROM merged
  GROUP BY user_id, book_id)"""

_CLEANED = f"""{_RATINGS},
active AS (
  SELECT * FROM collapsed WHERE user_id IN
    (SELECT user_id FROM collapsed GROUP BY user_id HAVING count(*) > 20)),
cleaned AS (
  SELECT * FROM active WHERE book_id IN
    (SELECT book_id FROM active GROUP BY book_id HAVING count(*) >= 30)),
items AS (SELECT title, min(id) AS item_id FROM books GROUP BY title),
by_title AS (
  SELECT user_id, item_id, avg(rating) AS rating
  FROM cleaned c JOIN books b ON c.book_id = b.id JOIN items i ON i.title = b.title
  GROUP BY user_id, item_id)"""

_EDGES = f"""{_CLEANED},
edges AS (
  SELECT a.item_id AS item_a, b.item_id AS item_b, corr(a.rating, b.rating) AS score, count(*) AS n
  FROM by_title a JOIN by_title b ON a.user_id = b.user_id AND a.item_id < b.item_id
  GROUP BY 1, 2 HAVING count(*) >= {SUPPORT} AND NOT isnan(corr(a.rating, b.rating))),
near AS (
  SELECT item_a AS item_id, item_b AS other_id, score, n FROM edges
  UNION ALL SELECT item_b, item_a, score, n FROM edges)"""

_SCORED = f"""{_EDGES},
totals AS (
  SELECT r.user_id, e.other_id AS item_id, sum(e.score * r.rating) AS score
  FROM by_title r JOIN near e ON r.item_id = e.item_id GROUP BY 1, 2),
ranked AS (
  SELECT user_id, item_id, score, row_number() OVER (
    PARTITION BY user_id ORDER BY round(score, 12) DESC, item_id) AS rank
  FROM totals t WHERE NOT EXISTS (
    SELECT 1 FROM by_title r WHERE r.user_id = t.user_id AND r.item_id = t.item_id))"""


def _histogram(key: str) -> str:
    return _with(
        _RATINGS,
        f""", counted AS (SELECT count(*) AS v FROM collapsed GROUP BY {key}),
r AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END::DOUBLE AS lo,
             CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END::DOUBLE AS hi FROM counted),
b AS (SELECT least(CAST(floor((v - lo) * 50 / (hi - lo)) AS BIGINT), 49) AS bin, count(*) AS n
      FROM counted, r GROUP BY 1)
SELECT i AS bin, round(lo + (hi - lo) * i / 50, 6) AS bin_from,
       round(lo + (hi - lo) * (i + 1) / 50, 6) AS bin_to, coalesce(n, 0) AS n
FROM r, range(50) t(i) LEFT JOIN b ON b.bin = i""",
    )


def _profile(name: str, source: str, columns: int, keys: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, count(*) AS n_rows, {columns} AS n_columns, '{k}' AS key,
count(DISTINCT {k}) AS n_distinct, CAST(min({k}) AS BIGINT) AS min_value,
CAST(max({k}) AS BIGINT) AS max_value FROM {source}"""
        for k in keys
    )


# ---------------------------------------------------------------- content

_STOP = ", ".join(f"'{w}'" for w in S.STOP_WORDS)

_TAGS = f"""part_words AS (
  SELECT p_partkey, w AS tag_name, p_partkey * 16 + i - 1 AS pos
  FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w,
               generate_subscripts(string_split(p_name, ' '), 1) AS i FROM part)),
tags AS (
  SELECT row_number() OVER (ORDER BY tag_name) - 1 AS tag_id, tag_name
  FROM (SELECT DISTINCT tag_name FROM part_words)),
genre_tags AS (
  SELECT tag_id, tag_name FROM tags WHERE tag_name IN (SELECT g FROM {_values(S.GENRES, 'g')})),
docs AS (
  SELECT id, title, names || ' ' || lower(replace(replace(p_brand, ' ', ''), ',', ' ')) AS text
  FROM (SELECT p_partkey + 1000000 AS id, p_partkey, string_agg(tag_name, ' ' ORDER BY pos) AS names
        FROM part_words JOIN genre_tags USING (tag_name) GROUP BY p_partkey) t
  JOIN (SELECT p_partkey, p_brand, p_name AS title FROM part) p USING (p_partkey))"""

_DOCUMENTS = "docs AS (SELECT doc_id AS id, text FROM documents)"


def _terms(docs: str) -> str:
    return f"""{docs},
tokens AS (
  SELECT id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
                         lambda x: x NOT IN ({_STOP})) AS ts FROM docs),
words AS (
  SELECT id, unnest(ts) AS w, generate_subscripts(ts, 1) AS i FROM tokens),
grams AS (
  SELECT id, w AS term FROM words
  UNION ALL
  SELECT id, w || ' ' || w2 FROM (
    SELECT id, w, lead(w) OVER (PARTITION BY id ORDER BY i) AS w2 FROM words)
  WHERE w2 IS NOT NULL),
terms AS (SELECT id, term, count(*) AS tf FROM grams GROUP BY id, term),
norms AS (SELECT id, sqrt(sum(tf * tf)) AS norm FROM terms GROUP BY id)"""


def _members(docs: str) -> str:
    return f"""{_terms(docs)},
signed AS (SELECT id, string_agg(term || ':' || tf, chr(10) ORDER BY term) AS s FROM terms GROUP BY id),
members AS (SELECT id, min(id) OVER (PARTITION BY s) AS profile FROM signed)"""


def _cosine(docs: str, least: float = 0.0) -> str:
    return _with(
        _members(docs),
        f""", d AS (SELECT t.* FROM terms t JOIN members m ON t.id = m.id AND m.id = m.profile)
SELECT p.item_a, p.item_b, round(p.dot / (x.norm * y.norm), 6) AS score
FROM (SELECT a.id AS item_a, b.id AS item_b, sum(a.tf * b.tf) AS dot
      FROM d a JOIN d b ON a.term = b.term AND a.id < b.id GROUP BY 1, 2) p
JOIN norms x ON x.id = p.item_a JOIN norms y ON y.id = p.item_b
WHERE p.dot / (x.norm * y.norm) >= {least} - 1e-12""",
    )


def _nearest(docs: str) -> str:
    return _with(
        _terms(docs),
        """, scored AS (
  SELECT p.id, p.other_id, p.dot / (x.norm * y.norm) AS score
  FROM (SELECT a.id, b.id AS other_id, sum(a.tf * b.tf) AS dot
        FROM terms a JOIN terms b ON a.term = b.term AND a.id <> b.id GROUP BY 1, 2) p
  JOIN norms x ON x.id = p.id JOIN norms y ON y.id = p.other_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(score, 12) DESC, other_id) AS rank
  FROM scored)
SELECT id, CAST(rank AS INTEGER) AS rank, other_id, round(score, 6) AS score
FROM ranked WHERE rank <= 9""",
    )


def _similar(docs: str, target: str, title: bool) -> str:
    return _with(
        _terms(docs),
        f""", target AS ({target}),
dots AS (
  SELECT a.id, sum(a.tf * b.tf) AS dot
  FROM terms a JOIN terms b ON a.term = b.term AND b.id = (SELECT id FROM target)
  WHERE a.id <> (SELECT id FROM target) GROUP BY a.id),
scored AS (
  SELECT d.id, dot / (n.norm * m.norm) AS score
  FROM dots d JOIN norms n USING (id), norms m JOIN target t ON m.id = t.id),
best AS (SELECT * FROM scored ORDER BY round(score, 12) DESC, id LIMIT 9)
SELECT id, {'title, ' if title else ''}round(score, 6) AS score
FROM best {'JOIN docs USING (id)' if title else ''}""",
    )


# ---------------------------------------------------------------- dialogs

_SPACE = r"'^\s+|\s+$', '', 'g'"


def _clean_a(c: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(strip_accents(lower({c})), '([.!?])', ' \\1', 'g'),"
        " '[^a-zA-Z.!?]+', ' ', 'g'))"
    )


def _clean_b(c: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(lower({c}), '([?.!,])', ' \\1 ', 'g'),"
        " '[^a-zA-Z?.!,]+', ' ', 'g'))"
    )


_CONSECUTIVE = """said AS (
  SELECT conv_id, turn AS pos, text,
         lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text FROM conversations)"""

_PAIRS = f"""{_CONSECUTIVE},
pairs AS (
  SELECT * FROM (
    SELECT conv_id, pos, regexp_replace(text, {_SPACE}) AS input,
           regexp_replace(next_text, {_SPACE}) AS target
    FROM said WHERE next_text IS NOT NULL)
  WHERE input <> '' AND target <> '')"""

_SHORT = f"""{_PAIRS},
clean_pairs AS (
  SELECT conv_id, pos, {_clean_a('input')} AS input, {_clean_a('target')} AS target FROM pairs),
short AS (
  SELECT * FROM clean_pairs WHERE len(string_split(input, ' ')) < {MAX_WORDS}
                              AND len(string_split(target, ' ')) < {MAX_WORDS})"""

_VOCABULARY = f"""{_SHORT},
sides AS (
  SELECT conv_id, pos, 0 AS side, string_split(input, ' ') AS ws FROM short
  UNION ALL SELECT conv_id, pos, 1, string_split(target, ' ') FROM short),
spoken AS (
  SELECT conv_id, pos, side, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM sides),
placed AS (
  SELECT *, row_number() OVER (ORDER BY conv_id, pos, side, i) AS place FROM spoken),
seen AS (SELECT word, count(*) AS n, min(place) AS place FROM placed GROUP BY word),
vocab AS (SELECT word, row_number() OVER (ORDER BY place) + 2 AS index, n FROM seen)"""


def _trimmed(min_count: int) -> str:
    return f"""{_VOCABULARY},
trimmed AS (
  SELECT word, row_number() OVER (ORDER BY index) + 2 AS index, n FROM vocab WHERE n >= {min_count}),
kept AS (
  SELECT * FROM short p WHERE NOT EXISTS (
    SELECT 1 FROM spoken s WHERE s.conv_id = p.conv_id AND s.pos = p.pos
      AND s.word NOT IN (SELECT word FROM trimmed)))"""


_ENCODED = f"""{_VOCABULARY},
numbered AS (
  SELECT *, row_number() OVER (ORDER BY conv_id, pos) - 1 AS pair_id FROM short),
ids AS (
  SELECT n.pair_id, s.side, list(v.index ORDER BY s.i) || [2] AS ids
  FROM spoken s JOIN vocab v USING (word) JOIN numbered n ON n.conv_id = s.conv_id AND n.pos = s.pos
  GROUP BY 1, 2),
encoded AS (
  SELECT a.pair_id, a.ids AS input_ids, b.ids AS target_ids
  FROM ids a JOIN ids b ON a.pair_id = b.pair_id AND a.side = 0 AND b.side = 1)"""



def _drawn(pool: str) -> str:
    bits = "('0x' || substr(md5('7:' || draw), 1, 16))::UBIGINT"
    return f"""drawn AS (
  SELECT draw, CAST({bits} % (SELECT count(*) FROM {pool}) AS BIGINT) AS pair_id
  FROM range({64 * 400}) t(draw) WHERE EXISTS (FROM {pool}))"""


_DRAWN = f"{_ENCODED},\n{_drawn('numbered')}"

_BATCHES = f"""{_DRAWN},
ordered AS (
  SELECT d.draw // 64 AS batch, e.*, row_number() OVER (
    PARTITION BY d.draw // 64 ORDER BY len(e.input_ids) DESC, d.draw) AS r
  FROM drawn d JOIN encoded e USING (pair_id)),
grouped AS (
  SELECT batch, list(pair_id ORDER BY r) AS pair_ids, list(input_ids ORDER BY r) AS inputs,
         list(target_ids ORDER BY r) AS targets, list(len(input_ids) ORDER BY r) AS lengths,
         max(len(target_ids)) AS max_target_len, max(len(input_ids)) AS max_input_len
  FROM ordered GROUP BY batch)"""


def _time_major(rows: str, length: str, cell: str) -> str:
    return (
        f"array_to_string(list_transform(range(1, {length} + 1), lambda t: "
        f"array_to_string(list_transform({rows}, lambda x: {cell}), ' ')), ';')"
    )


# ---------------------------------------------------------------- pages


def _attribute(tag: str, attribute: str) -> str:
    element = f"(?si)<{tag}\\b[^>]*>.*?</{tag}>"
    pattern = f"(?i)^<{tag}\\b[^>]*?\\s{attribute}\\s*=\\s*[\"'']([^\"''>]*)[\"'']"
    return f"""found AS (
  SELECT page_id, pos - 1 AS pos, element, regexp_extract(element, '{pattern}', 1) AS value
  FROM (SELECT page_id, unnest(es) AS element, generate_subscripts(es, 1) AS pos
        FROM (SELECT page_id, regexp_extract_all(html, '{element}') AS es FROM pages))
  WHERE regexp_matches(element, '{pattern}') AND regexp_replace(element, '<[^>]*>', '', 'g') <> '')"""


_SLUGS = r"""slugs AS (
  SELECT page_id, regexp_extract(url, '^[^/]*/[^/]*/(.*)$', 1) AS tag_name FROM pages
  WHERE regexp_matches(url, '^[^/]*/[^/]*/'))"""


def oracle_sql() -> dict[str, str]:
    score = "round(score, 6) AS score"
    return {
        "own_ratings_merge": _with(_RATINGS, "SELECT * FROM merged"),
        "ratings_duplicates": _with(
            _RATINGS,
            "SELECT user_id, book_id, count(rating) AS n_ratings FROM merged GROUP BY 1, 2",
        ),
        "most_duplicated": _with(
            _RATINGS,
            """SELECT user_id, book_id, count(rating) AS n_ratings FROM merged GROUP BY 1, 2
ORDER BY n_ratings DESC, user_id, book_id LIMIT 10""",
        ),
        "ratings_collapse": _with(_RATINGS, "SELECT * FROM collapsed"),
        "active_users": _with(_CLEANED, "SELECT * FROM active"),
        "popular_items_strict": _with(
            _CLEANED,
            f"""SELECT * FROM active WHERE book_id IN
(SELECT book_id FROM active GROUP BY book_id HAVING count(*) >= {POPULAR})""",
        ),
        "popular_items": _with(_CLEANED, "SELECT book_id, user_id, rating FROM cleaned"),
        "rating_totals": _with(
            _RATINGS,
            "SELECT *, count(*) OVER (PARTITION BY user_id) AS total_ratings FROM collapsed",
        ),
        "top_rated": _with(
            _CLEANED,
            """SELECT book_id, round(avg(rating), 6) AS mean_rating, any_value(authors) AS authors,
any_value(title) AS title FROM (SELECT c.*, b.authors, b.title FROM cleaned c
LEFT JOIN books b ON b.id = c.book_id) GROUP BY book_id ORDER BY avg(rating) DESC, book_id LIMIT 10""",
        ),
        "catalogue_top": _with(
            _BOOKS,
            """SELECT id, authors, title, average_rating, ratings_count FROM books
ORDER BY average_rating DESC, id LIMIT 20""",
        ),
        "profile_tables": _with(
            _RATINGS,
            " UNION ALL ".join(
                [
                    _profile("ratings", "ratings", 3, ("user_id", "book_id")),
                    _profile("books", "books", 6, ("id", "book_id")),
                    _profile("orders", "orders", 6, ("o_orderkey", "o_custkey")),
                    _profile("part", "part", 6, ("p_partkey", "p_size")),
                ]
            ),
        ),
        "below_threshold": _with(
            _RATINGS,
            """SELECT count(*) FILTER (WHERE n <= 20) AS n_true
FROM (SELECT count(*) AS n FROM collapsed GROUP BY user_id)""",
        ),
        "activity_histogram": _histogram("user_id"),
        "book_activity_histogram": _histogram("book_id"),
        "recode_frequency": f"""SELECT CASE o_orderpriority
{' '.join(f"WHEN '{k}' THEN {v}" for k, v in S.PRIORITY_NUMBERS.items())} END AS rating,
count(*) AS n FROM orders GROUP BY 1""",
        "ratings_by_title": _with(
            _CLEANED, "SELECT user_id, item_id, round(rating, 6) AS rating FROM by_title"
        ),
        "item_pearson": _with(_EDGES, f"SELECT item_a, item_b, {score}, n FROM edges"),
        "support_sweep": _with(
            _EDGES,
            f"""SELECT min_support, item_a, item_b, {score}, n FROM edges,
(VALUES {', '.join(f'({s})' for s in SWEEP)}) v(min_support) WHERE n >= min_support""",
        ),
        "similar_items": _with(
            _EDGES,
            f"""SELECT other_id, {score} FROM (SELECT * FROM near
WHERE item_id = (SELECT item_id FROM items ORDER BY title LIMIT 1)
ORDER BY round(score, 12) DESC, other_id LIMIT 10)""",
        ),
        "similar_items_all": _with(
            _EDGES,
            f"""SELECT item_id, CAST(rank AS INTEGER) AS rank, other_id, {score} FROM (
SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 12) DESC, other_id) AS rank
FROM near) WHERE rank <= 10""",
        ),
        "user_ratings": _with(
            _CLEANED, f"SELECT item_id, rating FROM by_title WHERE user_id = {S.USER}"
        ),
        "candidate_scores": _with(
            _EDGES,
            f"""SELECT e.item_id, e.other_id, round(e.score * r.rating, 6) AS score
FROM near e JOIN by_title r ON r.item_id = e.item_id WHERE r.user_id = {S.USER}""",
        ),
        "user_recommendations": _with(
            _SCORED,
            f"""SELECT item_id, title, {score} FROM ranked JOIN items USING (item_id)
WHERE user_id = {S.USER} AND rank <= 10""",
        ),
        "all_user_recommendations": _with(
            _SCORED,
            f"""SELECT user_id, CAST(rank AS INTEGER) AS rank, item_id, title, {score}
FROM ranked JOIN items USING (item_id) WHERE rank <= 10""",
        ),
        "tag_usage": _with(
            _TAGS, "SELECT tag_name, count(*) AS number FROM part_words GROUP BY tag_name"
        ),
        "top_tags": _with(
            _TAGS,
            """SELECT tag_name, count(*) AS number FROM part_words GROUP BY tag_name
ORDER BY number DESC, tag_name LIMIT 10""",
        ),
        "profile_tag_tables": _with(
            f"""{_TAGS},
book_tags AS (
  SELECT p_partkey + 1000000 AS goodreads_book_id, tag_id FROM part_words JOIN tags USING (tag_name))""",
            _profile("tags", "tags", 2, ("tag_id",)) + " UNION ALL "
            + _profile("book_tags", "book_tags", 3, ("goodreads_book_id", "tag_id")),
        ),
        "genre_tags": _with(_TAGS, "SELECT tag_id, tag_name FROM genre_tags"),
        "tag_documents": _with(_TAGS, "SELECT id, title, text FROM docs"),
        "term_counts": _with(_terms(_TAGS), "SELECT id, term, tf FROM terms"),
        "document_term_counts": _with(_terms(_DOCUMENTS), "SELECT id, term, tf FROM terms"),
        "same_terms": _with(_members(_DOCUMENTS), "SELECT id, profile FROM members"),
        "cosine_pairs": _cosine(_TAGS),
        "document_cosine_pairs": _cosine(_DOCUMENTS),
        "cosine_pairs_from": _cosine(_TAGS, LEAST),
        "document_cosine_pairs_from": _cosine(_DOCUMENTS, LEAST),
        "similar_titles": _similar(
            _TAGS, f"SELECT min(id) AS id FROM docs WHERE title = '{TITLE}'", True
        ),
        "similar_documents": _similar(_DOCUMENTS, "SELECT 0 AS id", False),
        "similar_titles_all": _nearest(_TAGS),
        "similar_documents_all": _nearest(_DOCUMENTS),
        "clean_a": f"SELECT doc_id AS id, {_clean_a('text')} AS cleaned FROM documents",
        "clean_b": f"SELECT doc_id AS id, {_clean_b('text')} AS cleaned FROM documents",
        "fold_accents": "SELECT doc_id AS id, strip_accents(lower(text)) AS folded FROM documents",
        "next_utterance": _with(_CONSECUTIVE, "SELECT conv_id, pos, next_text FROM said"),
        "dialog_pairs": _with(_PAIRS, "SELECT conv_id, pos, input, target FROM pairs"),
        "dialog_pairs_first": _with(
            _CONSECUTIVE,
            f"""SELECT conv_id, pos, {_clean_b('text')} AS input, {_clean_b('next_text')} AS target
FROM (SELECT * FROM said WHERE next_text IS NOT NULL ORDER BY conv_id, pos LIMIT {CAP})""",
        ),
        "subword_round_trip": _with(
            _CONSECUTIVE,
            f"""SELECT conv_id, pos, trim(regexp_replace({_clean_b('text')}, ' +', ' ', 'g')) AS input,
trim(regexp_replace({_clean_b('next_text')}, ' +', ' ', 'g')) AS target
FROM (SELECT * FROM said WHERE next_text IS NOT NULL ORDER BY conv_id, pos LIMIT 50000)""",
        ),
        "dialog_pairs_capped": _with(
            _CONSECUTIVE,
            f"""SELECT conv_id, pos, {_clean_b('text')} AS input, {_clean_b('next_text')} AS target
FROM (SELECT * FROM said WHERE next_text IS NOT NULL ORDER BY conv_id, pos LIMIT 50000)""",
        ),
        "pair_length_filter": _with(_SHORT, "SELECT conv_id, pos, input, target FROM short"),
        "vocabulary": _with(_VOCABULARY, "SELECT word, index, n FROM vocab"),
        "vocabulary_trimmed": _with(_trimmed(3), "SELECT word, index, n FROM trimmed"),
        "pairs_in_vocabulary": _with(
            _trimmed(2), "SELECT conv_id, pos, input, target FROM kept"
        ),
        "trim_stats": _with(
            _trimmed(2),
            """SELECT what, kept, total, round(kept / total, 6) AS ratio FROM (
SELECT 'words' AS what, (SELECT count(*) FROM trimmed) AS kept, (SELECT count(*) FROM vocab) AS total
UNION ALL SELECT 'pairs', (SELECT count(*) FROM kept), (SELECT count(*) FROM short))""",
        ),
        "encode_pairs": _with(
            _ENCODED,
            """SELECT pair_id, array_to_string(input_ids, ' ') AS input_ids,
array_to_string(target_ids, ' ') AS target_ids FROM encoded""",
        ),
        "padded_pairs": _with(
            _ENCODED,
            f""", marked AS (
  SELECT pair_id, list_concat([m + 1], input_ids, [m + 2]) AS i, list_concat([m + 1], target_ids, [m + 2]) AS t
  FROM encoded, (SELECT count(*) AS m FROM vocab))
SELECT pair_id, array_to_string(list_resize(i, {PADDED}, 0), ' ') AS input_ids,
array_to_string(list_resize(t, {PADDED}, 0), ' ') AS target_ids FROM marked WHERE len(i) <= {PADDED} AND len(t) <= {PADDED}""",
        ),
        "draw_trimmed_pairs": _with(
            f"{_trimmed(2)},\n{_drawn('kept')}", "SELECT draw, pair_id FROM drawn"
        ),
        "draw_pairs": _with(_DRAWN, "SELECT draw, pair_id FROM drawn"),
        "batches": _with(
            _BATCHES,
            f"""SELECT batch, array_to_string(pair_ids, ' ') AS pair_ids,
{_time_major('inputs', 'max_input_len', 'coalesce(x[t], 0)')} AS inputs,
array_to_string(lengths, ' ') AS lengths,
{_time_major('targets', 'max_target_len', 'coalesce(x[t], 0)')} AS targets,
{_time_major('targets', 'max_target_len', 'CASE WHEN x[t] IS NULL THEN 0 ELSE 1 END')} AS mask,
max_target_len FROM grouped""",
        ),
        "decode_ids": _with(_ENCODED, "SELECT pair_id, input AS text FROM numbered"),
        "sample_pairs": _with(
            _SHORT,
            "SELECT conv_id, pos, input, target FROM clean_pairs ORDER BY conv_id, pos LIMIT 10",
        ),
        "page_links": _with(
            _attribute("a", "href"),
            "SELECT page_id, pos, value AS href FROM found WHERE regexp_matches(value, '/[A-Za-z]')",
        ),
        "page_links_parsed": _with(
            _attribute("a", "href"), "SELECT page_id, pos, value FROM found"
        ),
        "attribute_values": _with(
            _attribute("div", "class"), "SELECT page_id, pos, value FROM found"
        ),
        "page_slugs": _with(
            _SLUGS,
            """SELECT tag_name, min(page_id) AS page_id, 0 AS pos FROM slugs GROUP BY tag_name""",
        ),
        "page_table": "SELECT page_id, url, html FROM pages",
        "page_genres": _with(
            _attribute("a", "href"),
            """SELECT substr(value, 2) AS tag_name, min((page_id, pos))[1] AS page_id,
min((page_id, pos))[2] AS pos FROM found WHERE value LIKE '/%' GROUP BY 1""",
        ),
        "first_char_class": _with(
            _attribute("a", "href"),
            r"""SELECT page_id, pos, w AS word, CASE WHEN regexp_matches(w, '^[\p{Lu}\p{Nd}]')
THEN 'upper or digit' WHEN regexp_matches(w, '^\p{Ll}') THEN 'lower' END AS kind
FROM (SELECT *, substr(value, 2) AS w FROM found) WHERE regexp_matches(value, '/')""",
        ),
        "zip_lists": _with(
            _attribute("a", "href"),
            """SELECT row_number() OVER (ORDER BY page_id, pos) - 1 AS idx, value AS href,
'to ' || value AS label FROM found""",
        ),
        "ratings_of_book_and_value": _with(
            _RATINGS, "SELECT book_id, user_id, rating FROM ratings WHERE book_id = 7 AND rating = 4"
        ),
        "csv_round_trip": _with(_RATINGS, "SELECT book_id, user_id, rating FROM ratings"),
        "csv_index_dropped": """SELECT 'Supplier#' || lpad(CAST(3 * s_suppkey AS VARCHAR), 9, '0') AS title,
CAST(1 + s_nationkey % 5 AS INTEGER) AS rating FROM supplier""",
        "dialog_files": _with(
            _PAIRS,
            r"""SELECT c - 1 AS conv_id, pos,
trim(regexp_replace(input, '\s+', ' ', 'g')) AS input,
trim(regexp_replace(target, '\s+', ' ', 'g')) AS target
FROM pairs JOIN (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS c
                 FROM (SELECT DISTINCT conv_id FROM conversations)) USING (conv_id)""",
        ),
        "pairs_file": _with(
            _PAIRS,
            f"SELECT {_clean_a('input')} AS input, {_clean_a('target')} AS target FROM pairs",
        ),
        "vocabulary_file": _with(_VOCABULARY, "SELECT word, index, n FROM vocab"),
    }
