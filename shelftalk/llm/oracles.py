"""DuckDB twins of the corpus queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op5_phrases": r"""
        WITH texts AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), windows AS (
            SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS h
            FROM texts, unnest(range(1, len(words) - 48)) AS t(i)
        ), firsts AS (
            SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h
        ), gone AS (
            SELECT DISTINCT doc_id, i + j AS pos
            FROM windows JOIN firsts USING (h), range(50) AS r(j)
            WHERE doc_id > first_id
        ), placed AS (
            SELECT doc_id, pos, words[pos] AS word FROM texts, unnest(range(1, len(words) + 1)) AS t(pos)
        ), kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS line
            FROM placed ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
        )
        SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
            sha256(coalesce(line, '')) AS kept_sha256
        FROM texts LEFT JOIN kept USING (doc_id)
    """,
    "op9_suffixes": r"""
        WITH texts AS (
            SELECT doc_id, encode(coalesce(text, '')) AS line FROM documents
        ), windows AS (
            SELECT doc_id, i, md5(line[i + 1:i + 50]) AS h
            FROM texts, unnest(range(octet_length(line) - 49)) AS t(i)
        ), firsts AS (
            SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h
        ), starts AS (
            SELECT doc_id, i FROM windows JOIN firsts USING (h) WHERE doc_id > first_id
        ), islands AS (
            SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span
            FROM (
                SELECT doc_id, i,
                    CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS fresh
                FROM starts
            )
        ), spans AS (
            SELECT doc_id, span, min(i) AS a, max(i) + 50 AS z FROM islands GROUP BY doc_id, span
        ), pieces AS (
            SELECT doc_id, a, hex(line[before + 1:a]) AS piece
            FROM (
                SELECT doc_id, a, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before
                FROM (
                    SELECT doc_id, a, z FROM spans
                    UNION ALL SELECT doc_id, octet_length(line), NULL FROM texts
                )
            ) JOIN texts USING (doc_id)
        ), kept AS (
            SELECT doc_id, string_agg(piece, '' ORDER BY a) AS line FROM pieces GROUP BY doc_id
        ), counted AS (
            SELECT doc_id, count(*) AS n, sum(z - a) AS gone FROM spans GROUP BY doc_id
        )
        SELECT t.doc_id, octet_length(t.line) AS n_bytes,
            CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans,
            sha256(unhex(kept.line)) AS kept_sha256
        FROM texts AS t JOIN kept USING (doc_id) LEFT JOIN counted USING (doc_id)
    """,
}


def _resampling() -> str:
    """Words by crc32, written out byte by byte over the table of the polynomial."""
    return r"""
        WITH RECURSIVE shifted(b, i, c) AS (
            SELECT b, 0, b::BIGINT FROM range(256) AS t(b)
            UNION ALL
            SELECT b, i + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
            FROM shifted WHERE i < 8
        ), poly AS (SELECT list(c ORDER BY b) AS t FROM shifted WHERE i = 8
        ), texts AS (
            SELECT 'd' AS side, row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents
            UNION ALL SELECT 'b', row_number() OVER (), NULL, coalesce(text, '') FROM benchmark
        ), words AS (
            SELECT side, n, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
            FROM texts
        ), counted AS (SELECT side, n, w, count(*) AS f FROM words GROUP BY ALL
        ), hashed AS (
            SELECT w, xor(list_reduce(
                list_transform(range(0, octet_length(encode(w))),
                    lambda i: ('0x' || hex(encode(w))[2 * i + 1:2 * i + 2])::BIGINT),
                lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8), 4294967295), 4294967295) % 10000 AS bucket
            FROM (SELECT DISTINCT w FROM counted), poly
        ), shares AS (
            SELECT bucket, sum(f) FILTER (side = 'd') AS s, sum(f) FILTER (side = 'b') AS t
            FROM counted JOIN hashed USING (w) GROUP BY bucket
        ), totals AS (SELECT coalesce(sum(s), 0)::DOUBLE AS all_s, coalesce(sum(t), 0)::DOUBLE AS all_t FROM shares
        ), gains AS (
            SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (all_s + 10000)
                / ((coalesce(s, 0)::DOUBLE + 1) * (all_t + 10000))))::BIGINT AS gain
            FROM shares, totals
        ), weights AS (
            SELECT n, sum(f)::BIGINT AS n_features, sum(f * gain)::BIGINT AS weight
            FROM counted JOIN hashed USING (w) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY n
        ), scored AS (
            SELECT n, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + floor(-1000 * ln(-ln(
                    (('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
            FROM texts LEFT JOIN weights USING (n) WHERE side = 'd'
        ), placed AS (
            SELECT n, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS able
            FROM scored WHERE n_features >= 20
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= able * 10 // 100 THEN rank END AS rank
        FROM scored LEFT JOIN placed USING (n)
    """


def _centroids(k: int = 40, rounds: int = 5, size: int = 64) -> str:
    """The rounds one after another; a vector is a list of integers."""
    found = "list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)"
    ctes = [
        f"""vectors AS MATERIALIZED (
            SELECT row_number() OVER () AS n, vec_id, {found} AS v FROM embeddings
            WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}
        )""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster, v AS c
            FROM vectors ORDER BY cluster LIMIT {k}
        )""",
    ]
    for i in range(rounds + 1):
        ctes.append(
            f"""a{i} AS MATERIALIZED (
            SELECT n, min(distance) AS distance, arg_min(cluster, (distance, cluster)) AS cluster
            FROM (
                SELECT n, cluster, list_sum(list_transform(list_zip(v, c),
                    lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
                FROM vectors, c{i}
            ) GROUP BY n
        )"""
        )
        if i < rounds:
            ctes.append(
                f"""m{i} AS (
            SELECT cluster, list(m ORDER BY j) AS c FROM (
                SELECT cluster, j, ((sum(v[j]) - ((sum(v[j]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
                FROM a{i} JOIN vectors USING (n), range(1, {size + 1}) AS r(j) GROUP BY cluster, j
            ) GROUP BY cluster
        ), c{i + 1} AS MATERIALIZED (
            SELECT c{i}.cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster)
        )"""
            )
    return f"""
        WITH {", ".join(ctes)}
        SELECT vec_id, cluster::INTEGER AS cluster, distance,
            (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
            (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a{rounds} JOIN vectors USING (n) JOIN c{rounds} USING (cluster)
    """


ORACLES["op11_resampling"] = _resampling()
ORACLES["op12_centroids"] = _centroids()
ORACLES["op13_embeddings"] = r"""
    WITH RECURSIVE rows AS MATERIALIZED (
        SELECT row_number() OVER () AS n, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v,
            label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
            AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding) AS able
        FROM embeddings
    ), links AS MATERIALIZED (
        SELECT a.n AS a, b.n AS b
        FROM (SELECT * FROM rows WHERE able) AS a JOIN (SELECT * FROM rows WHERE able) AS b
            ON a.label = b.label AND len(a.v) = len(b.v) AND a.n <> b.n
        WHERE list_cosine_similarity(a.v, b.v) >= 0.98
    ), reached(n, vec_id) AS (
        SELECT n, vec_id FROM rows UNION SELECT l.b, r.vec_id FROM reached AS r JOIN links AS l ON l.a = r.n
    ), least AS (SELECT n, min(vec_id) AS component_id FROM reached GROUP BY n
    ), counted AS (SELECT a AS n, count(*) AS n_links FROM links GROUP BY a)
    SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id,
        vec_id IS NOT DISTINCT FROM component_id AS kept
    FROM rows JOIN least USING (n) LEFT JOIN counted USING (n)
"""
