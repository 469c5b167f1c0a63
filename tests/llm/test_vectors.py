"""Resampling, centroids and embedding near-dedup against brute force, awkward rows included."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from shelftalk.llm import centroids, embeddings, resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
rng = random.Random(11)

# ---------------------------------------------------------------- resampling

DOCS = "doc_id long, text string, lang string, score long, _place long, rank int"


def prose(n, words=("Alpha", "beta", "GAMMA", "İd", "zwölf", "x9", "k")):
    return "".join(rng.choice(words) + str(rng.randint(0, 30)) + rng.choice([" ", ", ", "\n", "_"]) for _ in range(n))


def document_rows():
    texts = [prose(rng.randint(1, 60)) for _ in range(300)]
    texts += [None, "", " \t!", "one two", "a" * 5000, prose(40_000), "Ünï " * 30]
    made = [(i * 7 - 50, t) for i, t in enumerate(texts)]
    made += [made[4]] * 130 + [(made[5][0], prose(30)), (None, prose(35)), (None, prose(35)), (None, None)]
    rng.shuffle(made)
    return [(i, t, "en", 5, 6, 7) for i, t in made]


def plain_resample(rows, target, percent, longest, buckets, least):
    def runs(text):
        w = WORD.findall((text or "").translate(LOWER))
        grams = [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(g.encode()) % buckets for g in grams]

    found = [runs(r[1]) for r in rows]
    s, t = Counter(), Counter()
    for _, f in found:
        s.update(f)
    for text in target:
        t.update(runs(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1.0) * (s_all + float(buckets)) / ((s[b] + 1.0) * (t_all + float(buckets)))))
        for b in range(buckets)
    ]
    out = []
    for (i, *_), (n, f) in zip(rows, found):
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        luck = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + luck, n])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {}
    for at, r in enumerate(able[: len(able) * percent // 100], 1):
        ranks.setdefault(tuple(r[:4]), []).append(at)
    return sorted(
        ((*r[:4], ranks[tuple(r[:4])].pop() if r[4] >= least and ranks.get(tuple(r[:4])) else None) for r in out), key=repr
    )


@pytest.mark.parametrize(
    "percent, longest, buckets, least, pivots", [(10, 1, 10_000, 20, 24), (37, 2, 97, 1, 1), (100, 1, 50, 0, 3), (45, 3, 500, 20, 2)]
)
def test_resample(spark, percent, longest, buckets, least, pivots):
    rows = document_rows()
    target = [prose(50, ("beta", "k", "new")) for _ in range(20)] + [None, ""]
    got = resampling.resample(
        spark.createDataFrame(rows, DOCS).repartition(5),
        spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int"),
        percent=percent, longest=longest, buckets=buckets, least_words=least, pivots=pivots,
    )
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_resample(rows, target, percent, longest, buckets, least)


def test_resample_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    some = spark.createDataFrame(document_rows(), DOCS)
    assert resampling.resample(empty, some).collect() == []
    got = resampling.resample(some, empty).collect()  # no target: smoothed shares alone
    assert sum(r.rank is not None for r in got) == sum(len(WORD.findall(r[1] or "")) >= 20 for r in document_rows()) * 10 // 100
    assert {r.rank for r in resampling.resample(some, some, least_words=10**9).collect()} == {None}


def test_kth_key_of_equal_scores(spark):
    """A third and more of the rows share score and id: only the place tells them apart."""
    rows = [(7, 100, True, i) for i in range(500)] + [(i, i, True, 1000 + i) for i in range(200)]
    made = spark.createDataFrame([(a, not b, c, d) for c, b, a, d in [(r[0], r[2], r[1], r[3]) for r in rows]], "x long, _no_id boolean, _id long, _place long")
    keyed = made.select((-made.x).alias("_neg"), "_no_id", "_id", "_place")
    order = sorted(tuple(r) for r in keyed.collect())
    for k in (1, 2, 350, 699, 700):
        assert resampling.kth_key(keyed, k, pivots=4) == order[k - 1]
    with pytest.raises(ValueError):
        resampling.kth_key(keyed, 701, pivots=4)


def test_drawn_documents(spark):
    rows = [(i, prose(25), "en", 1, 2, 3) for i in range(100)]
    df = spark.createDataFrame(rows, DOCS)
    drawn = resampling.drawn_documents(df, df.limit(3), percent=20)
    assert drawn.columns == df.columns and drawn.count() == 20


# ---------------------------------------------------------------- centroids

VECTORS = "vec_id long, embedding array<float>, label int, cluster string, node int, own int, vector int"


def vector_rows(width, n=400, groups=8, spread=0.03):
    r = np.random.default_rng(5)
    middles = r.standard_normal((groups, width))
    made = []
    for i in range(n):
        v = middles[i % groups] + spread * r.standard_normal(width)
        made.append((i * 3 - 40, v.astype(np.float32).tolist(), i % 3))
    copy = made[10][1]
    made += [(10_000 + i, copy, 1) for i in range(200)] + [made[3], made[3], (made[8][0], made[9][1], 0)]
    made += [(1, None, 1), (2, [], 1), (4, [0.0] * width, 1), (6, [1.0] * (width - 1), 1), (7, [1.0] * (width + 1), 1)]
    made += [(9, [float("nan")] + [1.0] * (width - 1), 1), (12, [float("inf")] + [1.0] * (width - 1), 1)]
    made += [(13, [None] + [1.0] * (width - 1), 1), (None, made[20][1], 2), (None, made[21][1], None), (16, made[22][1], None)]
    made += [(15, [2.0 * x for x in made[10][1]], made[10][2]), (18, [-x for x in made[10][1]], made[10][2])]
    return [(i, e, l, "c", 1, 2, 3) for i, e, l in made]


def plain_clusters(rows, k, rounds, width):
    kept = [
        (i, [math.floor(256 * x) for x in e]) for i, e, *_ in rows
        if e is not None and len(e) == width and all(x is not None and math.isfinite(x) for x in e)
    ]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    middles = [v for _, v in order[:k]]

    def assigned():
        out = []
        for _, v in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middles)))
        return out

    for _ in range(rounds):
        of = assigned()
        for c in range(len(middles)):
            members = [v for (_, v), (_, d) in zip(kept, of) if d == c]
            if members:
                middles[c] = [sum(x) // len(members) for x in zip(*members)]
    of, each = assigned(), Counter()
    for d, c in of:
        each[c] += d
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middles]
    return sorted(((i, c, d, each[c], sum(each.values()), digest[c]) for (i, _), (d, c) in zip(kept, of)), key=repr)


@pytest.mark.parametrize("k, rounds, pivots", [(12, 3, 5), (1, 2, 5), (40, 5, 2), (900, 1, 1)])
def test_clusters(spark, k, rounds, pivots):
    rows = vector_rows(16)
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    got = centroids.cluster(df, k=k, rounds=rounds, size=16, pivots=pivots)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_clusters(rows, k, rounds, 16)


def test_clusters_of_nothing(spark):
    rows = [(1, None, 1, "c", 1, 2, 3), (2, [1.0], 1, "c", 1, 2, 3)]
    for made in ([], rows):
        got = centroids.cluster(spark.createDataFrame(made, VECTORS))
        assert got.collect() == [] and got.columns[-1] == "centroid_sha256"


def test_components_too_large(spark):
    df = spark.createDataFrame([(1, [1e30] * 4, 1, "c", 1, 2, 3)], VECTORS)
    with pytest.raises(Exception, match="a component times"):
        centroids.cluster(df, size=4).collect()


def test_bounds_hold_and_prune():
    r = np.random.default_rng(3)
    middles = r.integers(-4000, 4000, (30, 16))
    rows = np.concatenate([middles + r.integers(-3, 4, middles.shape) for _ in range(40)])
    fixed = centroids.pivots_of(middles, 5)
    row_pivots = centroids._distances(rows, fixed)
    bounds = centroids.lower_bounds(row_pivots, centroids._distances(middles, fixed), centroids._distances(fixed, fixed))
    assert (bounds <= centroids._distances(rows, middles)).all()
    _, distance, computed = centroids.nearest(rows, row_pivots, middles, fixed)
    exact = ((rows[:, None] - middles[None]) ** 2).sum(axis=2)
    assert (distance == exact.min(axis=1)).all()
    assert computed < 0.1 * exact.size  # apart clusters: nearly all centroids are ruled out
    same = np.repeat(middles[:1], 9, axis=0)  # equal centroids: the smaller number
    of, _, _ = centroids.nearest(rows, row_pivots, same, fixed)
    assert (of == 0).all()


# ---------------------------------------------------------------- embeddings


def plain_links(rows, cosine):
    ok = lambda e, l: l is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)
    units = [np.array(e, dtype=float) / np.linalg.norm(np.array(e, dtype=float)) if ok(e, l) else None for _, e, l, *_ in rows]
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if units[a] is None or units[b] is None or rows[a][2] != rows[b][2] or len(units[a]) != len(units[b]):
                continue
            if units[a] @ units[b] >= cosine:
                n[a] += 1
                n[b] += 1
                root[find(a)] = find(b)
    least = {}
    for a in range(len(rows)):
        i = rows[a][0]
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    out = [(r[0], n[a], least.get(find(a))) for a, r in enumerate(rows)]
    return sorted(((*x, x[0] == x[2]) for x in out), key=repr)


def test_near_embeddings(spark):
    rows = vector_rows(64, n=600, groups=60)
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = sorted((tuple(r) for r in embeddings.near_duplicates(df).collect()), key=repr)
    want = plain_links(rows, 0.98)
    assert sum(r[1] for r in want) > 40_000  # copies included
    assert got == want


def test_embeddings_in_blocks(spark, monkeypatch):
    """One group of near copies, all in the same keys, cut into many cells: each pair once."""
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    r = np.random.default_rng(1)
    middle = r.standard_normal(32)
    rows = [(i, (middle + 0.01 * r.standard_normal(32)).astype(np.float32).tolist(), 4, "c", 1, 2, 3) for i in range(150)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, VECTORS), bits=32).collect()
    assert {r.n_links for r in got} == {149} and {r.component_id for r in got} == {0}


def test_recall(spark):
    """Pairs right at the threshold, against brute force: at least 0.9 of them, none below."""
    r = np.random.default_rng(2)
    rows = []
    for i in range(400):
        x = r.standard_normal(64)
        x /= np.linalg.norm(x)
        y = r.standard_normal(64)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        c = 0.9805 if i % 2 else 0.9795
        for j, v in enumerate((x, c * x + math.sqrt(1 - c * c) * y)):
            rows.append((2 * i + j, v.astype(np.float32).tolist(), i % 5, "c", 1, 2, 3))
    got = embeddings.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    linked = {r.vec_id // 2 for r in got if r.n_links}
    assert all(i % 2 for i in linked) and len(linked) >= 180


def test_no_embeddings(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert embeddings.near_duplicates(empty).collect() == []
    rows = [(1, None, 1, "c", 1, 2, 3), (2, [0.0, 0.0], 1, "c", 1, 2, 3), (None, [1.0], None, "c", 1, 2, 3)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == [(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)]


def test_pairs_and_groups():
    import pyarrow as pa

    group = np.array([1, 1, 1, 2, 3, 3])
    assert sorted((int(a), int(b)) for x, y in embeddings._pairs(group) for a, b in zip(x, y)) == [(0, 1), (0, 2), (1, 2), (4, 5)]
    keys = [1, 1, 2, 2, 2, 3, 4, 4]
    for cut in range(9):
        parts = [pa.RecordBatch.from_pydict({"k": keys[a:b]}) for a, b in ((0, cut), (cut, 8))]
        got = [t.column("k").to_pylist() for t in embeddings._whole_groups(parts, ("k",))]
        assert sum(got, []) == keys
        assert all(not set(a) & set(b) for i, a in enumerate(got) for b in got[:i])
