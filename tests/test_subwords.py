import random
from collections import Counter

import pytest

from shelftalk.operators import subwords as W
from shelftalk.plans import dialogs

TEXTS = ["the cat sat on the mat .", "the bat sat", "cats and bats", "", "a theatre , the cathedral"] * 3


@pytest.fixture(scope="module")
def pieces(spark):
    texts = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    return W.build_subwords(texts, target_size=60)


def test_vocabulary_shape(pieces):
    got = {r.piece: r.id for r in pieces.collect()}
    assert sorted(got.values()) == list(range(1, len(got) + 1)) and len(got) <= 60
    assert set("".join(TEXTS).replace(" ", "")) | {W.END} <= set(got)
    assert "the_" in got


def test_same_for_any_partitioning(spark, pieces):
    texts = spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(7)
    assert sorted(map(tuple, W.build_subwords(texts, target_size=60).collect())) == sorted(map(tuple, pieces.collect()))


def test_round_trip_and_width(spark, pieces):
    pairs = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(TEXTS, TEXTS[1:]))], "i long, input string, target string")
    encoded = W.encode_padded(pairs, pieces, 40)
    size = W.vocabulary_size(pieces)
    for r in encoded.collect():
        assert len(r.input_ids) == len(r.target_ids) == 40 and r.input_ids[0] == size + 1
        assert [x for x in r.input_ids if x][-1] == size + 2
    decoded = {r.i: r.text for r in W.decode_subwords(encoded, pieces, "i", "input_ids").collect()}
    assert all(decoded.get(r.i, "") == r.input for r in encoded.collect())
    assert W.encode_padded(pairs, pieces, 2).count() == 0


def test_flow(spark):
    said = spark.createDataFrame([(0, i, t) for i, t in enumerate(TEXTS)], "conv_id long, pos long, text string")
    pieces, encoded = dialogs.prepare_subwords(said, cap=10, target_size=50)
    assert encoded.count() == 10 and pieces.count() <= 50


def test_decoding_keeps_empty_and_rejects_unknown(spark):
    pieces = spark.createDataFrame([("ab_", 1, 1), ("c_", 2, 1)], "piece string, id int, n long")
    rows = spark.createDataFrame([(1, [259, 1, 2, 260, 0]), (2, [])], "k long, ids array<int>")
    got = W.decode_subwords(rows, pieces, "k", "ids").orderBy("k").collect()
    assert got == [(1, "ab c"), (2, "")]
    with pytest.raises(Exception, match="unknown subword id"):
        W.decode_subwords(rows.selectExpr("k", "array(261) ids"), pieces, "k", "ids").collect()


def test_padding_edges(spark):
    rows = [(1, [5, 6], [7]), (2, [], []), (3, [5] * 4, [5]), (4, None, [5]), (5, [5] * 3, [5] * 3)]
    df = spark.createDataFrame(rows, "k long, input_ids array<int>, target_ids array<int>")
    got = W.padded(df, 9, 5).orderBy("k").collect()
    assert [tuple(r) for r in got] == [
        (1, [10, 5, 6, 11, 0], [10, 7, 11, 0, 0]),
        (2, [10, 11, 0, 0, 0], [10, 11, 0, 0, 0]),
        (5, [10, 5, 5, 5, 11], [10, 5, 5, 5, 11]),
    ]
    assert W.padded(df.limit(0), 9, 5).collect() == []


def plain_vocabulary(texts, target, share=4, least=2):
    """The definition over one list of words, every pair counted anew."""
    words = Counter()
    for word in (w for t in texts if t for w in t.split(" ") if w):
        *before, last = word.split(W.END)
        words.update([p for p in before if p] + [last + W.END])
    letters = Counter()
    for word, n in words.items():
        for c in word:
            letters[c] += n
    chosen = dict(sorted(letters.items(), key=lambda e: (-e[1], e[0]))[:target])
    parts = {w: list(w) for w in words}
    while len(chosen) < target:
        pairs = Counter()
        for word, p in parts.items():
            for i in range(len(p) - 1):
                pairs[p[i], p[i + 1]] += words[word]
        best = [e for e in sorted(pairs.items(), key=lambda e: (-e[1], e[0])) if e[1] >= least]
        best = best[: target - len(chosen)]
        if not best:
            break
        taken = [pair for pair, n in best if n >= best[0][1] / share]
        for pair in taken:
            chosen.setdefault("".join(pair), pairs[pair])
        for p in parts.values():
            i = 0
            while i < len(p) - 1:
                here = (p[i], p[i + 1])
                there = (p[i + 1], p[i + 2]) if i + 2 < len(p) else None
                if here in taken and (there not in taken or taken.index(here) <= taken.index(there)):
                    p[i : i + 2] = ["".join(here)]
                i += 1
    return chosen


def odd_texts():
    draw = random.Random(5)
    words = ["".join(draw.choices("abé_漢", [6, 4, 2, 1, 1], k=draw.randint(1, 9))) for _ in range(60)]
    long = "ab" * 30 + "aaaaaaa"  # a piece may have any length
    return [" ".join(draw.choices(words, k=draw.randint(0, 8))) for _ in range(80)] + [long, long, "", None, "  ", "_", "a_", "_a"]


@pytest.mark.parametrize("target", [3, 40, 75, 10_000])
def test_vocabulary_against_plain(spark, target):
    for texts in (TEXTS, odd_texts()):
        got = W.build_subwords(spark.createDataFrame([(t,) for t in texts], "text string"), target)
        assert {r.piece: r.n for r in got.collect()} == plain_vocabulary(texts, target)


def test_no_length_limit(spark):
    texts = spark.createDataFrame([("ab" * 30 + "c",)] * 3, "text string")
    assert max(len(r.piece) for r in W.build_subwords(texts, 1000).collect()) == 62


def test_no_words(spark):
    none = spark.createDataFrame([(None,), ("",)], "text string")
    assert W.build_subwords(none).collect() == []
    pairs = spark.createDataFrame([("x y", "é")], "input string, target string")
    got = W.encode_padded(pairs, W.build_subwords(none), 6).first()
    assert got.input_ids == [257, 121, 33, 122, 33, 258]  # 1 + byte, a blank for each end
    assert got.target_ids == [257, 196, 170, 33, 258, 0]


def longest_match(sentence, ids):
    """Ids of a sentence, every piece tried at every place."""
    size, out = len(ids), []
    for word in (w for w in sentence.split(" ") if w):
        at, marked = 0, word.replace(W.END, "\0") + W.END
        while at < len(marked):
            piece = max((p for p in ids if marked.startswith(p, at)), key=len, default=None)
            if piece:
                out.append(ids[piece])
            else:
                byte = {"\0": W.END, W.END: " "}.get(marked[at], marked[at])
                out += [size + 1 + b for b in byte.encode()]
            at += len(piece or "x")
    return out


@pytest.mark.parametrize("target", [2, 30, 400])
def test_encoding_against_plain_and_back(spark, target):
    texts = odd_texts() + ["unseen ☃ 𝄞 _☃_", "a  b"]
    table = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    pieces = W.build_subwords(table.where("k < 70"), target)
    ids = {r.piece: r.id for r in pieces.collect()}
    encoded = table.repartition(3).withColumn("ids", W.subword_encoder(pieces)(table.text))
    rows = {r.k: r.ids for r in encoded.collect()}
    assert rows == {k: None if t is None else longest_match(t, ids) for k, t in enumerate(texts)}
    back = {r.k: r.text for r in W.decode_subwords(encoded, pieces, "k", "ids").collect()}
    assert back == {k: " ".join(w for w in (t or "").split(" ") if w) for k, t in enumerate(texts)}


def test_nothing_to_encode(spark):
    pieces = spark.createDataFrame([("ab_", 1, 1)], "piece string, id int, n long")
    table = spark.createDataFrame([(None,), ("",), (" ",)], "text string")
    got = [r[0] for r in table.coalesce(1).select(W.subword_encoder(pieces)(table.text)).collect()]
    assert got == [None, [], []]
    assert table.limit(0).select(W.subword_encoder(pieces)(table.text)).collect() == []
