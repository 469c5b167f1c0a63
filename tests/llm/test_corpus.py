"""Corpus operators against brute force, on hand-made rows with the awkward cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers as P
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from shelftalk.llm import bpe, classifier, fingerprints, licenses, packing, phrases, quality
from shelftalk.llm import sharding, simhash, suffixes

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, slot int, crc string, kept string"
rng = random.Random(3)
VOCABULARY = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(300)]


def prose(n):
    words = [rng.choice(VOCABULARY) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", ". ", ".\n"]) for w in words).strip()


def rows():
    shared, base = prose(70), prose(120)
    texts = [prose(rng.randint(1, 160)) for _ in range(40)]
    texts += [f"{prose(30)} {shared} {prose(20)}" for _ in range(12)]
    texts += [base] * 15 + [base.replace(" ", "  ", 1)] + [base + " x"]
    texts += [prose(9000), "", None, "   ", "one", "a" * 400, "CC BY CC by\nSPDX-License-Identifier: (MIT OR GPL-2.0) AND ISC"]
    texts += ["SPDX-License-Identifier: (MIT OR", "\x00\x1c 🙂 日本 ́", "- | > " * 60]
    made = [(i * 3, t) for i, t in enumerate(texts)]
    made += [made[3], (made[5][0], prose(80)), (None, shared), (None, None)]
    return [(i, t, "en", "s", len(t or ""), 1, "x", "y") for i, t in made]


ROWS = rows()
OPERATORS = {
    "fingerprints": fingerprints.edited_fingerprints,
    "licenses": licenses.scan_licenses,
    "simhash": simhash.near_duplicates,
    "packing": lambda df: packing.pack_documents(df, P.path("word_bpe_49k.json")),
    "phrases": phrases.repeated_words,
    "bpe": lambda df: bpe.round_trip(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN),
    "quality": quality.measure,
    "sharding": sharding.vector_shards,
    "suffixes": suffixes.repeated_bytes,
    "classifier": lambda df: classifier.score_documents(
        df, df.sparkSession.createDataFrame([(3, 1), (6, 0), (None, 1), (9, None)], "doc_id long, quality int")
    ),
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).collect() == []


def test_fingerprints(docs):
    got = OPERATORS["fingerprints"](docs).collect()
    assert len(got) == len(ROWS)
    texts = {i: t or "" for i, t, *_ in ROWS if i not in (None, 15)}
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    ids = sorted({i for i, *_ in ROWS if i is not None}, reverse=True)
    following = dict(zip(ids, ids[1:]))
    for r in got:
        after = following.get(r.doc_id)
        if r.doc_id in texts and after in texts:
            n, own = len(texts[r.doc_id]), texts[r.doc_id]
            edited = own[: n - n // 3] + texts[after][: n // 3]
            assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
    by_text = {}
    for r in got:
        if r.doc_id in texts:
            assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint


def word_sets(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_containment_and_merging(spark):
    """Parts of 7 to 1,000 words in texts of 1,000 and more, against exact sets."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    pairs = []
    for k in range(300):
        whole = [word() for _ in range(rng.choice([1000, 3000]))]
        n = rng.choice([7, 12, 40, 200, 1000])
        at = rng.randrange(len(whole) - n + 1)
        part = whole[at : at + n]
        if k % 3 == 0:
            part = part[: n // 2] + [word() for _ in range(n - n // 2)]
        pairs.append((k, " ".join(part), " ".join(whole)))
    df = spark.createDataFrame(pairs, "doc_id long, part string, whole string")
    of = lambda c: fingerprints.fingerprints(df.selectExpr("doc_id", f"{c} AS text")).select("doc_id", F.col("sketch").alias(c))
    joined = df.selectExpr("doc_id", "concat(part, ' | ', whole) AS text")
    met = of("part").join(of("whole"), "doc_id").join(fingerprints.fingerprints(joined).select("doc_id", "sketch"), "doc_id")
    found = met.select(
        "*", fingerprints.containment(F.col("part"), F.col("whole")).alias("share"),
        fingerprints.likeness(F.col("part"), F.col("whole")).alias("alike"),
    ).collect()
    errors, alike, told = [], [], 0
    for r in found:
        a, b = (word_sets(t) for t in pairs[r.doc_id][1:])
        assert (r.share is None) == (not r.part.low)
        if r.share is not None:
            errors.append(abs(r.share - len(a & b) / len(a)))
            if a <= b:
                told += 1
                assert r.share == 1.0
        alike.append(abs(r.alike - len(a & b) / len(a | b)))
        assert set(r.part.low) | set(r.whole.low) <= set(r.sketch.low)  # plus shingles across the seam
        assert len(r.sketch.low) - len(set(r.part.low) | set(r.whole.low)) <= 5
    assert told > 100 and sum(errors) / len(errors) < 0.05 and sum(alike) / len(alike) < 0.05


def test_short_texts_are_compared_exactly(spark):
    base = [f"w{i}" for i in range(30)]
    rows = [(0, " ".join(base), " ".join(base[:20])), (1, "a b", "a b"), (2, "", ""), (3, "a b", ""), (4, "", "a b")]
    df = spark.createDataFrame(rows, "doc_id long, a string, b string")
    of = lambda c: fingerprints.fingerprints(df.selectExpr("doc_id", f"{c} AS text")).select("doc_id", F.col("sketch").alias(c))
    met = of("a").join(of("b"), "doc_id").orderBy("doc_id")
    got = met.select(fingerprints.likeness(F.col("a"), F.col("b")), fingerprints.containment(F.col("b"), F.col("a"))).collect()
    assert [tuple(r) for r in got] == [(16 / 26, 1.0), (1.0, 1.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]


def plain_expression(tokens):
    """Names and restriction by recursive descent, loosest operator last; None if malformed."""
    def level(at, k):
        if k == 3:
            if at < len(tokens) and tokens[at] == "(":
                got = level(at + 1, 0)
                return got and got[0] < len(tokens) and tokens[got[0]] == ")" and (got[0] + 1, *got[1:]) or None
            if at < len(tokens) and tokens[at] not in ("and", "or", "with", ")"):
                return at + 1, {tokens[at]}, licenses.restriction(tokens[at])
            return None
        got = level(at, k + 1)
        while got and got[0] < len(tokens) and tokens[got[0]] == ("or", "and", "with")[k]:
            more = level(got[0] + 1, k + 1)
            if not more:
                return None
            both = (min if k == 0 else max)(got[2], more[2])
            got = (more[0], got[1], got[2] / 2) if k == 2 else (more[0], got[1] | more[1], both)
        return got

    got = level(0, 0)
    return got[1:] if got and got[0] == len(tokens) else None


def plain_findings(text):
    """Labels and score with neither automaton nor stack."""
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = " " + " ".join(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)) + " "
    phrases = {**licenses.NOTICE_PHRASES, **licenses.BASE_PHRASES}
    labels = {label for p, label in phrases.items() if f" {p} " in words}
    score = max(map(licenses.restriction, labels), default=0.0)
    for m in re.finditer("(?:license-identifier|license-expression):([^\n]*)", text):
        tokens, rest = [], m[1]
        while t := re.match(r"\s*([()]|[a-z0-9]([a-z0-9.+:-]*[a-z0-9+])?)", rest):
            tokens.append(t[1])
            rest = rest[t.end() :]
        tries = (plain_expression(tokens[:k]) for k in range(len(tokens), 0, -1))
        names, strict = next(filter(None, tries), ({"invalid-expression"}, 0.5))
        labels |= names
        score = max(score, strict)
    return ",".join(sorted(labels)), score


@pytest.mark.parametrize(
    "line, names",
    [
        ("/* SPDX-License-Identifier: GPL-2.0 */", "gpl-2.0"),
        ("<!-- SPDX-License-Identifier: MIT -->", "mit"),
        ("<!-- SPDX-License-Identifier: MIT-->", "mit"),
        ('"license-expression: MIT"', "mit"),
        ("License-Identifier: Apache-2.0, see LICENSE", "apache-2.0"),
        ("# SPDX-License-Identifier: (MIT or GPL-2.0+) with X.", "gpl-2.0+,mit"),
        ("// SPDX-License-Identifier: MIT OR (ISC and", "mit"),
        ("SPDX-License-Identifier: */ MIT", "invalid-expression"),
        ("SPDX-License-Identifier:", "invalid-expression"),
    ],
)
def test_expressions_in_comments(line, names):
    got = licenses.Scanner(licenses.BASE_PHRASES, licenses.NOTICE_PHRASES).scan(line + "\nmore text")
    assert got[5] == names and got[5:] == plain_findings(line)


def test_random_expressions():
    parts = ["mit", "gpl-2.0", "isc", "agpl-3.0+", "and", "or", "with", "(", ")", ",", "*/"]
    scanner = licenses.Scanner(licenses.BASE_PHRASES, licenses.NOTICE_PHRASES)
    for _ in range(4000):
        line = "spdx-license-identifier: " + " ".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert scanner.scan(line)[5:] == plain_findings(line)


def test_licenses(docs):
    got = Counter(tuple(r) for r in OPERATORS["licenses"](docs).collect())
    want = Counter()
    for i, t, *_ in ROWS:
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        found = [
            (at, label)
            for phrase, label in licenses.BASE_PHRASES.items()
            for at in range(len(words))
            if words[at : at + len(phrase.split())] == phrase.split()
        ]
        places = [at for at, _ in found]
        want[(i, len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found})))] += 1
    assert Counter(k[:6] for k in got.elements()) == want
    assert licenses.evaluate(licenses.to_postfix("mit or gpl-2.0 and isc")) == ({"mit", "gpl-2.0", "isc"}, 0.1)
    assert licenses.evaluate(licenses.to_postfix("gpl-2.0 with classpath"))[1] == pytest.approx(0.35)
    for bad in ("", "mit or", "(mit", "mit)", "or mit", "mit isc", "mit %"):
        with pytest.raises(ValueError):
            licenses.to_postfix(bad)
    assert Counter((k[0], k[6], k[7]) for k in got.elements()) == Counter((i, *plain_findings(t or "")) for i, t, *_ in ROWS)
    by_id = {k[0]: k for k in got}
    spdx = next(i for i, t, *_ in ROWS if t and "AND ISC" in t)
    assert by_id[spdx][6] == "cc-by,gpl-2.0,isc,mit"
    assert "invalid-expression" in by_id[spdx + 3][6]


def slow_print(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text).encode().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_ids(prints):
    group = list(range(len(prints)))
    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 3 and group[a] != group[b]:
                group = [group[a] if g == group[b] else g for g in group]
    first = {}
    for g, (i, _) in zip(group, prints):
        if i is not None:
            first[g] = min(first.get(g, i), i)
    return [(i, f"{p:016x}", first.get(g)) for g, (i, p) in zip(group, prints)], {g: first.get(g) for g in group}


def test_simhash(spark, docs):
    want, _ = least_ids([(i, slow_print(t or "")) for i, t, *_ in ROWS])
    got = [tuple(r) for r in OPERATORS["simhash"](docs).collect()]
    assert Counter(got) == Counter(want)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = base + [b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 3))) for b in base for _ in range(12)]
    prints = sorted({p & ((1 << 64) - 1) for p in prints})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    roots = {r.fp: r.root for r in simhash.near_groups(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}
    want = {p: w[2] for p, w in zip(signed, least_ids(list(zip(range(len(prints)), prints)))[0])}
    pairs = {(roots[p], want[p]) for p in signed}
    assert len(pairs) == len(set(roots.values())) == len(set(want.values()))


def test_packing(docs):
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = OPERATORS["packing"](docs).collect()
    want = Counter()
    for i, t, *_ in ROWS:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want[(i, piece, at, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(sequences) <= -(-total // 2048) + 1


def test_packing_keeps_ids_and_special_strings(spark):
    """Ids beyond 2^53 beside nulls, and the tokenizer's own strings as the library takes them."""
    big = [2**53 + 1, 2**53 + 3, -(2**53) - 1, 2**63 - 1, -(2**63)]
    texts = ["hello <|endoftext|> x", "<|endoftext|>", "in<|startoftext|>side, word", "A <|ENDOFTEXT|>", "<|endo ftext|>, a."]
    rows = [*zip(big, texts), (None, "b c"), (None, None), (5, "x <|endoftext|>,"), (5, "x <|endoftext|>,")]
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = Counter()
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        want[(i, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)))] += 1
    got = OPERATORS["packing"](spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.length, r.ids_crc32) for r in got) == want


def test_groups_of_repeated_rows(spark):
    """A row that is a third of all is dealt out over the groups; leftovers meet."""
    rows = [(7, 0, 0, 700)] * 3000 + [(i, 0, 0, 1 + i * 37 % 2048) for i in range(6000)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long").repartition(6)
    got = packing.pack_pieces(packing.materialize(pieces), 2048, group=256).collect()
    assert Counter((r.doc_id, r.length) for r in got) == Counter((r[0], r[3]) for r in rows)
    fill = Counter()
    for r in got:
        fill[r.sequence_id] += r.length
    alone = packing.best_fit(np.array([r[3] for r in rows]), 2048)  # all in one group
    assert max(fill.values()) <= 2048 and len(fill) <= 1.01 * len(alone)
    assert len({r.sequence_id >> 24 for r in got if r.doc_id == 7}) > 5


def test_local_search_empties_bins():
    import numpy as np

    n = np.array([6, 6, 4, 4, 3, 3, 2, 2])
    bins = [[0, 2], [1, 3], [4, 6], [5, 7]]
    packed = packing.local_search([list(b) for b in bins], n, 15)
    assert sorted(i for b in packed for i in b) == list(range(8)) and len(packed) == 2


def exchanges_left(bins, n, size):
    """Moves and swaps between underfull bins that raise squared fill."""
    underfull = [[n[i] for i in b] for b in bins if sum(n[i] for i in b) < size]
    pairs = lambda b: [x + y for k, x in enumerate(b) for y in b[:k]]
    for a in underfull:
        for b in underfull:
            gains = [x - y for x in a for y in [0, *b]]
            gains += [x - y for x in pairs(a) for y in b] + [x - y for x in a for y in pairs(b)]
            least = max(0, sum(a) - sum(b))
            if a is not b and any(least < g <= size - sum(b) for g in gains):
                return True
    return False


def test_local_search_leaves_no_exchange():
    import numpy as np

    # 9 + 3 and 7 + 6 in bins of 15: only the less full bin can gain, by 6 for 3
    assert exchanges_left([[0, 1], [2, 3]], [9, 3, 7, 6], 15)
    gained = packing.local_search([[0, 1], [2, 3]], np.array([9, 3, 7, 6]), 15)
    assert sorted(sorted(b) for b in gained) == [[0, 3], [1, 2]]
    draws = np.random.default_rng(5)
    for k in range(60):
        size = int(draws.integers(20, 200))
        n = np.maximum(1, draws.integers(1, size + 1, int(draws.integers(2, 80))) // (1 + k % 4))
        bins = packing.best_fit(n, size) if k % 2 else [[i] for i in range(len(n))]
        packed = packing.local_search([list(b) for b in bins], n, size)
        assert sorted(i for b in packed for i in b) == list(range(len(n)))
        assert max(n[b].sum() for b in packed) <= size
        assert not exchanges_left(packed, n.tolist(), size)


def windows_brute(units_of, join, count_spans):
    first, out = {}, []
    cut = [(float("inf") if i is None else i, units_of(t or "")) for i, t, *_ in ROWS]
    for i, u in cut:
        for q in range(len(u) - 49):
            k = tuple(u[q : q + 50])
            first[k] = min(first.get(k, i), i)
    for (i, *_), (own, u) in zip(ROWS, cut):
        gone = set()
        for q in range(len(u) - 49):
            if first[tuple(u[q : q + 50])] < own:
                gone |= set(range(q, q + 50))
        spans = sum(1 for k in gone if k - 1 not in gone)
        digest = hashlib.sha256(join([x for k, x in enumerate(u) if k not in gone])).hexdigest()
        out.append((i, len(u), len(gone), *([spans] if count_spans else []), digest))
    return Counter(out)


def test_phrases(docs):
    want = windows_brute(lambda t: t.encode().split(), b" ".join, False)
    assert Counter(tuple(r) for r in OPERATORS["phrases"](docs).collect()) == want


def test_suffixes(docs):
    want = windows_brute(lambda t: t.encode(), bytes, True)
    assert Counter(tuple(r) for r in OPERATORS["suffixes"](docs).collect()) == want


def test_frequent_anchors(spark, docs, monkeypatch):
    from shelftalk.llm import windows

    real = windows.frequent_anchors
    monkeypatch.setattr(windows, "frequent_anchors", lambda d, u, n: real(d, u, n, least=1))
    want = windows_brute(lambda t: t.encode(), bytes, True)
    assert Counter(tuple(r) for r in suffixes.repeated_bytes(docs).collect()) == want


def test_texts_longer_than_a_run(docs):
    """Passages that lie across the ends of runs, of which a text has dozens here."""
    from shelftalk.llm import phrases, windows

    want = windows_brute(lambda t: t.encode().split(), b" ".join, False)
    for run in (1, 7, 61):
        got = phrases.repeated_words(docs, windows.Units(words=True, run=run))
        assert Counter(tuple(r) for r in got.collect()) == want
    table = windows.numbered(docs)
    plain, cut = (
        Counter(
            (r.doc_id, r.text, bytes(windows.covered_units(r.data, len(r.text.encode()), 50)))
            for r in windows.covered_windows(table, units, suffixes.confirm_by_suffixes(50)).collect()
        )
        for units in (windows.Units(words=False), windows.Units(words=False, run=97))
    )
    assert plain == cut and any(any(mask) for _, _, mask in plain)


def test_largest_id_is_no_null(spark):
    top, text = (1 << 63) - 1, "".join(chr(97 + i * i % 26) for i in range(40)) + "x" * 30
    table = spark.createDataFrame([(top, text), (7, text), (-3, "y")], "doc_id long, text string")
    for operator, units, gone in ((suffixes.repeated_bytes, 70, 70), (OPERATORS["phrases"], 1, 0)):
        got = {r.doc_id: (r[1], r.n_removed) for r in operator(table).collect()}
        assert got == {top: (units, gone), 7: (units, 0), -3: (1, 0)}


def test_windows_across_shards():
    import numpy as np

    for shard in (1, 40, 300, 1 << 20):
        texts = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(0, 40))) for _ in range(41)]
        doc = np.array([rng.randint(-5, 5) for _ in texts])
        least = {}
        for d, t in zip(doc.tolist(), texts):
            for q in range(len(t) - 4):
                least[t[q : q + 5]] = min(least.get(t[q : q + 5], d), d)
        want = [[q for q in range(len(t) - 4) if least[t[q : q + 5]] < d] for d, t in zip(doc.tolist(), texts)]
        found = suffixes.confirm_by_suffixes(5, shard)(None, doc, texts)
        assert [f.tolist() for f in found] == want


def test_suffix_array():
    import numpy as np

    for _ in range(30):
        texts = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(1, 40))) for _ in range(6)]
        raw = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8).astype(np.int64) + 1
        starts = np.cumsum([0, *[len(t) + 1 for t in texts]])
        raw[starts[1:] - 1] = 0
        order, place = suffixes.suffix_array(raw)
        codes = raw.tolist()
        assert order.tolist() == sorted(range(len(codes)), key=lambda i: codes[i:])
        common = suffixes.common_prefixes(raw, order, place, starts, 10)
        for p in range(1, len(codes)):
            a, b, h = order[p], order[p - 1], 0
            while h < 10 and max(a, b) + h < len(codes) and codes[a + h] == codes[b + h] != 0:
                h += 1
            assert common[p] == h


def plain_offsets(text, tokens):
    owner = [i for i, c in enumerate(text) for _ in c.encode()]
    cuts = [0]
    for t in tokens:
        cuts.append(cuts[-1] + len(t))
    return [owner[a] for a in cuts[:-1]], [owner[z - 1] + 1 for z in cuts[1:]]


def test_bpe_cache_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 1 << 16)
    own = bpe.ByteBpe(bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), P.PATTERN)
    for k in range(60):
        text = "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(1000)) + f" {k}"
        assert own.decode(own.encode([text])[0].tolist()).decode() == text
        assert own.held < (1 << 16) + 20_000 and sum(map(len, own.known)) < 1 << 15


def test_bpe_decodes_any_rows(spark):
    rows = [(1, None, "x", "y"), (2, [], "x", "y"), (3, [33, 0], "x", "y")]
    got = bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>, text string, `a b` string"), P.path("byte_bpe_50k.tiktoken"))
    assert got.columns == ["doc_id", "a b", "data", "text"]
    assert [(r.doc_id, r["a b"], bytes(r.data).decode() == r.text) for r in got.collect()] == [(i, "y", True) for i in (1, 2, 3)]


def test_bpe(spark, docs):
    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    known = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want, offsets = [], []
    for i, t, *_ in ROWS:
        ids = known.encode_ordinary(t or "")
        starts, ends = plain_offsets(t or "", [known.decode_single_token_bytes(x) for x in ids])
        offsets.append((starts, ends))
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    hashed = spark.createDataFrame(offsets, "starts array<int>, ends array<int>").select(F.xxhash64("starts", "ends")).collect()
    want = Counter((*w[:3], h[0], w[3]) for w, h in zip(want, hashed))
    assert Counter(tuple(r) for r in OPERATORS["bpe"](docs).collect()) == want
    own = bpe.ByteBpe(ranks, P.PATTERN)
    parts = ["a", " ", "  ", "\n", "--", "=", "é", "日本", "🙂", "'s", "1", "\x1c", "aaaa", " x", "　", "____"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) + rng.choice("-a= *") * rng.randint(0, 90)
        assert own.encode([text])[0].tolist() == known.encode_ordinary(text)
    args = (P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    encoded = bpe.encode(docs, *args)
    assert Counter((r.doc_id, r.text) for r in bpe.decode(encoded, args[0]).collect()) == Counter((i, t or "") for i, t, *_ in ROWS)
    for r in encoded.collect():
        assert all(a < z for a, z in zip(r.starts, r.ends)) and list(r.starts) == sorted(r.starts)


def test_quality(docs):
    got = quality.measure(docs).collect()
    assert len(got) == len(ROWS) and got[0].asDict().keys() == {*docs.columns, "quality"}
    for r in got:
        w = WORD.findall(r.text or "")
        runs = list(zip(w, w[1:], w[2:]))
        n = Counter(runs)
        covered = {i + j for i, x in enumerate(runs) if n[x] > 1 for j in range(3)}
        lines = [x for x in (r.text or "").split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        q = r.quality
        assert (q.n_words, q.word_chars, q.n_dup_lines, q.n_repeat_words, q.base_failed) == (
            len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered), failed,
        )
        assert q.n_symbols == sum((r.text or "").count(c) for c in "#*$%&|<>")
        assert q.kept == (not failed and q.lost <= 0.5)


def test_sharding_one_row_repeated(spark):
    for repeated in ((7, "copy of one text"), (None, "copy of one text " * 9)):
        many = [repeated] * 3000 + [(i, prose(rng.randint(1, 30))) for i in range(6000)]
        got = sharding.vector_shards(spark.createDataFrame(many, "doc_id long, text string")).collect()
        filled, n = Counter(), Counter(r.shard for r in got)
        for r in got:
            filled[r.shard] += r["size"]
        assert len(got) == 9000 and max(filled.values()) < 1.02 * min(filled.values())
        assert max(n.values()) < 1.25 * min(n.values())
        assert sorted((r.shard, r.slot) for r in got) == [(s, k) for s in range(8) for k in range(n[s])]


def test_sharding(spark, docs):
    got = OPERATORS["sharding"](docs).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in ROWS)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    many = [(i, "copy of one text" if i % 3 == 0 else prose(rng.randint(1, 30))) for i in range(3000)]
    got = sharding.vector_shards(spark.createDataFrame(many, "doc_id long, text string"), block=300).collect()
    filled, slots = Counter(), {}
    for r in got:
        filled[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(slots) == 8 and max(filled.values()) < 1.02 * min(filled.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("limit", ["hash", "places"])
def test_quality_windows_past_their_bits(spark, monkeypatch, limit):
    if limit == "hash":  # every other window collides
        real = quality.F.xxhash64
        monkeypatch.setattr(quality.F, "xxhash64", lambda *c: quality.F.pmod(real(*c), quality.F.lit(2)))
    else:
        monkeypatch.setattr(quality, "_PLACE_BITS", 4)
        monkeypatch.setattr(quality, "_PLACES", 15)
    draws = random.Random(11)
    texts = [" ".join(draws.choice(VOCABULARY[:n]) for _ in range(n * 9)) for n in (1, 2, 6, 12, 20, 30)]
    texts += ["a b c " + " ".join(VOCABULARY) + " a b c", "one two", None]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.measure(made).collect():
        w = WORD.findall(r.text or "")
        runs = list(zip(w, w[1:], w[2:]))
        n = Counter(runs)
        assert r.quality.n_repeat_words == len({i + j for i, x in enumerate(runs) if n[x] > 1 for j in range(3)})


@pytest.mark.parametrize("copies", [[600], [12] * 90])
def test_sharding_long_copies_many_blocks(spark, copies):
    # long copies beside 3000 even texts: one group of a third of the rows, many just under 1/128
    texts = [f"{g:03d} " + "copy " * 100 for g, n in enumerate(copies) for _ in range(n)]
    texts += [f"{i:05d} " + "even " * 40 for i in range(3000)]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (50, 128 * 4):
        got = sharding.vector_shards(made, block=block).collect()
        assert sorted(r.doc_id for r in got) == list(range(len(texts)))
        loads = [[0, 0, 0] for _ in range(8)]
        shards_of = {}
        for r in got:
            text = texts[r.doc_id]
            shards_of.setdefault(text, set()).add(r.shard)
            for k, x in enumerate((r["size"], len(text.split()), 1)):
                loads[r.shard][k] += x
        for own in zip(*loads):
            assert max(own) < 1.03 * sum(own) / 8
        assert len(copies) == 1 or all(len(s) == 1 for s in shards_of.values())


def test_classifier_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = classifier.score_documents(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    held = scored.where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_classifier_odd_rows(docs):
    got = OPERATORS["classifier"](docs).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    for r in got:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)


def test_pipeline_stages(spark, docs, tmp_path):
    spark.createDataFrame([(3, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        none = stage(spark, empty, str(tmp_path))
        assert none.collect() == []
        if name != "best_fit_packing":
            assert out.columns == docs.columns
    kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()
    _, groups = least_ids([(i, slow_print(t or "")) for i, t, *_ in ROWS])
    assert Counter(r.doc_id for r in kept) == Counter(groups.values())
    cut = corpus_pipeline.repeated_bytes(spark, docs, str(tmp_path)).collect()
    assert len(cut) == len(ROWS) and all((r.text is None) == (r.n_chars is None) or r.text is None for r in cut)


def test_stages_with_any_column_names(spark, docs, tmp_path):
    spark.createDataFrame([(3, 1), (6, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    names = ["_null", "no_text", "own", "row", "doc", "data", "score", "quality", "fp", "root", "a.b", "part"]
    odd = docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)])
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, odd, str(tmp_path))
        if name != "best_fit_packing":
            assert got.columns == odd.columns
            assert all(r[c] == k for r in got.collect() for k, c in enumerate(names))
        else:
            assert got.count() > 0


def test_second_hash_is_its_own():
    from shelftalk.llm import windows

    hashes = np.random.default_rng(1).integers(0, 1 << 63, 400, dtype=np.uint64)
    *_, span = windows.occurrences(hashes, np.array([0, 400]), 50, 25)
    at = np.arange(300)
    first, second = span(at, 50), span(at, 50, second=True)
    again = windows.occurrences(np.tile(hashes, 2), np.array([0, 800]), 50, 25)[-1]
    assert (again(at + 400, 50, second=True) == second).all() and (again(at + 400, 50) == first).all()
    assert not (first == second).any()
    # equal in the first hash, not in the second: what one unit gains, its neighbour loses
    shifted = hashes.copy()
    shifted[10:11] -= np.uint64(windows._BASE)
    shifted[11:12] += np.uint64(1)
    other = windows.occurrences(shifted, np.array([0, 400]), 50, 25)[-1]
    assert other(at[:5], 50).tolist() == first[:5].tolist()
    assert not set(other(at[:5], 50, second=True).tolist()) & set(second.tolist())


def test_pipeline_passes_cleaned_text(spark, tmp_path):
    body = [" ".join(VOCABULARY[k : k + 8]) + "." for k in range(0, 160, 8)]
    made = [(1, "\n".join(["Home | About | » Shop | »", *body, "", "Click here"]), "en", 7), (2, "\n".join(body), "en", 7), (3, "short", "en", 5)]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string, n_chars long")
    got = corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
    clean = "\n".join(body)
    assert got.dtypes == docs.dtypes
    assert sorted(map(tuple, got.collect())) == [(i, clean, "en", len(clean)) for i in (1, 2)]
