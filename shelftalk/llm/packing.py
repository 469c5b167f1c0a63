"""Best-fit packing of tokenised documents into sequences of one length."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from shelftalk.llm.bpe import byte_characters
from shelftalk.llm.common import arrow_rows, text_runs, whole_texts, worker_kept
from shelftalk.sources.scratch import materialize

#: Tokens and words kept per Python worker; when either is reached, it starts anew.
CACHE_TOKENS, CACHE_WORDS = 2_000_000, 400_000
_MARK = "\x00"
#: Characters of texts that are encoded together.
_TOGETHER = 6 << 20
#: A word of Latin-1 letters, which may end in one mark.
_LETTERS = "^[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+$"

#: Sizes of the words of a list, and the ids of all of them one after the other.
Coded = tuple[np.ndarray, np.ndarray]


def _gathered(start: np.ndarray, size: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """``ids[start : start + size]`` of every word, one after the other."""
    end = np.cumsum(size)
    at = np.repeat(start - (end - size), size)
    at += np.arange(len(at))
    return ids[at]


class WordEncoder:
    """Ids of a text as little-endian 32-bit integers.

    The tokenizer's pre-tokens never contain white space, so a text's ids are those of its
    blank-separated words, one after the other. Each distinct word is encoded once per
    worker, many joined in one call with a mark between them. Words of Latin-1 letters are
    one pre-token, for them the library's merges run without its normaliser and splitter.
    A text that may hold one of the tokenizer's special strings, which can cross blanks, goes
    through the library as a whole.
    """

    def __init__(self, tokenizer_json: str):
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        made = json.loads(tokenizer_json)
        self.special = sorted({t["content"].lower() for t in made["added_tokens"]})
        bare = made | {"normalizer": None, "pre_tokenizer": None, "added_tokens": []}
        self.bare = Tokenizer.from_str(json.dumps(bare))
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.to_chars = dict(enumerate(byte_characters()))
        self.to_chars[32] = " "
        self.mark = self._ids(_MARK)
        self.tails = {c: self._ids(c) for c in ",."}
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}  # word to its place in start and size
        self.start, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool = np.empty(0, "<u4")

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _joined(self, words: list[str], letters: bool, size: int = 128) -> Coded:
        """Sizes and ids of words that don't hold the mark."""
        tokenizer = self.bare if letters else self.tokenizer
        sizes, every = [np.empty(0, np.int64)], [np.empty(0, "<u4")]
        for at in range(0, len(words), 64 * size):
            some = words[at : at + 64 * size]
            lines = [some[i : i + size] for i in range(0, len(some), size)]
            texts = [f" {_MARK} ".join(x) for x in lines]
            if letters:
                texts = [t.encode().decode("latin-1").translate(self.to_chars) for t in texts]
            found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            for line, encoding in zip(lines, found, strict=True):
                ids = np.array(encoding.ids, dtype="<u4")
                marks = ids == self.mark[0]
                cuts = np.flatnonzero(marks)
                if len(self.mark) != 1 or len(cuts) != len(line) - 1:  # a word has that id itself
                    own = [self._ids(w) for w in line]
                    sizes.append(np.array([len(x) for x in own], dtype=np.int64))
                    every += own
                else:
                    sizes.append(np.diff(cuts, prepend=-1, append=len(ids)) - 1)
                    every.append(ids[~marks])
        return np.concatenate(sizes), np.concatenate(every)

    def _keep(self, words: list[str], coded: Coded) -> None:
        sizes, ids = coded
        self.known.update(zip(words, range(len(self.size), len(self.size) + len(words)), strict=True))
        self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.pool = np.concatenate([self.pool, ids])

    def _learn(self, words: pa.Array) -> None:
        """Words of letters differ by case and a final mark only: their core is encoded once."""
        last = pc.utf8_slice_codeunits(words, -1)
        tail = sum(((i + 1) * pc.equal(last, c).to_numpy(zero_copy_only=False)) for i, c in enumerate(self.tails))
        tail[pc.utf8_length(words).to_numpy() < 2] = 0
        core = pc.if_else(pa.array(tail > 0), pc.utf8_slice_codeunits(words, 0, -1), words)
        plain = pc.match_substring_regex(core, _LETTERS)
        if any(len(ids) != 1 for ids in self.tails.values()):
            plain = pc.and_(plain, pa.array(tail == 0))
        letters = plain.to_numpy(zero_copy_only=False)

        cores = pc.utf8_lower(core.filter(plain)).dictionary_encode()
        sizes, ids = self._joined(cores.dictionary.to_pylist(), True)
        of = cores.indices.to_numpy()
        ends = tail[letters]
        size = sizes[of] + (ends > 0)
        out = np.empty(size.sum(), dtype="<u4")
        stop = np.cumsum(size)
        marked = np.zeros(len(out), dtype=bool)
        marked[stop[ends > 0] - 1] = True
        out[~marked] = _gathered((np.cumsum(sizes) - sizes)[of], sizes[of], ids)
        marks = np.array([0, *[x[0] for x in self.tails.values()]], dtype="<u4")
        out[marked] = marks[ends[ends > 0]]
        self._keep(words.filter(plain).to_pylist(), (size, out))

        others = words.filter(pc.invert(plain)).to_pylist()
        odd = [w for w in others if _MARK in w]
        others = [w for w in others if _MARK not in w] if odd else others
        self._keep(others, self._joined(others, False))
        own = [self._ids(w) for w in odd]
        self._keep(odd, (np.array([len(x) for x in own], dtype=np.int64), np.concatenate([np.empty(0, "<u4"), *own])))

    def encode(self, texts: list[str]) -> list[bytes]:
        # the tokenizer lower-cases; for ASCII that is lower() of the whole text
        plain = [(t.lower() if t.isascii() else t).replace("\n", " ") for t in texts]
        whole = {
            i: self._ids(texts[i]).tobytes()
            for i, t in enumerate(plain)
            if any(x in t or (not t.isascii() and x in t.lower()) for x in self.special)
        }
        for i in whole:
            plain[i] = ""
        lists = pc.split_pattern(pa.array(plain, pa.string()), " ")
        coded = lists.flatten().dictionary_encode()
        words, place = coded.dictionary, coded.indices.to_numpy()
        if len(self.pool) > CACHE_TOKENS or len(self.known) > CACHE_WORDS:
            self._forget()
        listed = words.to_pylist()
        of = np.fromiter(map(self.known.get, listed, repeat(-1)), dtype=np.int64, count=len(listed))
        fresh = of < 0
        if fresh.any():
            self._learn(words.filter(pa.array(fresh)))
            new = [listed[i] for i in np.flatnonzero(fresh)]
            of[fresh] = np.fromiter(map(self.known.__getitem__, new), dtype=np.int64, count=len(new))
        at = of[place]  # of each word of the texts, in order
        own = self.size[at]
        ids = _gathered(self.start[at], own, self.pool)
        cuts = np.concatenate([[0], np.cumsum(own)])[lists.offsets.to_numpy()].tolist()
        return [whole.get(i) or ids[a:z].tobytes() for i, (a, z) in enumerate(zip(cuts, cuts[1:]))]


_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
        ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary()),
    ]
)


def token_pieces(
    df: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 0, with_ids: bool = False
) -> DataFrame:
    """One row per piece: the document's ids and ``end_id``, cut only if longer than ``size``.

    ``ids`` holds little-endian unsigned 32-bit integers when asked for. A null text gives the
    end id alone.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    schema = _PIECES if with_ids else pa.schema(list(_PIECES)[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_kept("words", tokenizer_json, lambda: WordEncoder(tokenizer_json))
        end = np.array([end_id], dtype="<u4").tobytes()
        for ids, texts in text_runs(batches, _TOGETHER):
            rows = []
            for doc_id, data in zip(ids, encoder.encode(texts), strict=True):
                data += end
                for piece, at in enumerate(range(0, len(data), 4 * size)):
                    part = data[at : at + 4 * size]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part))
            yield arrow_rows(schema, **dict(zip(_PIECES.names, zip(*rows, strict=True), strict=True)))

    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return whole_texts(df).mapInArrow(run, kinds + (", ids binary" if with_ids else ""))


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the bin whose room it fits best."""
    by_room: list[list[list[int]]] = [[] for _ in range(size + 1)]
    has = 0  # bit r is set while a bin of room r exists
    bins: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = has >> n
        if found:
            room = n + (found & -found).bit_length() - 1
            own = by_room[room].pop()
            if not by_room[room]:
                has ^= 1 << room
        else:
            room, own = size, []
            bins.append(own)
        own.append(i)
        by_room[room - n].append(own)
        has |= 1 << (room - n)
    return bins


class _OpenBins:
    """Underfull bins with an index from lengths and pair sums to the bins that hold them.

    Items of one length are interchangeable, so a bin is a dictionary from lengths to items.
    Sets of lengths are rows of two tables (single lengths, sums of two items) and, for
    shifting, whole numbers with a bit for each length.
    """

    def __init__(self, bins: list[list[int]], lengths: list[int], size: int):
        self.size, self.width = size, size // 8 + 1
        self.items: list[dict[int, list[int]]] = []
        for b in bins:
            own: dict[int, list[int]] = {}
            for i in b:
                own.setdefault(lengths[i], []).append(i)
            self.items.append(own)
        self.fill = np.array([sum(lengths[i] for i in b) for b in bins], dtype=np.int64)
        shape = (len(bins), 8 * self.width)
        self.holds = np.zeros((2, *shape), dtype=np.uint8)  # single lengths, pair sums
        self.count = np.zeros((2, shape[1]), dtype=np.int32)  # open bins with each of them
        self.bits = [(0, 0)] * len(bins)
        self.least = np.zeros((2, shape[1]), dtype=np.int64)
        for b in range(len(bins)):
            self._index(b)

    def _index(self, b: int) -> None:
        """Enter the items of ``b`` as they are; a full bin leaves the index."""
        ones = twos = 0
        if self.fill[b] < self.size:
            for n in self.items[b]:
                ones |= 1 << n
            for n, same in self.items[b].items():
                twos |= (ones if len(same) > 1 else ones ^ 1 << n) << n
        self.bits[b] = ones, twos
        for kind, x in enumerate((ones, twos)):
            row = np.unpackbits(np.frombuffer(x.to_bytes(self.width, "little"), np.uint8), bitorder="little")
            self.count[kind] += row
            self.count[kind] -= self.holds[kind, b]
            self.holds[kind, b] = row
            np.minimum(self.least[kind], self.fill[b], out=self.least[kind], where=row.view(bool))

    def refresh(self) -> None:
        """``least``: no bin with a length or sum is emptier than this."""
        for kind in (0, 1):
            of = np.where(self.holds[kind], self.fill[:, None].astype(np.int32), np.int32(1 << 30))
            self.least[kind] = of.min(axis=0)

    def best(self, target: int) -> tuple[int, int, int, int, int] | None:
        """The largest gain for ``target`` that raises squared fill: source, lengths out and back
        with their kinds (0 one item, 1 two). None if no open bin has one."""
        fill = int(self.fill[target])
        room = (1 << self.size - fill + 1) - 2  # gains of 1 to the room
        ones, twos = (
            int.from_bytes(np.packbits(n > own[target], bitorder="little").tobytes(), "little")
            for n, own in zip(self.count, self.holds, strict=True)
        )
        found = [(gains, 0, 0, 0)] if (gains := ones & room) else []
        for n in self.items[target]:
            found += [(g, 0, n, 0) for g in [ones >> n & room] if g]
            found += [(g, 1, n, 0) for g in [twos >> n & room] if g]
        back = self.bits[target][1]
        while back and (n := (back & -back).bit_length() - 1) < ones.bit_length():
            back ^= 1 << n
            found += [(g, 0, n, 1) for g in [ones >> n & room] if g]
        every = 0
        for gains, *_ in found:
            every |= gains
        while every:
            gain = every.bit_length() - 1
            every ^= 1 << gain
            for gains, kind, back, two in found:
                # squared fill grows if the target ends fuller than the source was
                if gains >> gain & 1 and self.least[kind, gain + back] < fill + gain:
                    sources = np.flatnonzero(self.holds[kind, :, gain + back])
                    sources = sources[sources != target]
                    at = int(sources[self.fill[sources].argmin()])
                    if self.fill[at] < fill + gain:
                        return at, gain + back, kind, back, two
        return None

    def _take(self, b: int, n: int, two: int) -> list[int]:
        """An item of length ``n``, or two of that sum, out of bin ``b``."""
        own = self.items[b]
        if two:
            first = next(x for x in own if n - x in own and (2 * x != n or len(own[x]) > 1))
            return self._take(b, first, 0) + self._take(b, n - first, 0)
        item = own[n].pop()
        if not own[n]:
            del own[n]
        return [item]

    def exchange(self, lengths: list[int], target: int, source: int, n: int, kind: int, back: int, two: int) -> None:
        out = self._take(source, n, kind)
        returned = self._take(target, back, two) if back else []
        for b, given in ((target, out), (source, returned)):
            for i in given:
                self.items[b].setdefault(lengths[i], []).append(i)
        self.fill[target] += n - back
        self.fill[source] -= n - back
        self._index(target)
        self._index(source)


def local_search(bins: list[list[int]], lengths: np.ndarray, size: int) -> list[list[int]]:
    """Exchange items between underfull bins as long as the sum of squared fills grows.

    Moves, one for one, two for one and one for two, between any two underfull bins. Every bin
    in turn takes its largest gain from whatever bin offers it, of several from the emptiest;
    the search ends when no bin finds one, so no exchange of these kinds is left.
    """
    own = lengths.tolist()
    fill = [sum([own[i] for i in b]) for b in bins]
    done = [b for b, n in zip(bins, fill, strict=True) if n >= size]
    rest = _OpenBins([b for b, n in zip(bins, fill, strict=True) if n < size], own, size)
    moved = len(rest.items) > 1
    while moved:
        moved = False
        rest.refresh()
        for target in np.argsort(-rest.fill, kind="stable").tolist():
            while 0 < rest.fill[target] < size and (found := rest.best(target)):
                rest.exchange(own, target, *found)
                moved = True
    return done + [[i for same in b.values() for i in same] for b in rest.items if b]


def pack_pieces(pieces: DataFrame, size: int = 2048, group: int = 8192) -> DataFrame:
    """``sequence_id`` and ``offset`` for each row of ``pieces`` (a stored table).

    Rows are dealt into groups of about ``group`` sequences, repeated rows like any others; each
    group is packed by best fit and improved by local search in one task. A group keeps its
    full bins; what lies in its underfull bins is packed again together with that of the other
    groups, so that leftovers meet although no task sees all pieces, until what is left is one
    group or no longer halves (pieces that leave room nothing fits into).
    """
    columns = list(pieces.columns)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    order = [(c, "ascending") for c in ("doc_id", "piece", "ids_crc32", "start") if c in columns]

    def packer(first: int, last: bool):
        def pack(own: pa.Table) -> pa.Table:
            own = own.sort_by([*order, ("length", "ascending")])
            lengths = own.column("length").to_numpy()
            bins = local_search(best_fit(lengths, size), lengths, size)
            number = np.empty(own.num_rows, dtype=np.int64)
            offset = np.empty(own.num_rows, dtype=np.int64)
            closed = np.empty(own.num_rows, dtype=bool)
            base = (first + own.column("_group")[0].as_py()) << 24
            for b, items in enumerate(bins):
                n = lengths[items]
                number[items] = base + b
                offset[items] = np.cumsum(n) - n
                closed[items] = last or n.sum() == size
            made = {"sequence_id": number, "offset": offset, "_closed": closed}
            return pa.Table.from_arrays(
                [*[own.column(c) for c in columns], *map(pa.array, made.values())], names=[*columns, *made]
            )

        return pack

    out, rest, first, before = None, pieces, 0, None
    while True:
        tokens = rest.agg(F.sum("length")).first()[0] or 0
        groups = max(1, -(-tokens // (size * group)))
        last = groups == 1 or (before is not None and 2 * tokens > before)
        # a place of its own, not a key, so that rows that repeat are dealt out, too
        dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
        packed = materialize(
            rest.withColumn("_group", dealt)
            .groupBy("_group")
            .applyInArrow(packer(first, last), f"{kinds}, sequence_id long, offset long, _closed boolean")
        )
        finished = packed.where("_closed").drop("_closed")
        out = finished if out is None else out.unionByName(finished)
        if last:
            return out
        rest, first, before = packed.where("not _closed").select(*columns), first + groups, tokens


def pack_documents(df: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Packed pieces of all documents.

    Null and empty texts are the end id alone. Null ids stay null, other ids are kept as they
    are, whatever their size. Repeated rows are packed each for itself. Pieces of equal length
    go by id, piece and check sum. A text of any length is cut into pieces. Special strings of
    the tokenizer are encoded as the library does. An empty table gives an empty result. Columns: doc_id, piece, start,
    length, ids_crc32, sequence_id, offset.
    """
    return pack_pieces(materialize(token_pieces(df, tokenizer_path, size, end_id)), size)
