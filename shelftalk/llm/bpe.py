"""Byte-level BPE from a rank file: ids with offsets, and back to bytes or text."""

from __future__ import annotations

import base64
import heapq
import itertools
import re
import sys
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from shelftalk.llm.common import text_runs, whole_texts, worker_kept

#: Bytes of chunks and their ids kept per Python worker; beyond, it starts anew.
CACHE_BYTES = 96 << 20


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    extra = itertools.count(256)
    return [chr(b if b in plain else next(extra)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def token_table(ranks: dict[bytes, int]) -> list[bytes]:
    """Bytes of each id; ids without a token have none."""
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


class ByteBpe:
    """Ids by the tokenizers library, built from ranks.

    Every way to split a token into two tokens is a merge with the token's rank. Two such
    merges of one token may overlap in a text (``x+y`` and ``y+z`` give the same token); a
    match that holds such a string is merged here, leftmost lowest rank first, since the
    library would rank the two merges apart.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.ranks = ranks
        chars = byte_characters()
        self.to_chars = lambda data: "".join([chars[b] for b in data])
        self.table = token_table(ranks)
        merges, overlaps = [], set()
        for token, rank in ranks.items():
            cuts = [c for c in range(1, len(token)) if token[:c] in ranks and token[c:] in ranks]
            merges += [(rank, c, token) for c in cuts]
            for a in cuts:
                c = len(token) - a
                if c in cuts and c != a and token[:c] == token[a:]:
                    overlaps.add(token[:a] + token)
        merges.sort()
        self.tokenizer = Tokenizer(
            models.BPE(
                vocab={self.to_chars(t): r for t, r in ranks.items()},
                merges=[(self.to_chars(t[:c]), self.to_chars(t[c:])) for _, c, t in merges],
                ignore_merges=True,
            )
        )
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(Regex(pattern), "isolated"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        self.overlaps = ahocorasick.Automaton()
        for data in {b"\xff\xff", *overlaps}:  # the first is in no text
            self.overlaps.add_word(data.decode("latin-1"), True)
        self.overlaps.make_automaton()
        self.sizes = np.array([len(t) for t in self.table])
        self.known: dict[str, bytes] = {}
        self.held = 0  # bytes of ``known``

    def _keep(self, chunk: str, ids: bytes) -> None:
        self.known[chunk] = ids
        self.held += sys.getsizeof(chunk) + sys.getsizeof(ids) + 100  # its place in the table

    def merge(self, data: bytes) -> list[int]:
        """Ids of one match: the lowest rank first, of equal ranks the leftmost."""
        if data in self.ranks:
            return [self.ranks[data]]
        end = list(range(1, len(data) + 1))  # end of the part that starts at i
        prev = list(range(-1, len(data) - 1))
        alive = [True] * len(data)
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = end[i]
            if j < len(data):
                rank = self.ranks.get(data[i : end[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[j]))

        for i in range(len(data)):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i] if alive[i] else len(data)
            if j >= len(data) or end[j] != stop:
                continue
            alive[j], end[i] = False, stop
            if stop < len(data):
                prev[stop] = i
            offer(i)
            if prev[i] >= 0:
                offer(prev[i])
        return [self.ranks[data[i : end[i]]] for i in range(len(data)) if alive[i]]

    def _overlapping(self, chunks: list[str], line: int = 64) -> set[str]:
        """Chunks that hold an overlap; many are looked through at once, then one by one."""
        found = set()
        for at in range(0, len(chunks), line):
            some = chunks[at : at + line]
            if next(self.overlaps.iter("".join(some).encode().decode("latin-1")), None):
                if line == 1:
                    found.update(some)
                else:
                    found |= self._overlapping(some, line // 8)
        return found

    def _learn(self, chunks: set[str], line: int = 256) -> None:
        """Encode chunks many at a time: joined, each still begins a match of its own, and the
        sizes of the ids tell where it ends."""
        single, joined = [], []
        odd = self._overlapping(list(chunks))
        for c in chunks:
            if c in odd:
                ids = [i for m in self.pattern.findall(c) for i in self.merge(m.encode())]
                self._keep(c, np.array(ids, dtype="<u4").tobytes())
            elif len(c) > 1 and c[0] == " " and not c[1].isspace():
                joined.append((c, len(c) if c.isascii() else len(c.encode())))
            else:
                single.append((c, len(c.encode())))
        lines = [joined[i : i + line] for i in range(0, len(joined), line)]
        lines += [[x] for x in single]
        for at in range(0, len(lines), 32):
            some = lines[at : at + 32]
            found = self.tokenizer.encode_batch_fast(
                ["".join([c for c, _ in x]) for x in some], add_special_tokens=False
            )
            for own, encoding in zip(some, found, strict=True):
                ids = np.array(encoding.ids, dtype="<u4")
                ends = np.cumsum([n for _, n in own])
                cuts = (np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1).tolist()
                data, begin = ids.tobytes(), 0
                for (c, _), end in zip(own, cuts, strict=True):
                    self._keep(c, data[4 * begin : 4 * end])
                    begin = end

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text.

        A blank before a character that is not white space always begins a match, so a text
        is the sequence of its blank-led chunks; each distinct chunk is encoded once per worker.
        """
        split = [_chunks(t) for t in texts]
        if self.held > CACHE_BYTES:
            self.known.clear()
            self.held = 0
        known = self.known
        found = [list(map(known.get, chunks)) for chunks in split]
        gaps = [k for k, ids in enumerate(found) if None in ids]
        self._learn({c for k in gaps for c, ids in zip(split[k], found[k]) if ids is None})
        for k in gaps:
            found[k] = [known[c] if ids is None else ids for c, ids in zip(split[k], found[k])]
        return [np.frombuffer(b"".join(ids), dtype="<u4") for ids in found]

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end character of each id: those its bytes lie in, also in part."""
        ends = np.cumsum(self.sizes[ids])
        data = text.encode()
        if len(data) == len(text):  # a byte for each character
            return (ends - self.sizes[ids]).astype(np.int32), ends.astype(np.int32)
        begins = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
        owner = np.cumsum(begins, dtype=np.int32) - 1  # the character each byte belongs to
        return owner[ends - self.sizes[ids]], owner[ends - 1] + 1

    def decode(self, ids: Iterable[int]) -> bytes:
        """Bytes of the ids; characters split between ids come together again."""
        return b"".join(map(self.table.__getitem__, ids))


def _chunks(text: str) -> list[str]:
    if not text:
        return []
    if _ODD.search(text) or text[0] == " " or text[-1] == " ":
        return re.split(r"(?<!^)(?= \S)", text)
    first, *rest = text.split(" ")
    return [first, *[" " + w for w in rest]]


_ODD = re.compile(r" \s")  # white space after a blank
_IDS = pa.schema(
    [
        ("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())),
        ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
    ]
)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.concatenate(rows).astype(np.int32) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encode(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Ids of every text, and the characters each id covers (``starts``, ``ends``).

    Two ids that share a split character both cover it. Null texts are empty and give empty
    lists; null ids stay null, repeated rows repeat, an empty table gives an empty result.
    """
    ranks, kept = read_ranks(ranks_path), ("bpe", ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_kept("chunks", kept, lambda: ByteBpe(ranks, pattern))
        for doc_ids, texts in text_runs(batches, 1 << 20):
            ids = bpe.encode(texts)
            starts, ends = zip(*map(bpe.offsets, texts, ids), strict=True)
            columns = [pa.array(doc_ids, pa.int64()), *map(_lists, (ids, starts, ends))]
            yield pa.RecordBatch.from_arrays(columns, schema=_IDS)

    return whole_texts(df).mapInArrow(
        run, "doc_id long, ids array<int>, starts array<int>, ends array<int>"
    )


def decode(df: DataFrame, ranks_path: str) -> DataFrame:
    """The rows of ``df`` with ``data`` and ``text`` of their ``ids`` in place of these; bytes
    that are no character become U+FFFD.

    Null ids are an empty list. Other columns stay; one named ``data`` or ``text`` is replaced.
    """
    table = token_table(read_ranks(ranks_path))
    others = [f for f in df.schema if f.name.lower() not in ("ids", "data", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                data = [
                    b"".join(map(table.__getitem__, x.values.to_numpy().tolist() if x.is_valid else ()))
                    for x in some.column(0)
                ]
                texts = [x.decode(errors="replace") for x in data]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[1:], pa.array(data, pa.binary()), pa.array(texts, pa.string())],
                    names=[*[f.name for f in others], "data", "text"],
                )

    return df.select(
        F.col("ids").cast("array<int>"), *[F.col(f"`{f.name}`") for f in others]
    ).mapInArrow(run, StructType([*others]).add("data", "binary").add("text", "string"))


def round_trip(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Digests of what :func:`encode` gives and of what :func:`decode` makes of its ids.

    Columns: doc_id, n_tokens, ids_sha256 (decimal ids joined by a blank), offsets_xxh64 (Spark's
    ``xxhash64`` of ``starts`` and ``ends``), decoded_sha256. A null text is empty, a null
    id stays null, repeated rows repeat, an empty table gives an empty result.
    """
    coded = encode(df, ranks_path, pattern).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.xxhash64("starts", "ends").alias("offsets_xxh64"),
    )
    return decode(coded, ranks_path).select(
        "doc_id", "n_tokens", "ids_sha256", "offsets_xxh64",
        F.sha2("data", 256).alias("decoded_sha256"),
    )
