"""Windows of a document that also start in a document with a smaller id.

A window is a run of ``size`` units (bytes or words). Of the runs of ``anchor`` units within a
window, the one with the smallest hash is its anchor, so equal windows have equal anchors, and
neighbouring windows mostly share one. All windows of one anchor occurrence lie next to each
other; what they cover together is the occurrence's *stretch*.

1. Each task finds the occurrences of its documents and sends (anchor hash, stretch hash, id,
   place), deduplicated, to the task of the anchor hash.
2. There, an occurrence whose stretch also occurs under a smaller id is covered as a whole.
   Where one anchor has different stretches, the first occurrence of each remains *open*.
3. For the open ones the text itself is fetched, and a confirming function decides, window by
   window, on the units themselves.
4. The covered windows come back to their documents.

Only open stretches move as text. Anchors that a sample of documents shows in many different
stretches (the end of a line that a third of all documents hold) are not grouped: their windows
are sent one by one under their own hash, so that no group grows with the input. The
sample decides on the way, not on the result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftalk.llm.common import by_merge, worker_kept
from shelftalk.sources.scratch import materialize

NO_ID = (1 << 63) - 1  # stands for a null id: larger than any other
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_OTHER = np.uint64(0xA0761D6478BD642F)  # turns the units' numbers into a second set
_48 = np.uint64((1 << 48) - 1)
FLUSH = 1 << 19  # occurrences gathered before they are sent


@dataclass(frozen=True)
class Units:
    """How a text is cut: into bytes, or into words without ASCII white space.

    ``run`` units are hashed at once; longer texts in runs that overlap by a window less a unit.
    """

    words: bool
    size: int = 50
    anchor: int = 25
    run: int = 1 << 18

    def cut(self, text: str) -> bytes | list[bytes]:
        data = text.encode()
        return data.split() if self.words else data

    def hashes(self, units: bytes | list[bytes]) -> np.ndarray:
        if self.words:
            return np.fromiter(map(xxhash.xxh64_intdigest, units), dtype=np.uint64, count=len(units))
        table = worker_kept("windows", "byte hashes", lambda: np.random.default_rng(11).integers(0, 1 << 64, 256, dtype=np.uint64))
        return table[np.frombuffer(units, dtype=np.uint8)]

    def join(self, units) -> bytes:
        return b" ".join(units) if self.words else bytes(units)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def make() -> dict:
        return {"n": 0}

    kept = worker_kept("windows", "powers", make)
    if kept["n"] < n:
        m = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            p = np.full(m, np.uint64(base), dtype=np.uint64)
            p[0] = 1
            kept[name] = np.multiply.accumulate(p)
        kept["n"] = m
    return kept["up"][:n], kept["down"][:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each ``width`` neighbours."""
    done, out = 1, key
    while 2 * done <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def occurrences(hashes: np.ndarray, starts: np.ndarray, size: int, anchor: int):
    """Anchor occurrences of documents laid end to end (``starts``: n + 1 bounds).

    Arrays: anchor hash, stretch hash (with the anchor's place in it), first window, number of
    windows; places count from the beginning of the first document. Also the function that
    hashes single windows.
    """
    n = len(hashes)
    none = np.zeros(0, dtype=np.int64)
    if n < size:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, None
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    grams = _mix((sums[anchor:] - sums[:-anchor]) * down[: n - anchor + 1])
    key = (grams & ~np.uint64(0xFFFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
    owner = (_least(key, size - anchor + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    step = np.zeros(n + 1, dtype=np.int8)
    long = (starts[1:] - starts[:-1]) >= size
    np.add.at(step, starts[:-1][long], 1)
    np.add.at(step, starts[1:][long] - size + 1, -1)
    at = np.flatnonzero(np.cumsum(step[: len(owner)], dtype=np.int32))
    if not len(at):
        return none.astype(np.uint64), none.astype(np.uint64), none, none, None
    own = owner[at]
    head = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    first, place = at[head], own[head]
    count = np.diff(np.concatenate([head, [len(at)]]))
    others: list[np.ndarray] = []  # sums of other numbers for the units, made on demand

    def span(begin: np.ndarray, length, second: bool = False) -> np.ndarray:
        """Hash of ``length`` units; the second one shares no unit number with the first."""
        if second and not others:
            others.append(np.zeros(n + 1, dtype=np.uint64))
            np.cumsum(_mix(_mix(hashes ^ _OTHER)) * up[:n], out=others[0][1:])
        of = others[0] if second else sums
        return _mix((of[begin + length] - of[begin]) * down[begin])

    stretch = _mix(
        span(first, count + size - 1) + (place - first).astype(np.uint64) * np.uint64(1 << 16) + count.astype(np.uint64)
    )
    return grams[place] & _48, stretch & _48, first, count, span


def pack(*columns: np.ndarray) -> bytes:
    """Columns as one compressed value; 64-bit numbers as their halves, which compress better."""
    parts = []
    for c in columns:
        raw = np.ascontiguousarray(c)
        if raw.dtype.itemsize == 8:
            raw = raw.view(np.uint32).reshape(-1, 2).T.copy()
        parts.append(raw.tobytes())
    head = np.array([len(columns[0])], dtype="<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))


def unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n, at, out = int(np.frombuffer(raw, "<u4", 1)[0]), 4, []
    for kind in kinds:
        width = np.dtype(kind).itemsize
        if width == 8:
            halves = np.frombuffer(raw, "<u4", 2 * n, at).reshape(2, -1)
            out.append(np.ascontiguousarray(halves.T).view(kind).reshape(-1))
        else:
            out.append(np.frombuffer(raw, kind, n, at))
        at += width * n
    return out


_SENT = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("data", pa.binary()), ("docs", pa.binary())])
_SENT_SQL = "kind int, part int, data binary, docs binary"
COVERED, OPEN, SEEN = 0, 1, 2


def _batch(rows: list[tuple], schema: pa.Schema = _SENT) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _document_part(ids: np.ndarray, parts: int) -> np.ndarray:
    return (_mix(ids.astype(np.uint64) + np.uint64(77)) % np.uint64(parts)).astype(np.int64)


def _sent_by(kind: int, part: np.ndarray, columns: list[np.ndarray], doc: np.ndarray, ids, crcs) -> list[tuple]:
    """A row for each part, with the documents it names in a table of their own."""
    rows = []
    order = np.argsort(part, kind="stable")
    part, doc, columns = part[order], doc[order], [c[order] for c in columns]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]) if len(part) else [0]
    for a, z in zip(cuts, cuts[1:]):
        named, at = np.unique(doc[a:z], return_inverse=True)
        data = pack(*[c[a:z] for c in columns], at.astype(np.uint32))
        rows.append((kind, int(part[a]), data, pack(ids[named], crcs[named])))
    return rows


def _first_of(keys: tuple[np.ndarray, ...], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key and id, the first row of each key, and for each row the key's smallest id."""
    order = np.lexsort((ids, *reversed(keys)))
    new = np.zeros(len(order), dtype=bool)
    if len(order):
        new[0] = True
        for k in keys:
            k = k[order]
            new[1:] |= k[1:] != k[:-1]
    group = np.cumsum(new) - 1
    return order, new, ids[order][new][group] if len(order) else ids


def _texts(batches) -> Iterator[tuple[int, str]]:
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            yield doc_id, text.as_py()


def _scan(batches, units: Units):
    """Occurrences of runs of documents: ids, CRCs, then arrays with the document's number.

    A text of more than ``units.run`` windows counts as several documents of one id: each window
    is in one of them, and ``begins`` says where each document's text would begin.
    """
    ids, crcs, cuts, skipped, size = [], [], [], [], 0

    def found():
        starts = np.concatenate([[0], np.cumsum([len(c) for c in cuts])]).astype(np.int64)
        hashes = np.concatenate([units.hashes(c) for c in cuts])
        key, stretch, first, count, span = occurrences(hashes, starts, units.size, units.anchor)
        doc = np.searchsorted(starts, first, side="right") - 1
        begins = starts[:-1] - np.array(skipped, dtype=np.int64)
        return np.array(ids, dtype=np.int64), np.array(crcs, dtype=np.uint32), key, stretch, first, count, doc, begins, span

    for doc_id, text in _texts(batches):
        cut = units.cut(text)
        if len(cut) < units.size:
            continue
        crc = zlib.crc32(text.encode())
        for at in range(0, len(cut) - units.size + 1, units.run):
            part = cut[at : at + units.run + units.size - 1]
            if cuts and size + len(part) > units.run:
                yield found()
                ids, crcs, cuts, skipped, size = [], [], [], [], 0
            ids.append(doc_id)
            crcs.append(crc)
            cuts.append(part)
            skipped.append(at)
            size += len(part)
    if cuts:
        yield found()


def frequent_anchors(docs: DataFrame, units: Units, n_docs: int, sample: int = 20_000, least: int = 8) -> np.ndarray:
    """Anchors with ``least`` or more different stretches in a sample of about ``sample``
    documents. At most one in ``least`` of the sample's occurrences, a bounded number."""
    share = max(1, n_docs // sample)
    some = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(share)) == 0) if share > 1 else docs

    def run(batches):
        for _, _, key, stretch, *_ in _scan(batches, units):
            pairs = np.unique(np.stack([key, stretch], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0].astype(np.int64)), pa.array(pairs[:, 1].astype(np.int64))],
                names=["key", "stretch"],
            )

    seen = some.mapInArrow(run, "key long, stretch long").distinct()
    often = seen.groupBy("key").count().where(F.col("count") >= least).select("key").toArrow()
    return np.sort(often.column(0).to_numpy().astype(np.uint64))


def _send(units: Units, parts: int, frequent: np.ndarray) -> Callable:
    def run(batches):
        held, size = [], 0

        def flush():
            base, columns = 0, [[] for _ in range(5)]
            for own_ids, _, *arrays in held:
                for c, a in zip(columns, arrays, strict=True):
                    c.append(a)
                columns[4][-1] = columns[4][-1] + base
                base += len(own_ids)
            ids = np.concatenate([h[0] for h in held])
            crcs = np.concatenate([h[1] for h in held])
            key, stretch, first, count, doc = (np.concatenate(c) for c in columns)
            order, _, least = _first_of((key, stretch), ids[doc])
            key, stretch, first, count, doc = (c[order] for c in (key, stretch, first, count, doc))
            covered = ids[doc] > least
            rows = _sent_by(
                COVERED, _document_part(ids[doc[covered]], parts),
                [first[covered].astype(np.uint32), count[covered].astype(np.uint16)],
                doc[covered], ids, crcs,
            )
            go = ~covered
            rows += _sent_by(
                SEEN, (key[go] % np.uint64(parts)).astype(np.int64),
                [
                    (key[go] >> np.uint64(16)).astype(np.uint32), (key[go] & np.uint64(0xFFFF)).astype(np.uint16),
                    (stretch[go] >> np.uint64(16)).astype(np.uint32), (stretch[go] & np.uint64(0xFFFF)).astype(np.uint16),
                    first[go].astype(np.uint32), count[go].astype(np.uint16),
                ],
                doc[go], ids, crcs,
            )
            return _batch(rows)

        for ids, crcs, key, stretch, first, count, doc, begins, span in _scan(batches, units):
            if len(frequent) and len(key):
                near = np.minimum(np.searchsorted(frequent, key), len(frequent) - 1)
                often = frequent[near] == key
                if often.any():
                    each = np.repeat(np.flatnonzero(often), count[often])
                    at = first[each] + np.arange(len(each)) - np.repeat(
                        np.cumsum(count[often]) - count[often], count[often]
                    )
                    own = span(at, units.size)
                    rest = ~often
                    key = np.concatenate([key[rest], own & _48])
                    stretch = np.concatenate([stretch[rest], span(at, units.size, second=True) & _48])
                    first = np.concatenate([first[rest], at])
                    count = np.concatenate([count[rest], np.ones(len(at), dtype=count.dtype)])
                    doc = np.concatenate([doc[rest], doc[each]])
            held.append((ids, crcs, key, stretch, first - begins[doc], count, doc))
            size += len(key)
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return run


def _settle(parts: int) -> Callable:
    """Covered occurrences, and the open ones of anchors with different stretches."""

    def run(batches):
        columns, ids, crcs, base = [[] for _ in range(7)], [], [], 0
        for batch in batches:
            for kind, part, data, docs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == COVERED:
                    yield _batch([(kind, part, data, docs)])
                    continue
                own_ids, own_crcs = unpack(docs, "i8", "u4")
                own = unpack(data, "u4", "u2", "u4", "u2", "u4", "u2", "u4")
                own[6] = own[6].astype(np.int64) + base
                base += len(own_ids)
                for c, a in zip(columns, own, strict=True):
                    c.append(a)
                ids.append(own_ids)
                crcs.append(own_crcs)
        if not ids:
            return
        ids, crcs = np.concatenate(ids), np.concatenate(crcs)
        k1, k2, s1, s2, first, count, doc = (np.concatenate(c) for c in columns)
        del columns
        key = (k1.astype(np.uint64) << np.uint64(16)) | k2
        stretch = (s1.astype(np.uint64) << np.uint64(16)) | s2
        del k1, k2, s1, s2
        order, new, least = _first_of((key, stretch), ids[doc])
        key, first, count, doc = (c[order] for c in (key, first, count, doc))
        own = ids[doc]
        covered = own > least
        rows = _sent_by(COVERED, _document_part(own[covered], parts), [first[covered], count[covered]], doc[covered], ids, crcs)
        # an anchor with several stretches: the smallest id of each stays open
        head = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.cumsum(head) - 1
        several = np.bincount(group, weights=new)[group] > 1
        go = several & ~covered
        lowest = np.full(group[-1] + 1, NO_ID, dtype=np.int64)
        np.minimum.at(lowest, group, own)
        highest = np.full(group[-1] + 1, -(1 << 63), dtype=np.int64)
        np.maximum.at(highest, group, own)
        go &= (lowest < highest)[group]  # all of one document cover nothing
        rows += _sent_by(
            OPEN, _document_part(own[go], parts),
            [key[go], first[go], count[go]], doc[go], ids, crcs,
        )
        for at in range(0, len(rows), 64):
            yield _batch(rows[at : at + 64])

    return run


_PER_DOC = pa.schema([("doc", pa.int64()), ("crc", pa.int64()), ("data", pa.binary())])
_PER_DOC_SQL = "doc long, crc long, data binary"


def _per_document(kinds: tuple[str, ...]) -> Callable:
    """One row for each document with all that was sent about it, in order of place."""

    def run(batches):
        columns, ids, crcs = [[] for _ in kinds], [], []
        for batch in batches:
            for data, docs in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                own_ids, own_crcs = unpack(docs, "i8", "u4")
                *own, doc = unpack(data, *kinds, "u4")
                for c, a in zip(columns, own, strict=True):
                    c.append(a)
                ids.append(own_ids[doc])
                crcs.append(own_crcs[doc])
        if not ids:
            return
        ids, crcs = np.concatenate(ids), np.concatenate(crcs)
        columns = [np.concatenate(c) for c in columns]
        order = np.lexsort((columns[-2], crcs, ids))
        ids, crcs, columns = ids[order], crcs[order], [c[order] for c in columns]
        new = np.concatenate([[True], (ids[1:] != ids[:-1]) | (crcs[1:] != crcs[:-1])])
        cuts = np.concatenate([np.flatnonzero(new), [len(ids)]]).tolist()
        rows = []
        for a, z in zip(cuts, cuts[1:]):
            rows.append((int(ids[a]), int(crcs[a]), pack(*[c[a:z] for c in columns])))
            if len(rows) >= 1000:
                yield _batch(rows, _PER_DOC)
                rows = []
        if rows:
            yield _batch(rows, _PER_DOC)

    return run


_STRETCHES = pa.schema([("part", pa.int32()), ("data", pa.binary()), ("text", pa.binary())])
_STRETCHES_SQL = "part int, data binary, text binary"


def _fetch(units: Units, parts: int) -> Callable:
    """Text of the open stretches, sent to the part of their anchor."""

    def run(batches):
        def rows(held):
            part = np.array([int(h[0]) % parts for h in held])
            out = []
            for p in np.unique(part).tolist():
                own = [held[i] for i in np.flatnonzero(part == p)]
                key, doc, crc, first, text = zip(*own, strict=True)
                data = pack(
                    np.array(key, dtype=np.uint64), np.array(doc, dtype=np.int64), np.array(crc, dtype=np.uint32),
                    np.array(first, dtype=np.uint32), np.array([len(t) for t in text], dtype=np.uint32),
                )
                out.append((p, data, zstandard.ZstdCompressor(level=1).compress(b"".join(text))))
            return _batch(out, _STRETCHES)

        held = []
        for batch in batches:
            names = [batch.schema.get_field_index(c) for c in ("doc", "crc", "text", "data")]
            for doc, crc, text, data in zip(*(batch.column(i) for i in names), strict=True):
                if not data.is_valid:
                    continue
                cut = units.cut(text.as_py())
                for key, first, count in zip(*(c.tolist() for c in unpack(data.as_py(), "u8", "u4", "u2")), strict=True):
                    held.append((key, doc.as_py(), crc.as_py(), first, units.join(cut[first : first + count + units.size - 1])))
            if len(held) >= 1 << 15:
                yield rows(held)
                held = []
        if held:
            yield rows(held)

    return run


#: Of stretches (anchor hash, id, text): for each the covered windows, as places in it.
Confirm = Callable[[np.ndarray, np.ndarray, list[bytes]], list[np.ndarray]]


def _confirmed(confirm: Confirm, parts: int, block: int) -> Callable:
    """Confirm the stretches of a part. Anchors are taken in order, in blocks of about
    ``block`` bytes; all stretches of one anchor are in one block."""

    def run(batches):
        columns, texts = [[] for _ in range(5)], []
        for batch in batches:
            for data, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = unpack(data, "u8", "i8", "u4", "u4", "u4")
                raw, at = zstandard.ZstdDecompressor().decompress(text), 0
                for n in own[4].tolist():
                    texts.append(raw[at : at + n])
                    at += n
                for c, a in zip(columns, own, strict=True):
                    c.append(a)
        if not texts:
            return
        key, doc, crc, first, length = (np.concatenate(c) for c in columns)
        order = np.lexsort((doc, key))
        sizes = np.cumsum(length[order].astype(np.int64))
        heads = np.concatenate([[0], np.flatnonzero(np.diff(key[order])) + 1, [len(order)]])
        begin = 0
        for j in range(1, len(heads)):
            stop = heads[j]
            if j + 1 < len(heads) and sizes[heads[j + 1] - 1] - (sizes[begin - 1] if begin else 0) <= block:
                continue
            own = order[begin:stop]
            found = confirm(key[own], doc[own], [texts[i] for i in own])
            hit = np.repeat(np.arange(len(own)), [len(x) for x in found])
            if len(hit):
                place = (first[own][hit] + np.concatenate(found)).astype(np.uint32)
                rows = _sent_by(
                    COVERED, _document_part(doc[own][hit], parts),
                    [place, np.ones(len(hit), dtype=np.uint16)], hit, doc[own], crc[own],
                )
                yield _batch(rows)
            begin = stop

    return run


def _by(df: DataFrame, parts: int) -> DataFrame:
    """A task for each part; a hash of the part's number would put several into one task."""
    return df.repartitionById(parts, F.col("part"))


def covered_windows(docs: DataFrame, units: Units, confirm: Confirm, block: int = 1 << 20, part_units: int = 16 << 20) -> DataFrame:
    """``docs`` (``doc``, ``text``, others) with ``crc`` and ``data``: its covered windows.

    ``data`` is null, or packs first places (u4) and numbers of windows (u2); see
    :func:`covered_units`. Rows of one id are one document each; equal ones share a row of
    windows, and a window under the same id covers nothing.
    """
    sizes = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
    parts = max(1, -(-(sizes["size"] or 0) // (part_units * (6 if units.words else 1))))
    frequent = frequent_anchors(docs.select(F.col("doc").alias("doc_id"), "text"), units, sizes["n"])
    sent = docs.select("doc", "text").mapInArrow(_send(units, parts, frequent), _SENT_SQL)
    settled = materialize(_by(sent, parts).mapInArrow(_settle(parts), _SENT_SQL))
    keyed = docs.select("*", F.crc32(F.col("text").cast("binary")).alias("crc"))

    def with_rows(to: DataFrame, rows: DataFrame, *kinds: str) -> DataFrame:
        each = _by(rows, parts).mapInArrow(_per_document(kinds), _PER_DOC_SQL)
        return to.join(by_merge(each), ["doc", "crc"], "left")

    opened = with_rows(keyed.select("doc", "text", "crc"), settled.where(F.col("kind") == OPEN), "u8", "u4", "u2")
    stretches = opened.mapInArrow(_fetch(units, parts), _STRETCHES_SQL)
    confirmed = _by(stretches, parts).mapInArrow(_confirmed(confirm, parts, block), _SENT_SQL)
    return with_rows(keyed, settled.where(F.col("kind") == COVERED).unionByName(confirmed), "u4", "u2")


def covered_units(data: bytes | None, n: int, size: int) -> np.ndarray:
    """Whether each of a document's ``n`` units lies in a covered window."""
    if data is None:
        return np.zeros(n, dtype=bool)
    first, count = unpack(data, "u4", "u2")
    step = np.zeros(n + 1, dtype=np.int32)
    first = first.astype(np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, first + count + size - 1, -1)
    np.cumsum(step, out=step)
    return step[:-1] > 0


def numbered(df: DataFrame) -> DataFrame:
    """``doc`` (a null id as the largest), ``text`` (null as empty) and the id itself."""
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
