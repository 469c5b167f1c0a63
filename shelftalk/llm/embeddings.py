"""Near-duplicate embeddings: ITQ codes, multi-index Hamming tables, exact rerank.

A rotation learned by iterative quantisation turns vectors into balanced binary codes. The code
is cut into segments, one table for each; two codes that differ by fewer than ``tables * (flips
+ 1)`` bits differ by at most ``flips`` in some segment, so they share a key of that table: the
segment with so many bits masked. Rows of a key are compared in cells of bounded size, first by code, then
the vectors of the rows that have a partner there are fetched and compared by cosine. Tasks
hand back sums and one root for each row, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftalk.llm.common import arrow_rows, by_merge
from shelftalk.llm.components import components
from shelftalk.sources.scratch import materialize

#: Rows of a block; a cell joins two blocks of one key.
BLOCK = 256
#: Vectors that the rotation is learned from; all vectors are encoded.
SAMPLE = 8192
_PAIRS = 1 << 18


def valid(vector: Column) -> Column:
    """Not null, with a component other than zero, and none null or non-finite."""
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda v: v != 0), F.lit(False))


def unit_rows(column: pa.ListArray) -> list[np.ndarray]:
    """Vectors of length one, in doubles; scaled first, so that squares can't overflow."""
    out = []
    for v in column:
        x = np.asarray(v.values, dtype=np.float64)
        x = x / np.abs(x).max()
        out.append(x / np.sqrt(x @ x))
    return out


def folded(rows: list[np.ndarray], width: int) -> np.ndarray:
    """Rows of one width: component i is added to place ``i mod width``."""
    out = np.zeros((len(rows), width))
    for i, x in enumerate(rows):
        if len(x) == width:
            out[i] = x
        else:
            np.add.at(out[i], np.arange(len(x)) % width, x)
    return out


class Quantiser:
    """Centre, principal directions and rotation: sign bits of ``(x - centre) @ turn``.

    Vectors that are all close to their mean would differ in nothing but noise once it is taken
    off. So no more of the mean goes than leaves half of the vectors' squared length.
    """

    def __init__(self, sample: np.ndarray, bits: int, rounds: int = 40) -> None:
        mean = sample.mean(axis=0)
        share = mean @ mean / np.einsum("ij,ij->i", sample, sample).mean()
        self.centre = mean * (1 - np.sqrt(1 - 0.5 / share) if share > 0.5 else 1)
        x = sample - self.centre
        _, directions = np.linalg.eigh(x.T @ x)
        main = directions[:, ::-1][:, :bits]
        v = x @ main
        turn, _ = np.linalg.qr(np.random.default_rng(7).standard_normal((bits, bits)))
        for _ in range(rounds):  # codes for the rotation, then the rotation for the codes
            codes = np.where(v @ turn >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(codes.T @ v)
            turn = (left @ right).T
        self.turn = main @ turn
        self.bits = bits

    def encode(self, rows: np.ndarray) -> np.ndarray:
        """Codes as signed 64-bit integers, first bit lowest."""
        set_ = (rows - self.centre) @ self.turn >= 0
        wide = np.zeros((len(rows), 64), dtype=np.uint8)
        wide[:, : self.bits] = set_
        return np.packbits(wide, axis=1, bitorder="little").view("<i8").ravel()


class Tables:
    """Segments of the code and the masks of each, in the order in which a pair is looked for.

    A pair may share many keys; it belongs to the first.
    """

    def __init__(self, bits: int, tables: int, flips: int, radius: int) -> None:
        self.radius = radius
        self.masks: list[tuple[int, int]] = []  # of the segment, of the masked bits
        for places in np.array_split(np.arange(bits), tables):
            segment = sum(1 << int(p) for p in places)
            for masked in combinations(places, min(flips, len(places))):
                self.masks.append((segment, sum(1 << int(p) for p in masked)))

    def keys(self) -> list[int]:
        """Bits that count for each key, as signed 64-bit integers."""
        return [_signed(segment & ~masked) for segment, masked in self.masks]

    def own(self, differ: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Whether pairs that differ in these bits are near and belong to the given key."""
        differ = differ.view(np.uint64)
        near = np.bitwise_count(differ) <= self.radius
        near[near] = self.first(differ[near]) == table[near]
        return near

    def first(self, differ: np.ndarray) -> np.ndarray:
        found = np.full(len(differ), -1)
        for i, (segment, masked) in enumerate(self.masks):
            fits = (found < 0) & (differ & np.uint64(segment & ~masked) == 0)
            found[fits] = i
        return found


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def learn(nodes: DataFrame, bits: int, sample: int = SAMPLE) -> Quantiser | None:
    """A quantiser from ``sample`` vectors, those with the smallest hash of their number; its
    width is the commonest among them. The driver holds the sample, whose size is fixed."""
    rows = nodes.orderBy(F.xxhash64("node"), "node").limit(sample).select("vector").toArrow()
    units = unit_rows(rows.column(0).combine_chunks() if rows.num_rows else [])
    if not units:
        return None
    widths, counts = np.unique([len(x) for x in units], return_counts=True)
    width = int(widths[counts.argmax()])
    return Quantiser(folded(units, width), min(bits, width))


def _encoded(nodes: DataFrame, quantiser: Quantiser) -> DataFrame:
    schema = pa.schema([("node", pa.int64()), ("kind", pa.int64()), ("code", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = folded(unit_rows(batch.column(2)), len(quantiser.centre))
            yield arrow_rows(schema, node=batch.column(0), kind=batch.column(1), code=quantiser.encode(rows))

    return nodes.select("node", "kind", "vector").mapInArrow(run, "node long, kind long, code long")


def _whole_groups(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by the columns ``by``."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([np.asarray(batch.column(c)) for c in by])
        fresh = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        if kept:
            last = [kept[-1].column(c)[-1].as_py() for c in by]
            if last != [int(k) for k in keys[:, 0]]:
                fresh = np.concatenate([[0], fresh])
        if len(fresh):
            cut = int(fresh[-1])
            whole = pa.Table.from_batches([*kept, batch.slice(0, cut)])
            if whole.num_rows:
                yield whole
            kept = []
            batch = batch.slice(cut)
        kept.append(batch)
    if kept:
        yield pa.Table.from_batches(kept)


def _pairs(group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs within runs of equal ``group``, some at a time."""
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(group)]]))
    left = (starts + sizes).repeat(sizes) - np.arange(len(group)) - 1  # partners that follow
    at = 0
    while at < len(group):
        stop = at + max(1, int(np.searchsorted(left[at:].cumsum(), _PAIRS, side="right")))
        n = left[at:stop]
        a = np.arange(at, stop).repeat(n)
        b = a + 1 + np.arange(len(a)) - (n.cumsum() - n).repeat(n)
        if len(a):
            yield a, b
        at = stop


_CELL = ("key", "one", "two")


def _cell_pairs(table: pa.Table, tables: Tables) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a cell's rows that are near by code and belong to the cell's key: between the
    two blocks, or within the block of a cell that has one."""
    col = {c: table.column(c).to_numpy() for c in (*_CELL, "place", "block", "kind", "code")}
    edge = np.zeros(len(col["key"]), dtype=bool)
    for c in (*_CELL, "place"):
        edge[1:] |= col[c][1:] != col[c][:-1]
    for a, b in _pairs(edge.cumsum()):
        fits = (col["block"][a] != col["block"][b]) | (col["one"][a] == col["two"][a])
        fits &= col["kind"][a] == col["kind"][b]
        a, b = a[fits], b[fits]
        near = tables.own(col["code"][a] ^ col["code"][b], col["place"][a])
        if near.any():
            yield a[near], b[near]


_ROW = "key long, one int, two int, place int, block int, node long, kind long, code long"


def _candidates(coded: DataFrame, tables: Tables) -> DataFrame:
    """Rows of every cell that have a partner there, by code. A row for each row and cell."""
    bits = F.array(*[F.col("code").bitwiseAND(F.lit(k).cast("long")) for k in tables.keys()])
    keyed = coded.select("*", F.posexplode(bits).alias("place", "bits")).select(
        F.xxhash64("place", "kind", "bits").alias("key"), "place", "node", "kind", "code"
    )
    shared = keyed.groupBy("key").count().where("count > 1")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    rows = keyed.join(by_merge(shared), "key").select(
        "*", blocks.alias("blocks"), F.pmod(F.xxhash64("node", "key"), blocks).cast("int").alias("block")
    )
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = rows.select(
        "key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
        "place", "block", "node", "kind", "code",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, _CELL):
            active = np.zeros(table.num_rows, dtype=bool)
            for a, b in _cell_pairs(table, tables):
                active[a] = active[b] = True
            yield from table.filter(pa.array(active)).to_batches()

    return cells.repartition(*_CELL).sortWithinPartitions(*_CELL, "place").mapInArrow(run, _ROW)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that each of ``n`` places reaches through the links."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _checked(cells: DataFrame, tables: Tables, cosine: float) -> DataFrame:
    """``node``, ``n`` (rows of the partners linked in the cell) and ``root`` (the smallest
    linked node reached in the cell): a row for each row of a cell that has a link."""
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("root", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, _CELL):
            units = unit_rows(table.column("vector").combine_chunks())
            node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
            label = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
            width = np.array([len(x) for x in units])
            wide = folded(units, width.max())
            n, links = np.zeros(len(node), dtype=np.int64), []
            for a, b in _cell_pairs(table, tables):
                for at in range(0, len(a), 1 << 14):
                    i, j = a[at : at + (1 << 14)], b[at : at + (1 << 14)]
                    same = (label[i] == label[j]) & (width[i] == width[j])  # not only their hash
                    close = same & (np.einsum("ij,ij->i", wide[i], wide[j]) >= cosine)
                    i, j = i[close], j[close]
                    np.add.at(n, i, copies[j])
                    np.add.at(n, j, copies[i])
                    links.append((i, j))
            if n.any():
                a, b = (np.concatenate(x) for x in zip(*links, strict=True))
                order = node.argsort(kind="stable")
                back = np.empty_like(order)
                back[order] = np.arange(len(order))
                root = node[order][_roots(len(node), back[a], back[b])][back]
                some = n > 0
                yield arrow_rows(schema, node=node[some], n=n[some], root=root[some])

    rows = cells.repartition(*_CELL).sortWithinPartitions(*_CELL, "place")
    return rows.mapInArrow(run, "node long, n long, root long")


def near_duplicates(
    df: DataFrame,
    cosine: float = 0.98,
    bits: int = 64,
    tables: int = 4,
    flips: int = 1,
    radius: int = 12,
    sample: int = SAMPLE,
) -> DataFrame:
    """Links and component of every row, links being pairs of equal, non-null labels with at
    least that cosine (in doubles).

    Equal vectors of a label are one node, so copies cost nothing beyond a count. Vectors that
    are null, zero or hold a null or non-finite component, and rows without a label, link with
    nothing; so do vectors of different lengths. A null id is never the smallest; a component
    of null ids alone has a null id. Repeated rows are copies. An empty table gives an empty
    result. Extra columns are not looked at.

    ``tables`` should be about ``bits`` over the binary logarithm of the vectors of a label. With
    the defaults pairs within 7 bits are always found, those within ``radius`` bits if some
    segment differs by one bit at most, others not. The rotation is learned from ``sample`` vectors;
    every vector is encoded and looked up. A key with many rows is cut into blocks, each two
    of which are a cell of their own.

    Columns: vec_id, n_links, component_id, kept.
    """
    vector = F.col("embedding")
    if dict(df.dtypes)["embedding"] != "array<float>":
        vector = vector.cast("array<double>")
    rows = materialize(
        df.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.when(F.col("label").isNotNull() & valid(vector), F.struct(F.col("label").alias("label"), vector.alias("vector"))).alias("own"),
        )
    )
    linking = rows.where("own IS NOT NULL")
    classes = linking.groupBy("own").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    nodes = materialize(
        classes.select(
            F.monotonically_increasing_id().alias("node"),
            F.xxhash64("own.label", F.size("own.vector")).alias("kind"),
            F.col("own.vector").alias("vector"),
            "own", "copies", "first",
        )
    )
    quantiser = learn(nodes, bits, sample)
    alone = rows.where("own IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    if quantiser is None:
        return alone
    index = Tables(quantiser.bits, tables, flips, radius)
    cells = materialize(_candidates(materialize(_encoded(nodes, quantiser)), index))
    label = F.col("own.label").cast("string").alias("label")
    met = cells.join(by_merge(nodes.select("node", "vector", "copies", label)), "node")
    found = materialize(_checked(met, index, cosine))
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    links = found.where("root < node").select(F.col("root").alias("a"), F.col("node").alias("b")).distinct()
    roots = materialize(components(nodes, "node", links))
    firsts = roots.join(by_merge(nodes.select("node", "first")), "node").groupBy("root").agg(F.min("first").alias("component_id"))
    facts = (
        nodes.select("own", "node", "copies")
        .join(by_merge(counts), "node", "left")
        .join(by_merge(roots), "node")
        .join(by_merge(firsts), "root")
        .select("own", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    )
    joined = linking.join(by_merge(facts), "own").select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
    return joined.unionByName(alone)
