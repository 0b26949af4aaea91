"""Hard negatives by exact search in a multiway hyperplane tree with sibling ranges.

*Tree.* An inner node has up to FAN split points, and a vector belongs to the
child whose split point is nearest. The tree is fitted on a bounded sample;
then every row is placed in a leaf, and for each split point and each sibling
subtree the smallest and largest distance between them is stored, over all rows.

*Search.* A query asks for an annulus of distances around it, from a window of
inner products: d^2 = |q|^2 + |x|^2 - 2 q.x, widened by the norms that a subtree
holds. By the triangle inequality a sibling whose stored range with some split
point does not meet that split point's range of the annulus holds no answer, and
is left out with all below it. Nothing is approximate: leaves compare whole
vectors of integers, so every answer is exact whatever the tree looks like.

*Rounds.* A leaf is cut into chunks of bounded size, and each chunk is packed into
one row. While it is packed, the anchors of the chunk are compared with it, which
bounds what can still be among their nearest positives. Then the anchors visit
the chunks that the tree leaves them, once for the positives and once, with all
their windows, for the negatives; a window's outer bound comes from the tree's
sample, which every task has. Chunks and anchors meet sorted: a task holds one
chunk and streams its anchors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landledger.llm.shared import hashed_sample, small_batches, table
from landledger.session import materialize

# The tree is fitted on at most this many vectors, and has about as many leaves at most as LEAVES.
SAMPLE, LEAVES, LEAF_ROWS, FAN = 20_000, 2048, 1000, 8
# Rows of a chunk, by the number of rows: about as many chunks as CHUNKS within these bounds, of CHUNK_VALUES components at most.
CHUNKS, LEAST_CHUNK, MOST_CHUNK, CHUNK_VALUES = 4000, 2048, 1 << 18, 1 << 24
# Anchors that are compared with a chunk at once, and rows that are handed to Python at once, as some are whole chunks.
ANCHOR_BLOCK, BATCH_ROWS = 256, 200
# Squared norms below this keep components within 32 and inner products within 64 bits.
LARGEST_NORM2 = 1 << 62
# Of a distance, what rounding may change; ranges are widened by it.
SLACK = 1e-6

ROW = "place long, id long, label long, vector binary, dims int, leaf int"


def integers(value: pa.Scalar) -> np.ndarray | None:
    """floor(256 x) of every component, or None where the vector takes no part."""
    if not value.is_valid or value.values.null_count:
        return None
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(256 * value.values.to_numpy(zero_copy_only=False).astype(np.float64))
        return x if float(x @ x) < LARGEST_NORM2 else None  # not where it is no number


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows of integers held as doubles."""
    bound = math.sqrt(float((a * a).sum(1).max(initial=0)) * float((b * b).sum(1).max(initial=0)))
    if bound < 1 << 52:  # every sum is exact in double precision
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


@dataclass
class Node:
    points: np.ndarray  # split points, one per child
    children: list["Node | int"]  # a node, or a leaf's number
    low: np.ndarray | None = None  # [split point, child]: range of distances to the child's rows
    high: np.ndarray | None = None
    norms: np.ndarray | None = None  # [child]: smallest and largest squared norm
    child_of: dict[int, int] = field(default_factory=dict)  # which child holds a leaf


@dataclass
class Tree:
    root: "Node | int" = 0
    nodes: list[Node] = field(default_factory=list)
    leaves: int = 1


def grow(sample: np.ndarray, leaves: int) -> Tree:
    """A tree whose leaves hold about a ``leaves``-th of the sample each. Deterministic."""
    tree = Tree(leaves=0)
    enough = max(len(sample) / max(leaves, 1), 2 * FAN)

    def leaf() -> int:
        tree.leaves += 1
        return tree.leaves - 1

    def split(rows: np.ndarray) -> Node | int:
        if len(rows) <= enough or leaves <= 1:
            return leaf()
        # split points far from each other, out of a few rows
        some = rows[np.linspace(0, len(rows) - 1, min(len(rows), 4 * FAN)).astype(int)]
        chosen, nearest = [0], distances(some, some[:1])[:, 0]
        while len(chosen) < FAN and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, distances(some, some[chosen[-1:]])[:, 0])
        points = some[chosen]
        at = distances(rows, points).argmin(1)
        if len(points) < 2 or np.bincount(at).max() == len(rows):
            return leaf()
        node = Node(points, [])
        tree.nodes.append(node)
        for k in range(len(points)):
            first = tree.leaves
            node.children.append(split(rows[at == k]))
            node.child_of |= dict.fromkeys(range(first, tree.leaves), k)
        return node

    tree.root = split(sample)
    return tree


def place(tree: Tree, vectors: np.ndarray) -> np.ndarray:
    """Leaf of every vector."""
    out = np.zeros(len(vectors), np.int64)

    def descend(node: Node | int, at: np.ndarray) -> None:
        if isinstance(node, int):
            out[at] = node
        elif len(at):
            child = distances(vectors[at], node.points).argmin(1)
            for k, below in enumerate(node.children):
                descend(below, at[child == k])

    descend(tree.root, np.arange(len(vectors)))
    return out


def widen(tree: Tree, vectors: np.ndarray, leaf: np.ndarray, ranges: dict) -> None:
    """Add vectors and the leaves they lie in to the ranges by node number: low, high and norms by child."""
    squares = (vectors * vectors).sum(1)
    for number, node in enumerate(tree.nodes):
        child = np.array([node.child_of.get(k, -1) for k in range(tree.leaves)])[leaf]
        if (child < 0).all():
            continue
        size = len(node.points)
        empty = (np.full((size, size), np.inf), np.full((size, size), -np.inf), np.full((size, 2), [np.inf, -np.inf]))
        low, high, norms = ranges.setdefault(number, empty)
        for k in np.unique(child[child >= 0]).tolist():
            mine = child == k
            d = distances(vectors[mine], node.points)
            low[:, k] = np.minimum(low[:, k], d.min(0))
            high[:, k] = np.maximum(high[:, k], d.max(0))
            norms[k] = min(norms[k, 0], squares[mine].min()), max(norms[k, 1], squares[mine].max())


def visited(tree: Tree, query: np.ndarray, windows: list[tuple[float, float]]) -> list[int]:
    """Leaves that may hold a row whose inner product with ``query`` lies in one of the windows."""
    found: list[int] = []
    square = float(query @ query)

    def descend(node: Node | int) -> None:
        if isinstance(node, int):
            found.append(node)
            return
        d = distances(query[None, :], node.points)[0]
        wide = SLACK * (1 + math.sqrt(square) + np.sqrt(node.norms[:, 1].clip(0)))
        meets = np.zeros(len(d), bool)
        for low, high in windows:
            inner = np.sqrt(np.maximum(square + node.norms[:, 0] - 2 * high, 0)) - wide
            outer = np.sqrt(np.maximum(square + node.norms[:, 1] - 2 * low, 0)) + wide
            # no row of norm n has a larger product than |q| n, nor a smaller one than -|q| n
            reached = (square + node.norms[:, 1] - 2 * low >= -wide * wide) & (outer >= inner)
            least = np.maximum(np.maximum(d[:, None] - outer[None, :], inner[None, :] - d[:, None]), 0)
            most = d[:, None] + outer[None, :]
            meets |= reached & ((node.low - wide <= most) & (node.high + wide >= least)).all(0)
        for k in np.flatnonzero(meets & np.isfinite(node.low[0])).tolist():
            descend(node.children[k])

    descend(tree.root)
    return found


def placed_rows(vectors: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """ROW for every row that takes part; vectors of a length without a tree are one leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = [integers(v) for v in batch.column(2)]
            kept = np.array([r is not None for r in rows], bool)
            sizes = np.array([0 if r is None else len(r) for r in rows])
            leaf = np.zeros(len(rows), np.int64)
            for size, tree in trees.items():
                at = np.flatnonzero(kept & (sizes == size))
                if len(at):
                    leaf[at] = place(tree, np.array([rows[k] for k in at]))
            raw = [None if r is None else r.astype("<i4").tobytes() for r in rows]
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(first, first + len(rows))), batch.column(0), batch.column(1),
                    pa.array(raw, pa.binary()), pa.array(sizes, pa.int32()), pa.array(leaf, pa.int32()),
                ],
                names=["place", "id", "label", "vector", "dims", "leaf"],
            )
            first += len(rows)
            yield out.filter(pa.array(kept))

    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    read = vectors.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").select(
        F.col("vec_id").cast("long"), changed.cast("long"), F.col("embedding").cast("array<double>")
    )
    return read.mapInArrow(run, ROW)


def unpack(raw: list[bytes], dims: int) -> np.ndarray:
    """Vectors of four-byte integers as rows of doubles."""
    return np.frombuffer(b"".join(raw), "<i4").astype(np.float64).reshape(len(raw), dims)


def with_ranges(trees: dict[int, Tree], rows: DataFrame) -> dict[int, Tree]:
    """Store the sibling ranges of all rows in the trees. A task hands on one row per node of a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, dict] = {size: {} for size in trees}
        for batch in batches:
            sizes, leaf = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for size, tree in trees.items():
                at = np.flatnonzero(sizes == size)
                if len(at):
                    widen(tree, unpack(batch.column(0).take(pa.array(at)).to_pylist(), size), leaf[at], seen[size])
        found = [
            (size, node, i, k, float(low[i, k]), float(high[i, k]), float(norms[k, 0]), float(norms[k, 1]))
            for size, by_node in seen.items()
            for node, (low, high, norms) in by_node.items()
            for i in range(len(low))
            for k in range(len(low))
        ]
        if found:
            yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*found)))), schema=schema)

    names = ["dims", "node", "i", "k", "low", "high", "least", "most"]
    schema = pa.schema([(n, pa.int32() if n in names[:4] else pa.float64()) for n in names])
    merged = rows.select("vector", "dims", "leaf").mapInArrow(
        run, "dims int, node int, i int, k int, low double, high double, least double, most double"
    )
    merged = merged.groupBy("dims", "node", "i", "k").agg(F.min("low"), F.max("high"), F.min("least"), F.max("most"))
    for tree in trees.values():
        for node in tree.nodes:
            size = len(node.points)
            node.low, node.high = np.full((size, size), np.inf), np.full((size, size), -np.inf)
            node.norms = np.full((size, 2), [np.inf, -np.inf])
    # at most FAN rows per split point of the trees
    for dims, node, i, k, low, high, least, most in merged.collect():
        target = trees[dims].nodes[node]
        target.low[i, k], target.high[i, k], target.norms[k] = low, high, (least, most)
    return trees


@dataclass
class Block:
    """The rows of one chunk."""

    places: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray


def top(block: Block, score: np.ndarray, allowed: np.ndarray, count: int) -> np.ndarray:
    """Positions of the first ``count`` allowed rows: larger scores, then smaller ids, then places."""
    at = np.flatnonzero(allowed)
    if len(at) > 4 * count:
        # only what reaches the count-th score can be among them
        at = at[score[at] >= np.partition(score[at], len(at) - count)[len(at) - count]]
    return at[np.lexsort((block.places[at], block.ids[at], -score[at]))][:count]


POSITIVE = "anchor long, anchor_id long, place long, id long, score long"
NEGATIVE = "anchor long, anchor_id long, positive int, positive_id long, positive_score long, place long, id long, score long"


def _first(df: DataFrame, by: list[str], count: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id", "place")
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= count)


class Mine:
    """The settings of a search, and what every task needs of it."""

    def __init__(self, anchor_every: int, positives: int, negatives: int, low: int, high: int):
        self.anchor_every, self.positives, self.negatives = anchor_every, positives, negatives
        self.low, self.high = low, high  # percent of the positive's score

    def window(self, score: int) -> tuple[int, int]:
        """Inner products of the rows that are hard for a positive, both ends included."""
        return -(-self.low * score // 100), self.high * score // 100

    def blocks(self, dealt: DataFrame) -> DataFrame:
        """Packed chunks, and the bound that its own chunk gives each anchor."""
        every, positives = self.anchor_every, self.positives

        def packed(held: list[pa.Table], key: tuple) -> Iterator[pa.RecordBatch]:
            rows = pa.concat_tables(held).combine_chunks()
            places, ids, labels = (rows.column(c).to_numpy() for c in ("place", "id", "label"))
            raw = rows.column("vector").to_pylist()
            block = Block(places, ids, labels, unpack(raw, key[0]))
            anchors = np.flatnonzero(ids % every == 0)
            bounds = []
            for begin in range(0, len(anchors), ANCHOR_BLOCK):
                some = anchors[begin : begin + ANCHOR_BLOCK]
                for a, score in zip(some.tolist(), exact(block.vectors[some], block.vectors)):
                    allowed = labels == labels[a]
                    allowed[a] = False
                    best = top(block, score, allowed, positives)
                    bounds.append(int(score[best[-1]]) if len(best) == positives else None)
            count = len(anchors)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key[0]] * (count + 1), pa.int32()), pa.array([key[1]] * (count + 1), pa.int32()),
                    pa.array([key[2]] * (count + 1), pa.int32()),
                    pa.array([len(raw)] + [None] * count, pa.int32()),
                    pa.array([b"".join([places.tobytes(), ids.tobytes(), labels.tobytes(), *raw]), *(raw[a] for a in anchors.tolist())], pa.binary()),
                    pa.array([None, *places[anchors].tolist()], pa.int64()),
                    pa.array([None, *ids[anchors].tolist()], pa.int64()),
                    pa.array([None, *labels[anchors].tolist()], pa.int64()),
                    pa.array([None, *bounds], pa.int64()),
                ],
                names=["dims", "leaf", "chunk", "rows", "data", "anchor", "anchor_id", "anchor_label", "bound"],
            )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, held = None, []
            for part, batch in _by_key(batches):
                if part != key and held:
                    yield from packed(held, key)
                    held = []
                key = part
                held.append(pa.Table.from_batches([batch]))
            if held:
                yield from packed(held, key)

        together = dealt.repartition("dims", "leaf", "chunk").sortWithinPartitions("dims", "leaf", "chunk", "place")
        return together.mapInArrow(
            run,
            "dims int, leaf int, chunk int, rows int, data binary, anchor long, anchor_id long, anchor_label long, bound long",
        )

    def search(self, blocks: DataFrame, asks: DataFrame, schema: str, answer) -> DataFrame:
        """``answer(block, asks)`` of every chunk and the asks (anchor, ..., windows) that visit it."""
        extra = [F.lit(None).cast(t).alias(c) for c, t in (("anchor", "long"), ("anchor_id", "long"), ("anchor_label", "long"))]
        windows = F.array().cast("array<array<long>>").alias("windows")
        sides = blocks.filter("rows IS NOT NULL").select("dims", "leaf", "chunk", "rows", "data", *extra, windows).unionByName(
            asks.select("dims", "leaf", "chunk", F.lit(None).cast("int").alias("rows"), "data", "anchor", "anchor_id", "anchor_label", "windows")
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, block = None, None
            for part, batch in _by_key(batches):
                rows = batch.column("rows").to_pylist()
                if part != key:
                    key = part
                    block = open_block(batch.column("data")[0].as_py(), rows[0], key[0])
                    batch = batch.slice(1)  # the chunk sorts before its anchors
                for begin in range(0, batch.num_rows, ANCHOR_BLOCK):
                    some = batch.slice(begin, ANCHOR_BLOCK)
                    found = answer(block, exact(unpack(some.column("data").to_pylist(), key[0]), block.vectors), some)
                    if found:
                        columns = [pa.array(np.concatenate(c)) for c in zip(*found)]
                        yield pa.RecordBatch.from_arrays(columns, schema=arrow)

        arrow = pa.schema([(f.split()[0], pa.int32() if f.endswith(" int") else pa.int64()) for f in schema.split(", ")])
        together = sides.repartition("dims", "leaf", "chunk").sortWithinPartitions(
            "dims", "leaf", "chunk", F.col("rows").isNull(), "anchor"
        )
        return together.mapInArrow(run, schema)

    def nearest(self, block: Block, scores: np.ndarray, asks: pa.RecordBatch) -> list[tuple]:
        out = []
        columns = zip(*(asks.column(c).to_pylist() for c in ("anchor", "anchor_id", "anchor_label", "windows")))
        for (anchor, anchor_id, label, windows), score in zip(columns, scores):
            allowed = (block.labels == label) & (block.places != anchor)
            if windows:
                allowed &= score >= windows[0][0]
            at = top(block, score, allowed, self.positives)
            n = len(at)
            if n:
                out.append((np.full(n, anchor), np.full(n, anchor_id), block.places[at], block.ids[at], score[at]))
        return out

    def hardest(self, block: Block, scores: np.ndarray, asks: pa.RecordBatch) -> list[tuple]:
        out = []
        columns = zip(*(asks.column(c).to_pylist() for c in ("anchor", "anchor_id", "anchor_label", "windows")))
        for (anchor, anchor_id, label, windows), score in zip(columns, scores):
            other = block.labels != label
            for number, positive_id, positive_score, low, high in windows:
                at = top(block, score, other & (score >= low) & (score <= high), self.negatives)
                n = len(at)
                if n:
                    out.append((
                        np.full(n, anchor), np.full(n, anchor_id), np.full(n, number, np.int32), np.full(n, positive_id),
                        np.full(n, positive_score), block.places[at], block.ids[at], score[at],
                    ))
        return out


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Slices of sorted batches that lie in one (dims, leaf, chunk)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("dims", "leaf", "chunk")], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield tuple(keys[begin].tolist()), batch.slice(begin, end - begin)


def open_block(raw: bytes, rows: int, dims: int) -> Block:
    places, ids, labels = (np.frombuffer(raw, "<i8", rows, 8 * rows * k) for k in range(3))
    return Block(places, ids, labels, np.frombuffer(raw, "<i4", rows * dims, 24 * rows).astype(np.float64).reshape(rows, dims))


def _routes(asks: DataFrame, trees: dict[int, Tree], chunks: DataFrame) -> DataFrame:
    """``asks`` once for every chunk of the leaves that the tree leaves them."""
    fields = asks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, leaves = [], []
            sizes = batch.column(fields.index("dims")).to_pylist()
            data, windows = batch.column(fields.index("data")), batch.column(fields.index("windows")).to_pylist()
            for k, size in enumerate(sizes):
                found = [0]
                if size in trees:
                    spans = [(w[-2], w[-1]) for w in windows[k]] or [(-np.inf, np.inf)]
                    found = visited(trees[size], unpack([data[k].as_py()], size)[0], spans)
                at += [k] * len(found)
                leaves += found
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(leaves, pa.int32())], names=[*fields, "leaf"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asks.schema) + ", leaf int"
    routed = asks.mapInArrow(run, schema)
    # one row per leaf of the trees and of other lengths
    return routed.join(chunks, ["dims", "leaf"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))


def with_windows(asks: DataFrame, samples: dict[int, Block], mine: Mine) -> DataFrame:
    """``asks`` with one window per positive: (number, id, score, lowest and highest product).

    Where enough rows of the sample lie in a window, its lower end is the score
    that they reach: what lies below cannot be among the first.
    """
    fields = [c for c in asks.columns if c != "nearest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for size, raw, label, near in zip(*(batch.column(c).to_pylist() for c in ("dims", "data", "anchor_label", "nearest"))):
                known, score = samples.get(size), np.empty(0, np.int64)
                if known is not None:
                    score = exact(unpack([raw], size), known.vectors)[0][known.labels != label]
                windows = []
                for p in near:
                    low, high = mine.window(p["score"])
                    inside = score[(score >= low) & (score <= high)]
                    if len(inside) >= mine.negatives:
                        low = int(np.partition(inside, len(inside) - mine.negatives)[len(inside) - mine.negatives])
                    if low <= high:
                        windows.append([p["number"], p["id"], p["score"], low, high])
                out.append(windows)
            kept = batch.select(fields)
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(out, pa.list_(pa.list_(pa.int64())))], names=[*fields, "windows"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asks.select(*fields).schema) + ", windows array<array<long>>"
    return asks.mapInArrow(run, schema).filter(F.size("windows") > 0)


def hard_negatives(
    vectors: DataFrame, anchor_every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    leaf_rows: int = LEAF_ROWS, least_chunk: int = LEAST_CHUNK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``vectors`` (vec_id, embedding, label).

    Scores are inner products of floor(256 x). An anchor is a row whose vec_id
    is divisible by ``anchor_every``; its positives are the first rows of its
    label, its negatives for a positive the first rows of other labels with
    ``low`` * positive_score <= 100 * negative_score <= ``high`` * positive_score.
    Rows with a NULL vec_id, label or vector, or with a NULL or non-finite
    component take no part, nor do vectors whose scores could pass 64 bits. Rows
    meet only rows of their own length. Every row stands for itself: rows that
    repeat a vec_id are others to each other, and repeated anchors return their
    answers each. Other columns are not read. An empty table gives no rows.
    Answers are exact; the tree decides only how much is compared.
    """
    mine = Mine(anchor_every, positives, negatives, low, high)
    usable = vectors.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    sizes = usable.groupBy(F.size("embedding").alias("dims")).count()
    common = sizes.filter("dims > 0").orderBy(F.desc("count"), "dims").first()
    trees: dict[int, Tree] = {}
    samples: dict[int, Block] = {}
    if common:
        dims, count = common
        drawn = hashed_sample(usable.filter(F.size("embedding") == dims).select("vec_id", "label", "embedding"), "vec_id", SAMPLE)
        known = placed_rows(drawn, {}).orderBy("id", "label", "vector").toArrow()
        data = unpack(known.column("vector").to_pylist(), dims)
        trees = {dims: grow(data, min(LEAVES, max(1, count // leaf_rows)))}
        samples = {dims: Block(*(known.column(c).to_numpy() for c in ("place", "id", "label")), data)}

    with small_batches(vectors.sparkSession, BATCH_ROWS):
        return _mined(vectors, trees, samples, mine, least_chunk)


def _mined(vectors: DataFrame, trees: dict[int, Tree], samples: dict[int, Block], mine: Mine, least_chunk: int) -> DataFrame:
    rows = materialize(placed_rows(vectors, trees), "placed")
    trees = with_ranges(trees, rows)
    by_leaf = rows.groupBy("dims", "leaf").agg(F.count(F.lit(1)).alias("rows"))
    chunk_rows = max(least_chunk, min(rows.count() // CHUNKS, MOST_CHUNK))
    fitting = F.greatest(F.lit(1), F.least(F.lit(chunk_rows), F.floor(F.lit(CHUNK_VALUES) / F.greatest("dims", F.lit(1)))))
    chunks = materialize(by_leaf.select("dims", "leaf", F.ceil(F.col("rows") / fitting).cast("int").alias("chunks")), "chunks")
    dealt = rows.join(chunks, ["dims", "leaf"]).withColumn("chunk", F.pmod(F.xxhash64("place"), F.col("chunks")).cast("int"))
    blocks = materialize(mine.blocks(dealt.drop("chunks")), "blocks")

    anchors = blocks.filter("anchor IS NOT NULL").select("dims", "data", "anchor", "anchor_id", "anchor_label", "bound")
    bounded = F.array(F.array("bound", F.lit((1 << 63) - 1)))
    windows = F.when(F.col("bound").isNotNull(), bounded).otherwise(F.array().cast("array<array<long>>")).alias("windows")
    asks = _routes(anchors.withColumn("windows", windows).drop("bound"), trees, chunks)
    near = materialize(_first(mine.search(blocks, asks, POSITIVE, mine.nearest), ["anchor"], mine.positives, "number"), "positives")
    # a few rows per anchor
    near = near.groupBy("anchor").agg(F.collect_list(F.struct("number", "id", "score")).alias("nearest"))
    asks = with_windows(anchors.drop("bound").join(near, "anchor"), samples, mine)
    hard = mine.search(blocks, _routes(asks, trees, chunks), NEGATIVE, mine.hardest)
    hard = materialize(_first(hard, ["anchor", "positive"], mine.negatives, "rank"), "negatives")
    return hard.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


OP12_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 10
"""


def op12_hyperplane_tree(spark, folder: str) -> DataFrame:
    return hard_negatives(table(spark, folder, "embeddings").select("vec_id", "embedding", "label"))
