"""Hard negatives by inner product, with cover trees over norm-augmented candidates.

Augmentation: with M the largest norm, a candidate x becomes (x, sqrt(M^2 - |x|^2)) and a
query q becomes (q, 0). Then q.x = (|q|^2 + M^2 - d^2) / 2, d being the distance of
the two, so balls around candidates bound inner products from both sides.

The tree's top level is a bounded number of cells around pivots, with the covering
radius that all rows of a cell need; rows go to their nearest pivot, and a great cell
is dealt into several chunks. Inside a chunk a node covers its rows by children of at
most half its radius, level by level. A search goes to the cells and then to the
nodes whose bounds meet one of its windows of scores, the best bound first, and
stops at nodes that cannot hold anything better than what is found; the rows of a
leaf are verified by exact integer products. A search of an anchor begins in the
anchor's own cell, whose finds narrow what the other cells are asked for.

Bounds carry a slack for rounding, so nothing is lost; scores are exact integers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.llm.common import batch_of
from assaylake.llm.vectors import SCALE, integer_vectors, matrix, products
from assaylake.session import release, settled

POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these hundredths of the positive's.
LEAST, MOST = 50, 95

#: Cells of the top level, at the most; rows that a chunk aims at; searches of a block.
MOST_CELLS, CHUNK_ROWS, BLOCK_ROWS = 256, 8192, 4096
#: Rows from which pivots are chosen.
PIVOT_SAMPLE = 4096
#: Rows that are verified without further levels, and children of a node at the most.
LEAF_ROWS, FAN = 64, 32
#: Scores taken at once.
_AT_ONCE = 1 << 21

NONE = np.iinfo(np.int64).min
_EVERY = np.iinfo(np.int64).max


def augmented(vectors: np.ndarray, most: float) -> np.ndarray:
    """The vectors with the component that gives all of them the norm sqrt(``most``)."""
    v = vectors.astype(np.float64)
    return np.c_[v, np.sqrt(np.maximum(0, most - (v * v).sum(1)))]


def bounds(queries: np.ndarray, most: float, centres: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner products with what the balls hold, a row for each query.

    ``centres`` are augmented, ``radii`` their covering radii.
    """
    q = queries.astype(np.float64)
    norm = (q * q).sum(1)[:, None]
    inner = q @ centres[:, :-1].T
    apart = np.sqrt(np.maximum(0, norm + most - 2 * inner))
    length, slack = np.sqrt(norm), 1e-9 * (norm + most + 1)
    near, far = np.maximum(0, apart - radii), apart + radii
    low = np.maximum((norm + most - far * far) / 2, inner - length * radii)
    high = np.minimum((norm + most - near * near) / 2, inner + length * radii)
    return low - slack, high + slack


class Node:
    """A ball around a candidate; ``rows`` if it is a leaf, else ``children``."""

    __slots__ = ("centre", "radius", "rows", "children")

    def __init__(self, centre: np.ndarray, radius: float):
        self.centre, self.radius = centre, radius
        self.rows: np.ndarray | None = None
        self.children: list[Node] = []


def build(points: np.ndarray) -> Node:
    """The tree over augmented points; every level has at most half the radius of the one above."""

    def distances(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
        away = points[rows] - centre
        return np.sqrt(np.einsum("ij,ij->i", away, away))

    rows = np.arange(len(points))
    first = points[0] if len(points) else np.zeros(points.shape[1])
    root = Node(first, float(distances(rows, first).max(initial=0)))
    todo = [(root, rows)]
    while todo:
        node, rows = todo.pop()
        if len(rows) <= LEAF_ROWS or node.radius == 0:
            node.rows = rows
            continue
        left, parts = rows, []
        while len(left) and len(parts) < FAN:
            centre = points[left[0]]
            away = distances(left, centre)
            inside = away <= node.radius / 2
            parts.append((Node(centre, float(away[inside].max(initial=0))), left[inside]))
            left = left[~inside]
        if len(left) > len(rows) // 2:  # balls of half the radius cover next to nothing here
            node.rows = rows
            continue
        node.children = [child for child, _ in parts]
        todo += parts
        if len(left):
            rest = Node(node.centre, float(distances(left, node.centre).max()))
            rest.rows = left
            node.children.append(rest)
    return root


class Best:
    """For every search and window the ``k`` best (score, place) so far; higher scores, then lower places."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.score = np.full((*low.shape, k), NONE)
        self.place = np.full((*low.shape, k), _EVERY)

    def wanted(self, searches: np.ndarray, least: np.ndarray, greatest: np.ndarray) -> np.ndarray:
        """Whether balls with these bounds may hold something better, for each search and ball."""
        floor = np.maximum(self.low[searches], self.score[searches, :, -1])[:, :, None]
        return ((greatest[:, None, :] >= floor) & (least[:, None, :] <= self.high[searches][:, :, None])).any(1)

    def take(self, searches: np.ndarray, scores: np.ndarray, allowed: np.ndarray, places: np.ndarray) -> None:
        for w in range(self.low.shape[1]):
            low, high = self.low[searches, w, None], self.high[searches, w, None]
            left = np.where(allowed & (scores >= low) & (scores <= high), scores, NONE)
            found, where = [self.score[searches, w]], [self.place[searches, w]]
            line = np.arange(len(searches))
            for _ in range(min(self.k, scores.shape[1])):
                at = left.argmax(1)  # the first of equal scores, which has the lowest place
                best = left[line, at]
                if (best == NONE).all():
                    break
                found.append(best[:, None])
                where.append(np.where(best == NONE, _EVERY, places[at])[:, None])
                left[line, at] = NONE
            score, place = np.concatenate(found, 1), np.concatenate(where, 1)
            order = np.lexsort((place, ~score))[:, : self.k]
            self.score[searches, w] = np.take_along_axis(score, order, 1)
            self.place[searches, w] = np.take_along_axis(place, order, 1)


def descend(
    root: Node, vectors: np.ndarray, uid: np.ndarray, label: np.ndarray, most: float,
    queries: np.ndarray, query_uid: np.ndarray, query_label: np.ndarray, best: Best, same: bool,
) -> int:
    """Fill ``best`` from the tree, the node of the greatest bound first; the number of rows verified."""
    verified, ticket = 0, count()
    everyone = np.arange(len(queries))
    todo = [(0.0, next(ticket), root, everyone)]
    while todo:
        _, _, node, searches = heapq.heappop(todo)
        low, high = bounds(queries[searches], most, node.centre[None, :], np.array([node.radius]))
        searches = searches[best.wanted(searches, low, high)[:, 0]]
        if not len(searches):
            continue
        if node.rows is None:
            centres = np.stack([c.centre for c in node.children])
            low, high = bounds(queries[searches], most, centres, np.array([c.radius for c in node.children]))
            wanted = best.wanted(searches, low, high)
            for at, child in enumerate(node.children):
                mine = wanted[:, at]
                if mine.any():
                    heapq.heappush(todo, (-float(high[mine, at].max()), next(ticket), child, searches[mine]))
            continue
        rows = np.sort(node.rows)
        step = max(1, _AT_ONCE // len(rows))
        for at in range(0, len(searches), step):
            part = searches[at : at + step]
            equal = query_label[part, None] == label[rows]
            allowed = equal & (query_uid[part, None] != uid[rows]) if same else ~equal
            best.take(part, products(queries[part], vectors[rows]), allowed, rows)
        verified += len(rows) * len(searches)
    return verified


class Cells:
    """The top level: pivots, and what the rows of each cell need. Bounded by ``MOST_CELLS``."""

    def __init__(self, pivots: np.ndarray, most: float, dims: int):
        self.pivots, self.most, self.dims = augmented(pivots, most), most, dims
        self.radii = np.zeros(len(pivots))
        self.chunks = np.ones(len(pivots), np.int64)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each vector, and the distance to its pivot (never too small)."""
        points = augmented(vectors, self.most)
        square = (points * points).sum(1)[:, None] + (self.pivots * self.pivots).sum(1) - 2 * points @ self.pivots.T
        cell = square.argmin(1)
        away = points - self.pivots[cell]
        return cell, np.sqrt((away * away).sum(1)) * (1 + 1e-12)


def choose_cells(rows: DataFrame) -> Cells | None:
    """Pivots far from each other, among a bounded sample; None for an empty table."""
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, most, dims = rows.agg(F.count(F.lit(1)), F.max(square), F.max(F.size("v"))).first()
    if not n:
        return None
    dims = max(1, dims)
    sample = rows.select("v", F.xxhash64("v", "uid").alias("h")).orderBy("h").limit(PIVOT_SAMPLE).collect()
    vectors = np.array([[*r["v"], *[0] * (dims - len(r["v"]))] for r in sample], np.int64)
    points = augmented(vectors, most)
    chosen, away = [0], np.full(len(points), np.inf)
    for _ in range(min(MOST_CELLS, -(-n // CHUNK_ROWS)) - 1):
        away = np.minimum(away, ((points - points[chosen[-1]]) ** 2).sum(1))
        chosen.append(int(away.argmax()))
    return Cells(vectors[chosen], most, dims)


def deal(rows: DataFrame, cells: Cells) -> DataFrame:
    """Adds ``cell``, written out; fills in the radii and chunks of ``cells``."""
    held = rows.sparkSession.sparkContext.broadcast(cells)
    schema = pa.schema([
        ("uid", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int64()), ("v", pa.list_(pa.int64())),
        ("cell", pa.int32()), ("away", pa.float64()),
    ])

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = matrix(batch["v"], held.value.dims)
                cell, away = held.value.nearest(vectors)
                yield batch_of(schema, [
                    batch["uid"], batch["vec_id"], batch["label"], list(vectors), cell.astype(np.int32), away,
                ])

    dealt = settled(
        rows.select("uid", "vec_id", "label", "v").mapInArrow(
            assign, "uid long, vec_id long, label long, v array<long>, cell int, away double"
        ),
        "dealt",
    )
    for r in dealt.groupBy("cell").agg(F.max("away").alias("r"), F.count(F.lit(1)).alias("n")).collect():
        cells.radii[r["cell"]] = r["r"]
        cells.chunks[r["cell"]] = -(-r["n"] // CHUNK_ROWS)
    return dealt


_ASKED = (
    "uid long, label long, v array<long>, lows array<long>, highs array<long>, own int, block int, cell int, chunk int"
)
_FOUND = "uid long, w int, score long, vec_id long, found long"


def _asked(searches: DataFrame, cells: Cells, own: bool) -> DataFrame:
    """The searches, once for each chunk that may hold something for them; in the own cell, or in all others."""
    held = searches.sparkSession.sparkContext.broadcast(cells)
    names = [c.split()[0] for c in _ASKED.split(", ")]

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            mine = batch["own"].to_numpy()
            if own:
                row, cell = np.arange(len(mine)), mine
            else:
                width = len(batch["lows"][0])
                best = Best(matrix(batch["lows"], width), matrix(batch["highs"], width), 1)
                every = np.arange(len(mine))
                wanted = best.wanted(every, *bounds(matrix(batch["v"], cells.dims), cells.most, cells.pivots, cells.radii))
                wanted[every, mine] = False
                row, cell = np.nonzero(wanted)
            times = cells.chunks[cell]
            row, cell = np.repeat(row, times), np.repeat(cell, times)
            chunk = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(cell, pa.int32()), pa.array(chunk, pa.int32())], names
            )

    return searches.select(names[:-2]).mapInArrow(route, _ASKED)


def _search(searches: DataFrame, dealt: DataFrame, cells: Cells, k: int, same: bool, own: bool) -> DataFrame:
    """``uid, w, score, vec_id, found``: the ``k`` best of each chunk for every search and window."""
    spark = dealt.sparkSession
    chunks = spark.sparkContext.broadcast(cells)
    asked = settled(_asked(searches, cells, own), "asked")
    # a chunk goes to as many tasks as blocks of searches ask for it
    where = asked.select("cell", "chunk", "block").distinct().toDF("cell", "chunk", "block")
    per_cell = F.lit(cells.chunks.tolist())
    rows = dealt.withColumn(
        "chunk", F.pmod(F.xxhash64("uid"), F.get(per_cell, F.col("cell"))).cast("int")
    ).select("uid", "vec_id", "label", "v", "cell", "chunk")
    rows = rows.join(where, ["cell", "chunk"])
    schema = pa.schema([
        ("uid", pa.int64()), ("w", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64()), ("found", pa.int64()),
    ])

    def look(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return schema.empty_table()
        cells = chunks.value
        rows = rows.sort_by([("vec_id", "ascending"), ("uid", "ascending")])
        column = lambda t, name: t[name].combine_chunks()
        vectors = matrix(column(rows, "v"), cells.dims)
        uid, vec_id, label = (column(rows, c).to_numpy() for c in ("uid", "vec_id", "label"))
        width = len(queries["lows"][0])
        best = Best(matrix(column(queries, "lows"), width), matrix(column(queries, "highs"), width), k)
        asking = column(queries, "uid").to_numpy()
        descend(
            build(augmented(vectors, cells.most)), vectors, uid, label, cells.most,
            matrix(column(queries, "v"), cells.dims), asking, column(queries, "label").to_numpy(), best, same,
        )
        q, w, at = np.nonzero(best.place != _EVERY)
        place = best.place[q, w, at]
        return pa.table([asking[q], w.astype(np.int32), best.score[q, w, at], vec_id[place], uid[place]], schema=schema)

    by = ["cell", "chunk", "block"]
    found = settled(asked.groupBy(*by).cogroup(rows.groupBy(*by)).applyInArrow(look, _FOUND), "found")
    release(asked)
    return found


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each search and window, with ``rank`` from 1."""
    order = Window.partitionBy("uid", "w").orderBy(F.desc("score"), "vec_id", "found")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def best_in_windows(searches: DataFrame, dealt: DataFrame, cells: Cells, k: int, same: bool) -> DataFrame:
    """``uid, w, score, vec_id, found, rank``: the ``k`` best rows in each of a search's windows.

    ``searches`` has ``uid, label, v, lows, highs, own``: window w takes scores from ``lows[w]``
    to ``highs[w]``; candidates are the other rows of the same label, or all of
    other labels. Every search looks into its own cell first; the k-th score found there
    raises the lower ends of its windows for all other cells.
    """
    n = searches.count()
    searches = searches.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(max(1, -(-n // BLOCK_ROWS)))).cast("int"))
    first = _search(searches, dealt, cells, k, same, own=True)
    kth = _ranked(first, k).filter(F.col("rank") == k).groupBy("uid").agg(
        F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("kth")
    )
    raised = F.transform("lows", lambda low, w: F.greatest(low, F.coalesce(F.element_at("kth", w), low)))
    narrowed = searches.join(kth, "uid", "left").withColumn("lows", F.when(F.col("kth").isNull(), F.col("lows")).otherwise(raised))
    return _ranked(first.unionByName(_search(narrowed, dealt, cells, k, same, own=False)), k)


def hard_negatives(
    rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    least: int = LEAST, most: int = MOST,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``vec_id, label, v`` with integer vectors; ``anchor`` tells which of
    them are anchors. An anchor's positives are its ``positives`` best other rows of
    the same label, by inner product, ties by smaller vec_id. For each of them the
    ``negatives`` best rows of other labels are returned whose score is between
    ``least`` and ``most`` hundredths of the positive's.

    Rows with a null id or label take no part. Every row is a row of its own: a
    repeated id can be its own positive, and a repeated anchor is answered each
    time. Shorter vectors are continued with zeros. Scores beyond a long count as the nearest
    long. Anchors without positives, or positives without negatives, give no rows, nor
    does an empty table. Other columns are not read.
    """
    kept = settled(
        rows.filter("vec_id is not null and label is not null").select(
            F.monotonically_increasing_id().alias("uid"), "vec_id", "label", "v"
        ),
        "rows",
    )
    cells = choose_cells(kept)
    if cells is None:
        return kept.select(
            F.col("vec_id").alias("anchor_id"), F.col("vec_id").alias("positive_id"), F.lit(0).alias("rank"),
            F.col("vec_id").alias("negative_id"), F.col("label").alias("positive_score"),
            F.col("label").alias("negative_score"),
        )
    dealt = deal(kept, cells)
    release(kept)
    anchors = dealt.filter(anchor).select("uid", "vec_id", "label", "v", F.col("cell").alias("own"))
    every = anchors.withColumn("lows", F.array(F.lit(int(NONE) + 1))).withColumn("highs", F.array(F.lit(int(_EVERY))))
    positive = settled(
        best_in_windows(every, dealt, cells, positives, same=True).select(
            "uid", (F.col("rank") - 1).alias("w"), F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ),
        "positives",
    )
    # whole numbers n with least * p <= 100 n <= most * p
    hundredths = lambda p, h: p.cast("decimal(38,0)") * h
    up = lambda x: F.ceil(x / 100).cast("long")
    down = lambda x: F.floor(x / 100).cast("long")
    windows = positive.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("w", "positive_score"))).alias("p"))
    # a window that takes nothing, as no score is above the one end and below the other
    empty = F.struct(F.lit(int(_EVERY)).alias("low"), F.lit(int(NONE) + 1).alias("high"))

    def window(x: Column) -> Column:
        low, high = up(hundredths(x["positive_score"], least)), down(hundredths(x["positive_score"], most))
        return F.when(low <= high, F.struct(low.alias("low"), high.alias("high"))).otherwise(empty)

    # all searches of a batch have as many windows
    ends = F.concat(F.transform("p", window), F.array_repeat(empty, positives - F.size("p")))
    windows = windows.select("uid", ends.alias("ends")).select(
        "uid", F.col("ends.low").alias("lows"), F.col("ends.high").alias("highs")
    )
    found = best_in_windows(anchors.join(windows, "uid"), dealt, cells, negatives, same=False)
    return (
        found.join(positive, ["uid", "w"])
        .join(anchors.select("uid", F.col("vec_id").alias("anchor_id")), "uid")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )


def mine(embeddings: DataFrame, every: int = 50, moved: int = 7, labels: int = 10, scale: int = SCALE) -> DataFrame:
    """``hard_negatives`` of ``vec_id, embedding, label``; every 50th id is an anchor.

    Rows with a null label, a null vector or a null or non-finite component take no
    part. Where the id is divisible by 7 the label is first moved on by one of ten.
    A component x counts as floor(scale * x), cut off at 2^53.
    """
    label = F.when(F.col("vec_id") % moved == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return hard_negatives(integer_vectors(embeddings, scale).withColumn("label", label), F.col("vec_id") % every == 0)
