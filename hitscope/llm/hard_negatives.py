"""Hard negatives by STR-packed R-trees, searched best first.

Vectors are sorted by tiles (slabs of one coordinate, each sorted by a second one) into
partitions of bounded size. A task packs its tile into an R-tree by sort-tile-recursive:
leaves of consecutive rows, nodes of consecutive leaves, each with its minimum bounding
box. For an anchor every box gives an interval of inner products, coordinate by coordinate.
Leaves are opened from the greatest upper bound downwards; boxes outside the score windows
or strictly below the least score that still counts are never opened. (Equal to it they are, for
ties.) Anchors are the queries; blocks of them meet every tile, many go down a tree at once, each
in its own order, and of each tile at most k rows a search go on to be merged.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hitscope.llm.common import save

#: Rows of a tile, anchors of a block, rows of a leaf, children of a node.
TILE, ANCHORS, LEAF, FANOUT = 8192, 4096, 64, 16
#: Anchors that go down a tree at once; bounds the memory of a task.
ABREAST = 256
#: Slabs of the coordinate that varies most, before each is sorted by the second one.
SLABS = 16
#: Below this squared norm every score, and every partial sum of one, is an exact double.
EXACT = 1 << 53


def str_order(points: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Order in which consecutive rows make leaves: sorted into slabs by one coordinate after the other, widest first."""
    axes = np.argsort(-points.var(axis=0), kind="stable") if len(points) else np.zeros(0, int)

    def tile(rows: np.ndarray, axis: int) -> np.ndarray:
        leaves = -(-len(rows) // leaf)
        if leaves <= 1 or axis == len(axes):
            return rows
        rows = rows[np.argsort(points[rows, axes[axis]], kind="stable")]
        slabs = int(np.ceil(leaves ** (1 / (len(axes) - axis))))
        size = leaf * -(-leaves // slabs)
        return np.concatenate([tile(rows[i : i + size], axis + 1) for i in range(0, len(rows), size)])

    return tile(np.arange(len(points)), 0)


class RTree:
    """Packed tree over the rows of one tile; ``levels`` are the boxes from the leaves up to the root."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, labels: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT):
        # Rows of a leaf ascend by id, so that the first of equal scores is the one that counts.
        order = str_order(points, leaf)
        order = order[np.lexsort((ids[order], np.arange(len(order)) // leaf))]
        self.points, self.ids, self.labels = points[order], ids[order], labels[order]
        self.leaf, self.fanout = leaf, fanout
        begins = np.arange(0, len(order), leaf)
        boxes = np.minimum.reduceat(self.points, begins), np.maximum.reduceat(self.points, begins)
        self.levels = [boxes]
        while len(boxes[0]) > 1:
            begins = np.arange(0, len(boxes[0]), fanout)
            boxes = np.minimum.reduceat(boxes[0], begins), np.maximum.reduceat(boxes[1], begins)
            self.levels.append(boxes)
        self.opened = 0  # leaves that searches have read

    def _intervals(self, level: int, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of every box of a level with every query."""
        low, high = self.levels[level]
        up, down = np.maximum(queries, 0).T, np.minimum(queries, 0).T
        # Corners may be longer than any row, so that sums of theirs are rounded.
        slack = np.maximum(-self.levels[-1][0][0], self.levels[-1][1][0]) @ (up - down) * queries.shape[1] * 2.0**-50
        return low @ up + high @ down - np.abs(slack), high @ up + low @ down + np.abs(slack)

    def search(self, query: np.ndarray, wanted, windows: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """``scores, ids`` of the first *k* rows for which *wanted*(labels, ids) holds, for each of the score *windows* (low, high)."""
        _, window, scores, ids = self.search_all(query[None, :], lambda labels, ids, _: wanted(labels, ids), windows[None, :, :], k)
        return [(scores[window == j], ids[window == j]) for j in range(len(windows))]

    def search_all(self, queries: np.ndarray, wanted, windows: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """``query, window, score, id`` of the first *k* rows in each score window of each query, first ones first.

        *windows* has (low, high) by query and number. *wanted*(labels, ids, queries) tells
        which rows (a column) count for which queries (their numbers, along the other axis).
        """
        floors, most = windows[:, :, 0].copy(), windows[:, :, 1]  # below its floor a row cannot count any more

        def useful(low: np.ndarray, high: np.ndarray, at) -> np.ndarray:
            return ((high[..., None] >= floors[at]) & (low[..., None] <= most[at])).any(axis=-1)

        alive = np.ones((1, len(queries)), bool)
        for level in range(len(self.levels) - 1, -1, -1):
            alive = np.repeat(alive, self.fanout, axis=0)[: len(self.levels[level][0])]
            low, high = self._intervals(level, queries)
            alive &= useful(low, high, slice(None))
        high[~alive] = -np.inf
        order = np.argsort(-high, axis=0, kind="stable")
        pool = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        begin, width = 0, 1
        while begin < len(order):
            leaf = order[begin : begin + width]
            query = np.broadcast_to(np.arange(len(queries)), leaf.shape)
            keep = alive[leaf, query] & useful(low[leaf, query], high[leaf, query], query)
            leaf, query = leaf[keep], query[keep]
            if not len(leaf) and not alive[order[begin:], np.arange(len(queries))].any():
                break
            self.opened += len(leaf)
            by = np.argsort(leaf, kind="stable")
            leaf, query = leaf[by], query[by]
            cuts = np.flatnonzero(np.diff(leaf)) + 1
            found = [pool]
            for node, at in zip(leaf[np.append(0, cuts)].tolist(), np.split(query, cuts)) if len(leaf) else ():
                rows = slice(node * self.leaf, (node + 1) * self.leaf)
                scores = self.points[rows] @ queries[at].T
                fits = wanted(self.labels[rows, None], self.ids[rows, None], at)
                row, column = np.nonzero(fits & (scores >= floors[at].min(axis=1)) & (scores <= most[at].max(axis=1)))
                found.append((at[column], scores[row, column], self.ids[rows][row]))
            pool = self._first(tuple(np.concatenate(x) for x in zip(*found)), floors, most, k)
            begin, width = begin + width, 2 * width
        own, score, ids = pool
        parts = []
        for j in range(windows.shape[1]):
            first = self._in_window(pool, floors, most, j, k)
            parts.append((own[first], np.full(len(first), j), score[first], ids[first]))
        return tuple(np.concatenate(x) for x in zip(*parts))

    @staticmethod
    def _in_window(pool: tuple[np.ndarray, ...], floors: np.ndarray, most: np.ndarray, j: int, k: int) -> np.ndarray:
        """Places of the first *k* rows of each query in its window *j*; *pool* is in order of query, score and id."""
        query, score, _ = pool
        fits = np.flatnonzero((score >= floors[query, j]) & (score <= most[query, j]))
        own = query[fits]
        return fits[np.arange(len(own)) - np.searchsorted(own, own) < k]

    def _first(self, pool: tuple[np.ndarray, ...], floors: np.ndarray, most: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """The rows of *pool* that are among the first *k* of a window, in order; raises the floors to the last of *k*."""
        by = np.lexsort((pool[2], -pool[1], pool[0]))
        pool = tuple(x[by] for x in pool)
        counts = np.zeros(len(pool[0]), bool)
        for j in range(floors.shape[1]):
            first = self._in_window(pool, floors, most, j, k)
            counts[first] = True
            own = pool[0][first]
            last = np.flatnonzero(np.arange(len(own)) - np.searchsorted(own, own) == k - 1)
            floors[own[last], j] = np.maximum(floors[own[last], j], pool[1][first[last]])
        return tuple(x[counts] for x in pool)


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part, components as whole numbers in doubles.

    Left out are rows whose id, label or vector is NULL and vectors with a NULL or non-finite component.
    Of rows that repeat an id the one with the smallest label, then vector, stays. A component x becomes
    floor(256 x); where 7 divides the id the label becomes the next of ten.
    """
    real = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col(column).cast("array<double>").alias("vector"),
    ).filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    one = real.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("row.label") + 1) % 10).otherwise(F.col("row.label"))
    # Spark's floor gives a BIGINT; x - x % 1 stays a double, however large x is.
    scaled = lambda x: x * 256.0 - F.pmod(x * 256.0, F.lit(1.0))
    return one.select("vec_id", label.alias("label"), F.transform("row.vector", scaled).alias("vector"))


def tiled(rows: DataFrame, tile: int) -> DataFrame:
    """*rows* with ``size`` (components) and ``tile``, saved; vectors of one size fill a range of tiles of about *tile* rows."""
    sized = save(rows.withColumn("size", F.size("vector")).withColumn("square", F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)), "vectors")
    at = lambda i: F.coalesce(F.get("vector", F.lit(i)), F.lit(0.0))
    n, largest = sized.agg(F.count("*"), F.max("square")).first()
    if largest is not None and largest >= EXACT:
        raise OverflowError(f"inner products may reach {largest:.3g}, beyond exact whole numbers in doubles")
    spread = sized.select(F.posexplode("vector").alias("axis", "x")).groupBy("axis").agg(F.var_pop("x").alias("spread"))
    widest = [row["axis"] for row in spread.orderBy(F.desc("spread"), "axis").limit(2).collect()]
    first, second = [*widest, 0, 0][:2]
    cuts = sized.select(F.percentile_approx(at(first), [i / SLABS for i in range(1, SLABS)], 1000)).first()[0] or []
    slab = sum((F.when(at(first) > cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    keyed = sized.withColumn("slab", slab).withColumn("along", at(second))
    ranges = keyed.repartitionByRange(max(1, -(-n // tile)), "size", "slab", "along", "vec_id")
    return save(ranges.drop("slab", "along", "square").withColumn("tile", F.spark_partition_id()), "tiles")


def _matrix(rows: pa.Table) -> np.ndarray:
    return rows.column("vector").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)


def _searched(tiles: DataFrame, queries: DataFrame, n_anchors: int, found, schema: str) -> DataFrame:
    """Columns that *found*(tree, some of the queries, their vectors) gives, for all *queries* and every tile of their size.

    *queries* have ``anchor_id, size, vector``. Blocks of ANCHORS of them meet the tiles of their
    size, each a row group of bounded size.
    """
    blocks = max(1, -(-n_anchors // ANCHORS))
    spans = tiles.groupBy("size").agg(F.min("tile").alias("low"), F.max("tile").alias("high"))
    block = F.pmod(F.xxhash64("anchor_id", F.lit(blocks)), F.lit(blocks)).cast("int")
    asked = queries.join(spans, "size").withColumn("block", block).withColumn("tile", F.explode(F.sequence("low", "high"))).drop("low", "high")
    asked = asked.toDF(*asked.columns)  # columns of its own, as both sides come from the same tiles
    held = tiles.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [[np.zeros(0, np.int64)] * len(names)]
        if left.num_rows and right.num_rows:
            tree = RTree(_matrix(left), left.column("vec_id").to_numpy(), left.column("label").to_numpy())
            points = _matrix(right)
            for low in range(0, right.num_rows, ABREAST):
                parts.append(found(tree, right.slice(low, ABREAST), points[low : low + ABREAST]))
        return pa.table({name: pa.array(np.concatenate(c), pa.int64()) for name, c in zip(names, zip(*parts))})

    names = [part.split()[0] for part in schema.split(", ")]
    keys = ["size", "tile", "block"]
    return held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(run, schema)


def _first(found: DataFrame, keys: list[str], item: str, score: str, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), item))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, tile: int = TILE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows for which *is_anchor* (on ``vec_id``) holds. A score is the inner product with the anchor,
    higher first, ties to the smaller id. An anchor's positives are its first rows of the same label, without itself;
    each gets its first rows of another label whose score is *low* to *high* hundredths of its own. A positive of
    negative score has none. Vectors meet those of their own length only. Rows that take part: see ``usable``;
    empty vectors score 0. A table without anchors, or empty, gives no rows. Other columns are not read. A table whose inner products could
    exceed 2^53 is refused with an OverflowError.
    """
    tiles = tiled(usable(vectors), tile)
    anchors = tiles.filter(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", "size", "vector")
    n_anchors = anchors.count()

    def near(tree, asked, points):
        own, label = asked.column("anchor_id").to_numpy(), asked.column("label").to_numpy()
        everything = np.broadcast_to([-np.inf, np.inf], (len(own), 1, 2))
        at, _, scores, ids = tree.search_all(points, lambda labels, ids, at: (labels == label[at]) & (ids != own[at]), everything, positives)
        return own[at], ids, scores.astype(np.int64)

    close = _searched(tiles, anchors, n_anchors, near, "anchor_id long, positive_id long, positive_score long")
    chosen = save(_first(close, ["anchor_id"], "positive_id", "positive_score", positives).drop("rank"), "positives")
    scores = chosen.filter("positive_score >= 0").groupBy("anchor_id").agg(F.collect_set("positive_score").alias("scores"))

    def between(tree, asked, points):
        own, label = asked.column("anchor_id").to_numpy(), asked.column("label").to_numpy()
        lists = asked.column("scores").to_pylist()
        # Whole numbers from low/100 to high/100 of the positive score; no score lies in the windows that fill up.
        windows = np.tile([np.inf, -np.inf], (len(own), max(map(len, lists)), 1))
        bases = np.zeros(windows.shape[:2], np.int64)
        for i, scores in enumerate(lists):
            for j, s in enumerate(sorted(scores)):
                windows[i, j], bases[i, j] = (-(-low * s // 100), high * s // 100), s
        at, j, scores, ids = tree.search_all(points, lambda labels, ids, at: (labels != label[at]) & (ids != own[at]), windows, negatives)
        return own[at], bases[at, j], ids, scores.astype(np.int64)

    asked = anchors.join(scores, "anchor_id")
    met = _searched(tiles, asked, n_anchors, between, "anchor_id long, positive_score long, negative_id long, negative_score long")
    ranked = _first(met, ["anchor_id", "positive_score"], "negative_id", "negative_score", negatives)
    return chosen.join(ranked, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


ORACLE_SQL = """
WITH rows AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""
