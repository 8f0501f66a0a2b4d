"""Exact top-k by inner product: best-first search in M-trees.

An inner product is no metric, so every vector x gets one more coordinate, the root of
M**2 - |x|**2, where M is the largest norm. Queries get 0 there. Then
D(q, x)**2 = |q|**2 + M**2 - 2 q.x is a squared Euclidean distance that falls as the inner product rises.

Vectors are dealt to the nearest of a few pivots, a pivot's vectors to trees of bounded
size, so that a vector that many rows repeat fills many trees. A tree has pages of routing vectors, each
with the radius that covers its subtree and the distance to the routing vector above; trees are built once and written as
a table. A block of queries goes through a tree together, pages in order of their least possible distance to any of them;
the stored distances rule out pages and vectors by the triangle inequality before their own distance is computed, for each
query by what it has found. The trees of a block's own pivot come first, so that most others are cut off at or near their roots.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written
from .vectors import best_of_each, matrix, packed, quantised


@dataclass(frozen=True)
class Settings:
    """pivots: rows that vectors are dealt to. tree: most vectors of a tree, on average. page: entries of
    a page. queries: queries of a block, on average."""

    pivots: int = 32
    tree: int = 2048
    page: int = 32
    queries: int = 256


#: The arrays of a tree, by name and type: of vectors in page order, and of pages.
_ARRAYS = {"rows": "<i8", "ids": "<i8", "vectors": "<i4", "near": "<f8", "routes": "<i4", "radius": "<f8", "above": "<f8", "leaf": "<i1", "first": "<i8", "last": "<i8"}


class Tree:
    """Arrays of pages. Page p: routing vector, radius, distance to the routing vector above, and the
    range of its children (pages) or of its vectors, which are stored in page order with their distance to
    its routing vector."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @classmethod
    def built(cls, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, top: float, page: int) -> Tree:
        lift = np.sqrt(np.maximum(0.0, top - (vectors**2).sum(1)))
        pages, order, near = _Pages(np.column_stack((vectors, lift)), page).made()
        order = np.concatenate(order)
        columns = {c: np.array([p[k] for p in pages]) for k, c in enumerate(("radius", "above", "leaf", "first", "last"), 1)}
        return cls({"rows": rows[order], "ids": ids[order], "vectors": vectors[order], "near": np.concatenate(near), "routes": vectors[[p[0] for p in pages]], **columns})

    def search(self, queries: np.ndarray, own: np.ndarray, least: np.ndarray, top: float, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(query, id, score) of the best k of each query that reach its `least`, and the distances computed.

        own: the query's own row, which is not found.
        """
        base = (queries**2).sum(1) + top
        slack = 1e-6 * (1 + np.sqrt(base))
        least = least.copy()
        reach = np.sqrt(np.maximum(0.0, base - 2 * np.maximum(least, -1e300))) + slack
        who, names, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        everyone = np.arange(len(queries))
        computed = len(queries)
        root = np.sqrt(np.maximum(0.0, base - 2 * (queries @ self.routes[0])))
        pages = [(float((root - self.radius[0]).min(initial=np.inf)), 0, everyone, root)]
        while pages:
            _, page, asking, away = heapq.heappop(pages)
            live = away - self.radius[page] <= reach[asking]
            if not live.any():
                continue
            asking, away = asking[live], away[live]
            first, last = self.first[page], self.last[page]
            if self.leaf[page]:
                may = np.abs(away[:, None] - self.near[first:last]) <= reach[asking, None]
                at = np.flatnonzero(may.any(0))
                if not len(at):
                    continue
                found = queries[asking] @ self.vectors[first + at].T
                computed += found.size
                good = (found >= least[asking, None]) & (self.rows[first + at] != own[asking, None])
                row, column = np.nonzero(good)
                if not len(row):
                    continue
                who, names = np.append(who, asking[row]), np.append(names, self.ids[first + at[column]])
                who, names, scores, full = best_of_each(who, names, np.append(scores, found[row, column]), k)
                least[who[full]] = np.maximum(least[who[full]], scores[full])
                reach[who[full]] = (np.sqrt(np.maximum(0.0, base - 2 * np.maximum(least, -1e300))) + slack)[who[full]]
                continue
            children = np.arange(first, last)
            may = np.abs(away[:, None] - self.above[children]) - self.radius[children] <= reach[asking, None]
            kept = may.any(0)
            children, may = children[kept], may[:, kept]
            found = np.sqrt(np.maximum(0.0, base[asking, None] - 2 * (queries[asking] @ self.routes[children].T)))
            computed += found.size
            may &= found - self.radius[children] <= reach[asking, None]
            for number, child in enumerate(children.tolist()):
                some = np.flatnonzero(may[:, number])
                if len(some):
                    bound = float(found[some, number].min() - self.radius[child])
                    heapq.heappush(pages, (bound, child, asking[some], found[some, number]))
        return who, names, scores, computed


class _Pages:
    """Builds the pages of a tree over lifted points."""

    def __init__(self, points: np.ndarray, page: int):
        self.points, self.page = points, page
        self.pages: list[list] = [[]]  # routing point, radius, distance above, is leaf, first, last
        self.order: list[np.ndarray] = []
        self.near: list[np.ndarray] = []
        self.placed = 0

    def made(self) -> tuple[list[list], list[np.ndarray], list[np.ndarray]]:
        rows = np.arange(len(self.points))
        self._fill(0, rows, self._distances(0, rows), 0, 0.0)
        return self.pages, self.order, self.near

    def _distances(self, route: int, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.points[rows] - self.points[route]) ** 2).sum(1))

    def _fill(self, number: int, rows: np.ndarray, distances: np.ndarray, route: int, above: float) -> None:
        radius = float(distances.max())
        if len(rows) <= self.page or radius == 0:
            self.pages[number] = [route, radius, above, True, self.placed, self.placed + len(rows)]
            nearest = np.argsort(distances, kind="stable")
            self.order.append(rows[nearest])
            self.near.append(distances[nearest])
            self.placed += len(rows)
            return
        # Routing points: each the farthest from those before.
        routes, tables = [route], [distances]
        least = distances
        while len(routes) < self.page:
            far = int(np.argmax(least))
            if least[far] == 0:
                break
            routes.append(int(rows[far]))
            tables.append(self._distances(routes[-1], rows))
            least = np.minimum(least, tables[-1])
        table = np.stack(tables)
        home = table.argmin(0)
        parts = [(r, np.flatnonzero(home == k), k) for k, r in enumerate(routes)]
        parts = [p for p in parts if len(p[1])]
        first = len(self.pages)
        self.pages[number] = [route, radius, above, False, first, first + len(parts)]
        self.pages += [[] for _ in parts]
        for j, (r, at, k) in enumerate(parts):
            self._fill(first + j, rows[at], table[k][at], r, float(distances[rows == r][0]) if (rows == r).any() else 0.0)


class Index:
    """Trees over all vectors, written once, and the search in them."""

    def __init__(self, embeddings: DataFrame, is_query: Column, id: str, vector: str, scale: float, settings: Settings):
        self.settings = settings
        marked = embeddings.withColumn("_q", F.coalesce(is_query, F.lit(False)))
        rows = marked.select(F.col(id).cast("long").alias("id"), F.col("_q").alias("query"), F.col(vector).cast("array<double>").alias("v"))
        rows = quantised(rows.filter("id is not null"), scale).withColumn("row", F.monotonically_increasing_id())
        rows = written(rows, "vectors")
        norm = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
        top, wide, asked = rows.agg(F.max(norm), F.max(F.size("v")), F.count(F.when(F.col("query"), True))).first()
        self.empty = not asked
        if self.empty:
            return
        self.top, self.width = top, max(1, wide)
        width = self.width
        # A bounded number of rows, the same ones in any run.
        pivots = rows.orderBy(F.xxhash64("id", "row"), "row").limit(settings.pivots).select("v").collect()
        pivots = matrix(pa.array([r["v"] for r in pivots], pa.list_(pa.int64())), width)
        lifted = np.column_stack((pivots, np.sqrt(np.maximum(0.0, top - (pivots**2).sum(1)))))

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(batch.column("v"), width)
                lift = np.sqrt(np.maximum(0.0, top - (x**2).sum(1)))
                dots = x @ lifted[:, :-1].T + lift[:, None] * lifted[:, -1]
                yield batch.append_column("pivot", pa.array((2 * dots - (lifted**2).sum(1)).argmax(1), pa.int32()))

        placed = written(rows.mapInArrow(deal, "id long, query boolean, v array<long>, row long, pivot int"), "placed")
        # One row for each pivot.
        counts = placed.groupBy("pivot").agg(F.count("*").alias("rows"), F.sum(F.col("query").cast("long")).alias("queries")).collect()
        counts = {r["pivot"]: (r["rows"], r["queries"]) for r in counts}
        parts = [[max(1, -(-counts.get(p, (0, 0))[k] // size)) for p in range(len(pivots))] for k, size in enumerate((settings.tree, settings.queries))]
        first = np.concatenate(([0], np.cumsum(parts[0]))).tolist()
        self.total = first[-1]
        pick = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("pivot") + 1)
        self.span = F.sequence(pick(first[:-1]), pick(first[1:]) - 1)
        tree = (pick(first[:-1]) + F.pmod(F.xxhash64("row"), pick(parts[0]))).cast("long")
        self.queries = placed.filter("query").withColumn("part", F.pmod(F.xxhash64("row", F.lit(1)), pick(parts[1])).cast("int")).drop("query")

        def build(group: pa.Table) -> pa.Table:
            x = matrix(group["v"].combine_chunks(), width)
            made = Tree.built(group["row"].to_numpy(), group["id"].to_numpy(), x, top, settings.page)
            return pa.table({"tree": group["tree"][:1]} | {c: packed(getattr(made, c), kind) for c, kind in _ARRAYS.items()})

        schema = "tree long, " + ", ".join(f"{c} binary" for c in _ARRAYS)
        trees = placed.select("row", "id", "v", tree.alias("tree")).groupBy("tree").applyInArrow(build, schema)
        self.trees = written(trees, "trees")
        # Tasks do far more than the bytes they read tell, so their number is fixed.
        context = embeddings.sparkSession
        self.tasks = max(int(context.conf.get("spark.sql.shuffle.partitions")), 2 * context.sparkContext.defaultParallelism)

    def best(self, k: int) -> DataFrame:
        """(row, query_id, rank, vec_id, score): the best k of each query."""
        near = written(self._searched(self.queries.withColumn("least", F.lit(None).cast("long")), self.span, k), "near")
        least = self._ranked(near, k).filter(F.col("rank") == k).select("row", F.col("score").alias("least"))
        rest = F.array_except(F.sequence(F.lit(0), F.lit(self.total - 1)), self.span)
        return self._ranked(near.union(self._searched(self.queries.join(least, "row", "left"), rest, k)), k)

    def _ranked(self, found: DataFrame, k: int) -> DataFrame:
        order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id"))
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    def _searched(self, queries: DataFrame, trees: Column, k: int) -> DataFrame:
        """The best of each query in each of the trees given for its pivot."""
        width, top = self.width, self.top

        def pack(group: pa.Table) -> pa.Table:
            group = group.combine_chunks()
            least = group["least"].combine_chunks().cast(pa.float64()).fill_null(-np.inf).to_numpy()
            x = matrix(group["v"].combine_chunks(), width)
            return pa.table(
                {"pivot": group["pivot"][:1], "q_rows": packed(group["row"].to_numpy(), "<i8"), "q_ids": packed(group["id"].to_numpy(), "<i8"), "q_least": packed(least, "<f8"), "q_vectors": packed(x, "<i4")}
            )

        blocks = queries.groupBy("pivot", "part").applyInArrow(pack, "pivot int, q_rows binary, q_ids binary, q_least binary, q_vectors binary")
        asked = blocks.select("q_rows", "q_ids", "q_least", "q_vectors", F.explode(trees.cast("array<long>")).alias("tree"))
        # Every tree is asked the stated queries, a block of them at a time.
        work = asked.repartition(self.tasks, "tree").join(self.trees.repartition(self.tasks, "tree"), "tree")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for n in range(batch.num_rows):
                    read = lambda column, kind: np.frombuffer(batch.column(column)[n].as_buffer(), kind)
                    arrays = {c: read(c, kind) for c, kind in _ARRAYS.items()}
                    for c in ("vectors", "routes"):
                        arrays[c] = arrays[c].reshape(-1, width).astype(float)
                    rows, names = read("q_rows", "<i8"), read("q_ids", "<i8")
                    queries = read("q_vectors", "<i4").reshape(-1, width).astype(float)
                    who, found, scores, _ = Tree(arrays).search(queries, rows, read("q_least", "<f8"), top, k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[who]), pa.array(names[who]), pa.array(found), pa.array(scores.astype(np.int64))], ["row", "query_id", "vec_id", "score"]
                    )

        return work.mapInArrow(run, "row long, query_id long, vec_id long, score long")


def top_k(embeddings: DataFrame, k: int, is_query: Column, id: str = "vec_id", vector: str = "embedding", scale: float = 256.0, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of each query, ties to the smaller id.

    Components are floor(scale * x). The rows for which is_query holds are the queries; all usable rows but the
    query's own are candidates. Rows that repeat an id, or an id and a vector, are rows like all others: each is found, and
    each has results of its own if it is a query. Rows without id, with a null vector, with a null or non-finite component, or so
    long that inner products leave 53 bits take no part. Vectors of different lengths are compared as if the shorter
    ended with zeros. Other columns are not read. An empty table gives no rows.
    """
    index = Index(embeddings, is_query, id, vector, scale, settings)
    if index.empty:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return index.best(k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
