"""Hard negatives for anchors, from lists that clusters of anchors share.

Anchors are clustered by direction. For a cluster with centroid c, whose members lie within the angle t of c, an inner
product of a member u with a candidate x is at most |u| |x| cos(max(0, angle(c, x) - t)). So the candidates are sorted once
for all members by |x| cos(...), and every member walks that list, scoring candidates a few hundred
at a time, until the bound of what follows cannot beat what it has found: a certified end.

A walker looks for its best k candidates within a range of scores and with its own or another label. The positives of an
anchor are one walker, the negatives of each positive another. On the cluster, candidates are dealt to blocks by direction, and a
group of anchors meets a block at a time. The blocks of the group's own cluster come first; what is
found there ends most other walks early.
"""

from __future__ import annotations

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
    """clusters: of anchors, at most. sample: most anchors that the centroids are learnt from. members: anchors of a group,
    block: candidates of a block, on average. chunk: candidates that are scored at a time."""

    clusters: int = 16
    sample: int = 4096
    members: int = 256
    block: int = 4096
    chunk: int = 512


def usable(embeddings: DataFrame, id: str, vector: str, label: Column, is_anchor: Column, scale: float) -> DataFrame:
    """(id, label, anchor, v) with v = floor(scale * component), of the rows that take part."""
    rows = embeddings.withColumns({"_l": label.cast("long"), "_a": F.coalesce(is_anchor, F.lit(False))})
    rows = rows.select(F.col(id).cast("long").alias("id"), F.col("_l").alias("label"), F.col("_a").alias("anchor"), F.col(vector).cast("array<double>").alias("v"))
    return quantised(rows.filter("id is not null and label is not null"), scale)


def _directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.sqrt((x * x).sum(1))
    return x / np.maximum(lengths, 1e-300)[:, None], lengths


def centroids(sample: np.ndarray, clusters: int, rounds: int = 8) -> np.ndarray:
    """Directions of at most `clusters` groups of the sample, one at least."""
    units = np.unique(_directions(sample)[0], axis=0)
    found = units[:: max(1, -(-len(units) // clusters))][:clusters]
    for _ in range(rounds):
        home = (units @ found.T).argmax(1)
        sums = np.zeros_like(found)
        np.add.at(sums, home, units)
        means, lengths = _directions(sums)
        found = np.where(lengths[:, None] > 1e-9, means, found)
    return found


def angles(x: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(angle to the centroid, length) of each vector."""
    units, lengths = _directions(x)
    return np.arccos(np.clip(units @ centre, -1, 1)), lengths


@dataclass
class Walkers:
    """vectors, rows and labels of anchors; by walker its anchor, range of scores, whether it wants the anchor's label, and
    a score that k candidates are known to reach."""

    vectors: np.ndarray
    rows: np.ndarray
    labels: np.ndarray
    owner: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: np.ndarray
    known: np.ndarray


def walk(w: Walkers, centre: np.ndarray, x: np.ndarray, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, k: int, chunk: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(walker, candidate id, score) of the best k of each walker among the candidates x, and how many were scored.

    Of candidates below `known` none need be found. Ties go to smaller ids.
    """
    wide, lengths = angles(w.vectors, centre)
    away, sizes = angles(x, centre)
    bounds = sizes * np.cos(np.clip(away - wide.max(initial=0.0), 0, np.pi))
    order = np.argsort(-bounds, kind="stable")
    least = np.maximum(w.low, w.known)
    who, names, scores, scored = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), 0
    for start in range(0, len(order), chunk):
        reach = bounds[order[start]] * lengths
        active = np.flatnonzero(reach[w.owner] + 1e-9 * np.abs(reach[w.owner]) + 1e-6 >= least)
        if not len(active):
            break
        part = order[start : start + chunk]
        anchors, at = np.unique(w.owner[active], return_inverse=True)
        found = (w.vectors[anchors] @ x[part].T)[at]
        scored += len(anchors) * len(part)
        owner = w.owner[active]
        good = (found >= least[active, None]) & (found <= w.high[active, None])
        good &= (labels[part] == w.labels[owner, None]) == w.same[active, None]
        good &= rows[part] != w.rows[owner, None]
        if len(part) > k:
            # No more than the best k of the chunk, with ties.
            good &= found >= np.partition(np.where(good, found, -np.inf), -k, axis=1)[:, -k, None]
        row, column = np.nonzero(good)
        who, names, scores = np.append(who, active[row]), np.append(names, ids[part[column]]), np.append(scores, found[row, column])
        who, names, scores, full = best_of_each(who, names, scores, k)
        least[who[full]] = np.maximum(least[who[full]], scores[full])
    return who, names, scores, scored


class Search:
    """Candidates in blocks, and the search for the best of them."""

    def __init__(self, rows: DataFrame, settings: Settings):
        self.settings = settings
        spark = rows.sparkSession
        self.rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "embeddings")
        width = self.rows.agg(F.max(F.size("v"))).first()[0]
        anchors = self.rows.filter("anchor")
        sample = anchors.orderBy(F.xxhash64("id", "row"), "row").limit(settings.sample).select("v").collect()
        self.empty = not sample
        if self.empty:
            return
        self.width = max(1, width)
        self.centres = centroids(matrix(pa.array([r["v"] for r in sample], pa.list_(pa.int64())), self.width), settings.clusters)
        centres, wide = self.centres, self.width

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                home = (matrix(batch.column("v"), wide) @ centres.T).argmax(1)
                yield batch.append_column("cluster", pa.array(home, pa.int32()))

        dealt = written(self.rows.mapInArrow(deal, "id long, label long, anchor boolean, v array<long>, row long, cluster int"), "dealt")
        # One row for each cluster.
        counts = {r["cluster"]: (r["rows"], r["anchors"]) for r in dealt.groupBy("cluster").agg(F.count("*").alias("rows"), F.sum(F.col("anchor").cast("long")).alias("anchors")).collect()}
        parts = [[max(1, -(-counts.get(c, (0, 0))[k] // size)) for c in range(len(centres))] for k, size in enumerate((settings.block, settings.members))]
        first = np.concatenate(([0], np.cumsum(parts[0]))).tolist()
        self.total = first[-1]
        pick = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)
        self.span = F.sequence(pick(first[:-1]), pick(first[1:]) - 1)
        block = pick(first[:-1]) + F.pmod(F.xxhash64("row"), pick(parts[0]))
        self.anchors = dealt.filter("anchor").withColumn("part", F.pmod(F.xxhash64("row", F.lit(1)), pick(parts[1])).cast("int")).drop("anchor")

        def gather(group: pa.Table) -> pa.Table:
            group = group.combine_chunks()
            x = matrix(group["v"].combine_chunks(), wide)
            return pa.table({"block": group["block"][:1], "rows": packed(group["row"].to_numpy(), "<i8"), "ids": packed(group["id"].to_numpy(), "<i8"), "labels": packed(group["label"].to_numpy(), "<i8"), "x": packed(x, "<i4")})

        blocks = dealt.select("row", "id", "label", "v", block.cast("long").alias("block"))
        self.blocks = written(blocks.groupBy("block").applyInArrow(gather, "block long, rows binary, ids binary, labels binary, x binary"), "blocks")
        # Tasks do far more than the bytes they read tell, so their number is fixed.
        self.tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)

    def best(self, walkers: DataFrame, k: int) -> DataFrame:
        """(row, walker, rank, id, score): the best k candidates of each walker (row, walker, low, high, same).

        low and high are inclusive and may be null; same asks for the anchor's own label, or for any other.
        """
        walkers = walkers.withColumn("known", F.lit(None).cast("long"))
        near = written(self._walked(walkers, self.span, k), "near")
        known = self._ranked(near, k).filter(F.col("rank") == k).select("row", "walker", F.col("score").alias("known"))
        rest = F.array_except(F.sequence(F.lit(0), F.lit(self.total - 1)), self.span)
        far = self._walked(walkers.drop("known").join(known, ["row", "walker"], "left"), rest, k)
        return self._ranked(near.union(far), k)

    def _ranked(self, found: DataFrame, k: int) -> DataFrame:
        order = Window.partitionBy("row", "walker").orderBy(F.col("score").desc(), F.col("id"))
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    def _walked(self, walkers: DataFrame, blocks: Column, k: int) -> DataFrame:
        """The best of each walker in each of the blocks given for its anchor's cluster."""
        width, centres, chunk = self.width, self.centres, self.settings.chunk
        odd = float("inf")

        def pack(group: pa.Table) -> pa.Table:
            group = group.sort_by("row").combine_chunks()
            rows = group["row"].to_numpy()
            first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
            one = group.take(pa.array(first))
            columns = {"rows": rows[first], "labels": one["label"].to_numpy(), "owner": np.searchsorted(first, np.arange(len(rows)), "right") - 1, "walker": group["walker"].to_numpy()}
            bounds = {c: group[c].combine_chunks().cast(pa.float64()).fill_null(x).to_numpy() for c, x in (("low", -odd), ("high", odd), ("known", -odd))}
            return pa.table(
                {"cluster": group["cluster"][:1]}
                | {c: packed(v, "<i8") for c, v in columns.items()}
                | {c: packed(v, "<f8") for c, v in bounds.items()}
                | {"same": packed(group["same"].to_numpy(zero_copy_only=False), "<i1"), "u": packed(matrix(one["v"].combine_chunks(), width), "<i4")}
            )

        names = ["rows", "labels", "owner", "walker", "low", "high", "known", "same", "u"]
        schema = "cluster int, " + ", ".join(f"{c} binary" for c in names)
        groups = self.anchors.join(walkers, "row").groupBy("cluster", "part").applyInArrow(pack, schema)
        groups = groups.select("cluster", *(F.col(c).alias(f"a_{c}") for c in names), F.explode(blocks.cast("array<long>")).alias("block"))
        work = groups.repartition(self.tasks, "block").join(self.blocks.repartition(self.tasks, "block"), "block")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for n in range(batch.num_rows):
                    read = lambda column, kind: np.frombuffer(batch.column(column)[n].as_buffer(), kind)
                    w = Walkers(
                        read("a_u", "<i4").reshape(-1, width).astype(float), *(read(f"a_{c}", "<i8") for c in ("rows", "labels", "owner")),
                        *(read(f"a_{c}", "<f8") for c in ("low", "high")), read("a_same", "<i1").astype(bool), read("a_known", "<f8"),
                    )
                    x = read("x", "<i4").reshape(-1, width).astype(float)
                    who, found, scores, _ = walk(w, centres[batch.column("cluster")[n].as_py()], x, read("rows", "<i8"), read("ids", "<i8"), read("labels", "<i8"), k, chunk)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(read("a_rows", "<i8")[w.owner[who]]), pa.array(read("a_walker", "<i8")[who]), pa.array(found), pa.array(scores.astype(np.int64))],
                        ["row", "walker", "id", "score"],
                    )

        return work.mapInArrow(run, "row long, walker long, id long, score long")


def mine(embeddings: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, id: str = "vec_id", vector: str = "embedding", scale: float = 256.0, settings: Settings = Settings()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are the `positives` other rows of its label with the largest inner products; a positive's
    negatives are the `negatives` rows of other labels with the largest ones among those from least % to
    most % of the positive's. Ties go to smaller ids. Components are floor(scale * x).

    Rows without id or label, with a null vector, with a null or non-finite component, or so long that inner products
    leave 53 bits take no part. Rows that repeat an id, or all else, are rows like all others: candidates but for the anchor itself, and
    anchors each for itself. Vectors of different lengths are compared as if the shorter ended with zeros. Other columns are not
    read. An empty table gives no rows.
    """
    search = Search(usable(embeddings, id, vector, label, is_anchor, scale), settings)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if search.empty:
        return embeddings.sparkSession.createDataFrame([], schema)
    everything = {c: F.lit(None).cast("long") for c in ("low", "high")}
    wanted = search.anchors.select("row", F.lit(0).cast("long").alias("walker")).withColumns({**everything, "same": F.lit(True)})
    best = search.best(wanted, positives).select("row", F.col("rank").cast("long").alias("walker"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    best = written(best, "positives")
    # Whole hundredths, rounded inwards in integers.
    low = F.expr(f"(positive_score * {least} + pmod(-positive_score * {least}, 100)) div 100")
    high = F.expr(f"(positive_score * {most} - pmod(positive_score * {most}, 100)) div 100")
    windows = best.select("row", "walker", low.alias("low"), high.alias("high"), F.lit(False).alias("same")).filter("low <= high")
    found = search.best(windows, negatives).select("row", "walker", F.col("rank").cast("int"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = search.anchors.select("row", F.col("id").alias("anchor_id"))
    return found.join(best, ["row", "walker"]).join(names, "row").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
