"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

1. One pass counts, for every shingle, the texts that hold it, in a count-min sketch of
   fixed size (its rows are hashed; the mean load of a cell is taken off an estimate).
2. A second pass weighs the shingles of each text (occurrences times idf) and draws
   consistent weighted samples: sample k of a text is a (shingle, level) pair, and two
   texts agree on it with the probability of their weighted Jaccard similarity.
3. Samples are banded. Within each bucket the texts are first compared with the one whose
   buckets hold most texts, which is what copies of one text have in common; what is linked
   by that is one group, so that a large group of copies costs one comparison a text.
4. Buckets that still hold several groups are compared in full across groups, in blocks, by further
   samples of one byte each. Texts that may be alike by those make clusters, within which all
   pairs across groups are verified, again in blocks. Tasks hand over forests of links only, so the
   rows between steps grow with the texts and not with their pairs.
5. All links are verified by the exact weighted Jaccard similarity, and joined to classes.

Texts are compared once each: exact copies share the node of their text.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .links import Joined, components
from .runs import whole_runs
from .sums import vector_sum
from .tables import discarded, text_key, written
from .texts import blocks, counted, folded, mixed, shingles, words

STRATA = 1 << 16


@dataclass(frozen=True)
class Settings:
    """size: words of a shingle; threshold: weighted Jaccard similarity of a link.

    bands and rows: a pair at the threshold is missed with probability (1 - t**rows)**bands.
    idf_share: how much of a weight depends on rarity. A group of copies makes its own
    shingles common, so a full idf would hide large groups; weights lie in [1, 1 + idf_share].
    cell_bits: log2 of the cells in each of the two rows of the count-min sketch.
    fine: further samples, by which pairs are chosen that are worth verifying.
    slack: how far the share of equal ones may lie below the threshold (3.5 standard deviations).
    """

    size: int = 5
    threshold: float = 0.8
    bands: int = 12
    rows: int = 3
    idf_share: float = 0.25
    cell_bits: int = 18
    fine: int = 192
    slack: float = 0.1
    seed: int = 7

    @property
    def samples(self) -> int:
        return self.bands * self.rows


def _shingled(batches: Iterator[pa.RecordBatch], size: int):
    for block in blocks(batches):
        hashes, _, offsets = words(*folded(block))
        yield block, counted(*shingles(hashes, offsets, size))


def _cells(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    low = hashes & np.uint64((1 << bits) - 1)
    high = (hashes >> np.uint64(44 - bits)) & np.uint64((1 << bits) - 1)
    return low.astype(np.int64), high.astype(np.int64) + (1 << bits)


def document_frequencies(documents: DataFrame, settings: Settings) -> np.ndarray:
    """Cells of the count-min sketch over all texts; its size is fixed by the settings."""
    cells, size, bits = 2 << settings.cell_bits, settings.size, settings.cell_bits

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(cells, np.int64)
        for _, (_, hashes, _) in _shingled(batches, size):
            for row in _cells(hashes, bits):
                total += np.bincount(row, minlength=cells)
        return total

    return vector_sum(documents.select("text"), cells, count)


def shingle_weights(hashes: np.ndarray, counts: np.ndarray, cells: np.ndarray, texts: int, settings: Settings) -> np.ndarray:
    """Occurrences times 1 + idf_share * ln((1 + texts) / (1 + df)) / ln(1 + texts)."""
    width = 1 << settings.cell_bits
    load = cells[:width].sum() / width
    first, second = _cells(hashes, settings.cell_bits)
    frequency = np.clip(np.minimum(cells[first], cells[second]) - load, 1, texts)
    idf = np.log((1 + texts) / (1 + frequency)) / math.log(1 + max(texts, 1))
    return (counts * (1 + settings.idf_share * idf)).astype(np.float32)


class Sampler:
    """Consistent weighted samples: for sample k a shingle draws r and c from Gamma(2, 1) and b from [0, 1).

    With t = floor(ln w / r + b), the shingle with the least ln c - r (t - b + 1) is the
    sample, together with its t. The draws come from a table of strata that k and the
    shingle's hash choose; equal values are told apart by the hash.
    """

    def __init__(self, samples: int, seed: int):
        random = np.random.Generator(np.random.PCG64(seed))
        r, c = random.gamma(2, 1, STRATA), random.gamma(2, 1, STRATA)
        b = random.random(STRATA)
        self.r, self.per_r, self.b = (x.astype(np.float32) for x in (r, 1 / r, b))
        self.level = (np.log(c) - r + r * b).astype(np.float32)
        self.factors = random.integers(1, 1 << 62, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def draw(self, hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray, kind: type = np.uint32) -> np.ndarray:
        """Samples of each text, as 32-bit (or 8-bit) names of (shingle, t) pairs: array of texts by samples."""
        out = np.empty((len(starts), len(self.factors)), kind)
        shift = np.uint64(64 - 8 * np.dtype(kind).itemsize)
        logs, names = np.log(weights), hashes & np.uint64(0xFFFFFFFF)
        spread = hashes * np.uint64(0x9E3779B97F4A7C15)
        spread ^= spread >> np.uint64(29)
        for k, factor in enumerate(self.factors):
            at = ((spread * factor) >> np.uint64(48)).astype(np.int64)
            r = self.r[at]
            t = np.floor(logs * self.per_r[at] + self.b[at])
            value = self.level[at] - r * t + np.float32(128)
            keys = (value.view(np.uint32).astype(np.uint64) << np.uint64(32)) | names
            least = np.minimum.reduceat(keys, starts)
            out[:, k] = (mixed(least * factor) >> shift).astype(kind)
        return out


def _drawn(batches: Iterator[pa.RecordBatch], sampler: Sampler, kind: type, cells: np.ndarray, texts: int, settings: Settings) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Blocks of texts with the samples of each; those of a text without words are null."""
    for block, (owner, hashes, counts) in _shingled(batches, settings.size):
        names: list = [None] * block.num_rows
        if len(owner):
            weights = shingle_weights(hashes, counts, cells, texts, settings)
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            for at, row in zip(owner[starts], sampler.draw(hashes, weights, starts, kind)):
                names[at] = row.tobytes()
        yield block, pa.array(names, pa.binary())


def sketches(documents: DataFrame, id: str, text: str, cells: np.ndarray, texts: int, settings: Settings) -> DataFrame:
    """(id, node, sketch) of every document; the samples of a text without words are null."""
    shared = documents.sparkSession.sparkContext.broadcast(cells)  # fixed size, see Settings.cell_bits

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(settings.samples, settings.seed)
        for block, names in _drawn(batches, sampler, np.uint32, shared.value, texts, settings):
            yield pa.RecordBatch.from_arrays([block.column("id"), block.column("node"), names], ["id", "node", "sketch"])

    rows = documents.select(F.col(id).alias("id"), text_key(text).alias("node"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(draw, f"id {kind}, node binary, sketch binary")


#: log2 of the bits that tell which texts are asked for; more texts than that let others through, no fewer.
WANTED_BITS = 24


def asked_rows(documents: DataFrame, text: str, nodes: DataFrame) -> tuple[DataFrame, Callable]:
    """(node, text, place) of all rows, and what picks from their batches those of the texts that `nodes` names.

    A bitmap of fixed size tells them, and lets some others through by chance; nothing is shuffled. The picking is left to
    the function that reads the batches, so that a task needs no Python process more for it.
    """
    place = F.pmod(F.xxhash64("node"), F.lit(1 << WANTED_BITS))
    bits = nodes.select(F.shiftright(place, 6).alias("at"), F.expr("shiftleft(1L, cast(pmod(xxhash64(node), 64) as int))").alias("bits"))
    found = bits.groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()  # 2**WANTED_BITS bits at most
    wanted = np.zeros(1 << WANTED_BITS - 6, np.int64)
    wanted[found["at"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    asked = documents.sparkSession.sparkContext.broadcast(wanted)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("place").to_numpy()
            yield batch.select(["node", "text"]).filter(pa.array((asked.value[at >> 6] >> (at & 63) & 1).astype(bool)))

    return documents.select(text_key(text).alias("node"), F.col(text).alias("text")).withColumn("place", place), choose


def further_samples(documents: DataFrame, text: str, nodes: DataFrame, cells: np.ndarray, texts: int, settings: Settings) -> DataFrame:
    """(node, fine): further samples of the texts that `nodes` names, and of some others by chance."""
    shared = documents.sparkSession.sparkContext.broadcast(cells)
    rows, choose = asked_rows(documents, text, nodes)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(settings.fine, settings.seed + 1)
        for block, names in _drawn(choose(batches), sampler, np.uint8, shared.value, texts, settings):
            yield pa.RecordBatch.from_arrays([block.column("node"), names], ["node", "fine"])

    drawn = rows.mapInArrow(draw, "node binary, fine binary").filter("fine is not null")
    return drawn.groupBy("node").agg(F.first("fine").alias("fine"))


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Share of equal samples of one byte, less those that are equal by chance."""
    return ((x == y).mean(1) - 1 / 256) / (1 - 1 / 256)


def estimated(pairs: DataFrame, points: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of nodes whose share of equal samples is `least` or more."""
    left = points.select(F.col("node").alias("a"), F.col("fine").alias("x"))
    right = points.select(F.col("node").alias("b"), F.col("fine").alias("y"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in "xy")
                yield batch.select(["a", "b"]).filter(pa.array(likeness(x, y) >= least))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(compare, "a binary, b binary")


def weighed(documents: DataFrame, text: str, nodes: DataFrame, cells: np.ndarray, texts: int, settings: Settings) -> DataFrame:
    """(node, hashes, weights): the weighted shingles of the texts that `nodes` names."""
    shared = documents.sparkSession.sparkContext.broadcast(cells)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, (owner, hashes, counts) in _shingled(batches, settings.size):
            weights = shingle_weights(hashes, counts, shared.value, texts, settings)
            edges = np.searchsorted(owner, np.arange(block.num_rows + 1))
            spans = list(zip(edges[:-1], edges[1:]))
            yield pa.RecordBatch.from_arrays(
                [block.column("node"), pa.array([hashes[i:j].tobytes() for i, j in spans], pa.binary()), pa.array([weights[i:j].tobytes() for i, j in spans], pa.binary())],
                ["node", "hashes", "weights"],
            )

    rows, choose = asked_rows(documents, text, nodes)
    wanted = rows.mapInArrow(choose, "node binary, text string").join(nodes, "node", "left_semi")
    rows = wanted.mapInArrow(weigh, "node binary, hashes binary, weights binary")
    return rows.groupBy("node").agg(F.first("hashes").alias("hashes"), F.first("weights").alias("weights"))


def weighted_jaccard(x: np.ndarray, wx: np.ndarray, y: np.ndarray, wy: np.ndarray) -> float:
    """Sum of the smaller weights over the sum of the larger ones; x and y are sorted."""
    at = np.searchsorted(x, y)
    at[at == len(x)] = 0
    same = x[at] == y if len(x) else np.zeros(len(y), bool)
    shared = np.minimum(wx[at[same]], wy[same]).sum(dtype=np.float64)
    total = wx.sum(dtype=np.float64) + wy.sum(dtype=np.float64) - shared
    return float(shared / total) if total else 0.0


def verified(pairs: DataFrame, weights: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b, similarity) whose weighted Jaccard similarity is the threshold or more."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("hx", "wx", "hy", "wy")]
            values = [
                weighted_jaccard(np.frombuffer(hx, np.uint64), np.frombuffer(wx, np.float32), np.frombuffer(hy, np.uint64), np.frombuffer(wy, np.float32))
                for hx, wx, hy, wy in zip(*columns)
            ]
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(values, pa.float64())], ["a", "b", "similarity"])
            yield out.filter(pa.array([v >= threshold for v in values], pa.bool_()))

    left = weights.select(F.col("node").alias("a"), F.col("hashes").alias("hx"), F.col("weights").alias("wx"))
    right = weights.select(F.col("node").alias("b"), F.col("hashes").alias("hy"), F.col("weights").alias("wy"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(check, "a binary, b binary, similarity double")


BLOCK_ROWS = 256


def dealt(rows: DataFrame, of: str) -> DataFrame:
    """rows with run and side, sorted by run, so that any two rows of one `of` meet in one run.

    Each `of` (n: how many rows it has) is cut into blocks of about BLOCK_ROWS rows, and every two of its
    blocks make a run, so no run grows with it. side tells the blocks of a run apart; it is -1 for a block
    with itself.
    """
    cut = rows.withColumn("cuts", F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    cut = cut.withColumn("run", F.xxhash64(of, F.least("own", "other"), F.greatest("own", "other")))
    cut = cut.withColumn("side", F.when(F.col("own") == F.col("other"), F.lit(-1)).otherwise(F.col("own")))
    return cut.drop("n", "cuts", "own", "other", of).repartition("run").sortWithinPartitions("run")


def near_pairs(table: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs of a run, of different blocks and groups, that are worth verifying."""
    runs, side, group = (table.column(c).to_numpy() for c in ("run", "side", "group"))
    marks = np.frombuffer(b"".join(table.column("fine").to_pylist()), np.uint8).reshape(len(runs), -1)
    edges = np.append(np.flatnonzero(runs[1:] != runs[:-1]) + 1, len(runs))
    ends = edges[np.searchsorted(edges, np.arange(len(runs)), "right")]
    at, found = np.arange(len(runs)), []
    for step in range(1, int((ends - at).max())):
        at = at[at + step < ends[at]]
        pick = at[(group[at] != group[at + step]) & ((side[at] < 0) | (side[at] != side[at + step]))]
        pick = pick[likeness(marks[pick], marks[pick + step]) >= least]
        found.append((pick, pick + step))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _links(nodes: list[bytes], pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch({"a": pa.array([nodes[x] for x, _ in pairs], pa.binary()), "b": pa.array([nodes[y] for _, y in pairs], pa.binary())})


def across_groups(crossed: DataFrame, least: float) -> DataFrame:
    """Links (a, b) that join all nodes of one bucket and different groups that are worth verifying.

    crossed: bucket, n (members of the bucket), node, group, fine. A run hands over a forest of its pairs.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches):
            joined = Joined()
            pairs = [(x, y) for x, y in zip(*(p.tolist() for p in near_pairs(table, least))) if joined.join(x, y)]
            if pairs:
                yield _links(table.column("node").to_pylist(), pairs)

    return dealt(crossed, "bucket").mapInArrow(compare, "a binary, b binary").distinct()


def verified_within(clusters: DataFrame, least: float, threshold: float) -> DataFrame:
    """Links (a, b) that join all nodes of one cluster and different groups that are similar.

    clusters: cluster, n, node, group, fine, hashes, weights. A run hands over a forest of its links.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches):
            joined, links = Joined(), []
            hashes = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
            weights = [np.frombuffer(x, np.float32) for x in table.column("weights").to_pylist()]
            for x, y in zip(*(p.tolist() for p in near_pairs(table, least))):
                if joined.root(x) != joined.root(y) and weighted_jaccard(hashes[x], weights[x], hashes[y], weights[y]) >= threshold:
                    joined.join(x, y)
                    links.append((x, y))
            if links:
                yield _links(table.column("node").to_pylist(), links)

    return dealt(clusters, "cluster").mapInArrow(check, "a binary, b binary").distinct()


def links(documents: DataFrame, rows: DataFrame, text: str, cells: np.ndarray, texts: int, settings: Settings) -> DataFrame:
    """Verified links (a, b) that join every near-duplicate class."""
    least = settings.threshold - settings.slack
    points = rows.filter("sketch is not null").groupBy("node").agg(F.first("sketch").alias("sketch"))
    width = 4 * settings.rows
    members = points.select(
        "node",
        F.explode(F.array(*[F.xxhash64(F.lit(k), F.expr(f"substring(sketch, {k * width + 1}, {width})")) for k in range(settings.bands)])).alias("bucket"),
    )
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    shared = written(members.join(sizes, "bucket"), "shared")
    # The sum of the sizes of a text's buckets: the largest is the one nearest to all others.
    central = shared.groupBy("node").agg(F.sum("n").alias("score"))
    ranked = shared.join(central, "node")
    leaders = ranked.groupBy("bucket").agg(F.max(F.struct("score", "node")).alias("l")).select("bucket", F.col("l.node").alias("leader"))
    crowded = written(shared.join(leaders, "bucket"), "crowded")
    discarded(shared)
    # Only texts that share a bucket with another one need more samples.
    points = written(further_samples(documents, text, crowded.select("node"), cells, texts, settings), "samples")

    def contents(nodes: DataFrame) -> DataFrame:
        return written(weighed(documents, text, nodes, cells, texts, settings), "weights")

    pairs = crowded.filter("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    pairs = written(estimated(pairs, points, least), "pairs")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    held = contents(nodes)
    first = written(verified(pairs, held, settings.threshold), "verified").select("a", "b")
    discarded(pairs, held)
    groups = components(first)
    placed = crowded.join(groups, "node", "left").select("bucket", "n", "node", F.xxhash64(F.coalesce("component", "node")).alias("group"))
    several = placed.groupBy("bucket").agg(F.min("group").alias("x"), F.max("group").alias("y")).filter("x <> y").select("bucket")
    crossed = placed.join(several, "bucket", "left_semi").join(points.select("node", "fine"), "node")
    clusters = written(components(across_groups(crossed, least)).withColumnRenamed("component", "cluster"), "clusters")
    if clusters.isEmpty():
        discarded(crowded, points, clusters)
        return first
    members = clusters
    clusters = clusters.join(clusters.groupBy("cluster").agg(F.count("*").alias("n")), "cluster")
    clusters = clusters.join(placed.select("node", "group").distinct(), "node").join(points.select("node", "fine"), "node")
    held = contents(clusters.select("node"))
    more = written(verified_within(clusters.join(held, "node"), least, settings.threshold), "verified")
    discarded(crowded, points, members, held)
    return first.union(more)


def near_duplicates(documents: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(id, class_id, class_size, keep) of every row of documents.

    class_id is the smallest id of the class; keep marks the document that has it.
    A null text counts as an empty one. Texts without a word are alike only if they are equal. Rows without an id belong to
    classes as all others but never name one; if no row of a class has an id, class_id is
    null and all its rows are kept. Rows that repeat an id and its text get equal results.
    Other columns are not read. An empty table gives no rows.
    """
    rows, nodes = _classes(documents, id, text, settings)
    classes = nodes.groupBy("component").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_size"))
    nodes = nodes.join(classes, "component").select("node", "class_id", "class_size")
    return rows.join(nodes, "node").select(
        F.col("id").alias(id), "class_id", "class_size", F.col("id").eqNullSafe(F.col("class_id")).alias("keep")
    )


def _classes(documents: DataFrame, id: str, text: str, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(id, node, ...) of every row, and (node, least, copies, component) of every text: its smallest id, rows and class."""
    documents = documents.select(id, text)
    cells = document_frequencies(documents.select(F.col(text).alias("text")), settings)
    texts = documents.count()
    rows = written(sketches(documents, id, text, cells, texts, settings), "sketches")
    found = links(documents, rows, text, cells, texts, settings)
    nodes = rows.groupBy("node").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    return rows, nodes.join(components(found), "node", "left").withColumn("component", F.coalesce("component", "node"))


def without_copies(documents: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The documents with one of each near-duplicate class; repeated rows of it come once.

    The one is the row of the smallest id, of equal ids that of the smallest text key; a row without an id
    stands for a class only if no row of it has one.
    """
    _, nodes = _classes(documents, id, text, settings)
    first = F.min(F.struct(F.col("least").isNull().alias("unknown"), "least", "node")).alias("first")
    kept = nodes.groupBy("component").agg(first).select(F.col("first.least").alias("kept id"), F.col("first.node").alias("kept node"))
    rows = documents.withColumn("text key", text_key(text))
    rows = rows.join(kept, rows[id].eqNullSafe(kept["kept id"]) & (rows["text key"] == kept["kept node"]), "left_semi")
    return rows.dropDuplicates([id, "text key"]).drop("text key")
