"""Hard negatives: for anchors and their positives, the most alike rows of other labels in a band of scores.

Anchors are gathered into blocks of neighbours, and each block's anchors are linked by a tree of least
distances.  What a row scores with an anchor's parent bounds what it scores with the anchor: by the
product of the edge's length and the row's norm, more or less.  Only rows whose bounds overlap a
window of scores that an anchor still looks for are scored in full; for the others the bounds hold
on, and widen down the tree.

Rows are scored in blocks.  A task holds one block of rows as numbers; the anchors, which every
block needs, pass it one tree after another, so its memory does not depend on how many there are.
Each block tells for each window its own best rows, and Spark ranks these.  A first pass finds the positives,
whose scores then give the windows of the second.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbline.llm.shared import in_arrow, stored, table

#: Positives of an anchor, negatives of a positive, and the band of scores of these, in hundredths.
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
#: Components become ``floor(SCALE * x)``.
SCALE = 256
#: Rows of a block at most, and blocks at least; anchors of a tree, about.
BLOCK_ROWS, LEAST_BLOCKS, TREE_ANCHORS = 1 << 19, 16, 256
#: Anchors that the others are gathered around: a sample of this size, whatever the table's.
PIVOTS = 64
#: Rows scored at once.
PORTION = 1 << 13
#: Stands for a null id in comparisons.
_LAST = 2**63 - 1
#: Whole numbers up to here are exact as doubles.
_EXACT = 2**53


def prepared(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``rid, vec_id, label, vec``: the rows that take part, components as whole numbers.

    A row with a null label or vector, or with any null or non-finite component, takes no part.
    ``rid`` numbers the rows, so that equal rows are different ones.
    """
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    chosen = rows.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{label_col}`").cast("long").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vec"),
    )
    chosen = chosen.where(F.col("label").isNotNull() & F.col("vec").isNotNull() & ~bad)
    whole = F.transform("vec", lambda x: F.floor(F.lit(float(SCALE)) * x))
    return chosen.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", whole.alias("vec"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of a matrix of 64-bit integers; shorter ones end in zeros."""
    sizes = np.array(column.value_lengths().to_pylist(), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    made = np.zeros((len(sizes), width), np.int64)
    ends = np.cumsum(sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    made[row, np.arange(len(flat)) - np.repeat(ends - sizes, sizes)] = flat
    return made


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in as little room as they need."""
    most = max(int(values.max(initial=0)), -int(values.min(initial=0)))
    return values.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.int64)


def _norms(values: np.ndarray) -> np.ndarray:
    """Lengths of vectors, never below the true ones."""
    return np.sqrt((values.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)


class _Scorer:
    """Inner products of whole numbers, exact."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray):
        largest = [max(float(x.max(initial=0)), -float(x.min(initial=0))) for x in (rows, anchors)]
        most = largest[0] * largest[1] * max(1, rows.shape[1])
        if most >= 2**63:
            raise ArithmeticError("inner products of these vectors do not fit in 64 bits")
        kind = np.float64 if most < _EXACT else np.int64
        self.rows, self.anchors = rows.astype(kind), anchors.astype(kind)

    def all_rows(self, anchor: int) -> np.ndarray:
        return self.rows @ self.anchors[anchor]

    def some(self, chosen: np.ndarray, anchor: int) -> np.ndarray:
        return self.rows[chosen] @ self.anchors[anchor]


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A tree of least distances: an order in which parents come first, the parent of each by its place
    in that order (-1: the root), and the length of the edge, never below the true one."""
    many = len(vectors)
    points = vectors.astype(np.float64)
    order, parent = [0], [-1]
    place_of = np.zeros(many, np.int64)
    least = ((points - points[0]) ** 2).sum(axis=1)
    linked = np.zeros(many, bool)
    linked[0] = True
    edges = [0.0]
    for place in range(1, many):
        least[linked] = np.inf
        chosen = int(least.argmin())
        edges.append(float(np.sqrt(least[chosen])) * (1 + 1e-9))
        order.append(chosen)
        parent.append(int(place_of[chosen]))
        linked[chosen] = True
        apart = ((points - points[chosen]) ** 2).sum(axis=1)
        closer = (apart < least) & ~linked
        least[closer] = apart[closer]
        place_of[closer] = place
    return np.array(order), np.array(parent), np.array(edges)


def _nearest(pivots: np.ndarray):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _matrix(batch["vec"], pivots.shape[1]).astype(np.float64)
            apart = (pivots**2).sum(axis=1) - 2 * points @ pivots.T
            columns = {name: batch[name] for name in batch.schema.names}
            columns["pivot"] = pa.array(apart.argmin(axis=1), pa.int32())
            yield pa.RecordBatch.from_pydict(columns)

    return run


_NODE = "rid long, vec_id long, label long, vec array<long>, tree long, place int, parent int, edge double"


def _linked(width: int):
    def link(group: pa.Table) -> pa.Table:
        group = group.sort_by("rid").combine_chunks()
        order, parent, edges = spanning_tree(_matrix(group["vec"].combine_chunks(), width))
        made = group.take(pa.array(order)).select(["rid", "vec_id", "label", "vec", "tree"])
        for name, values in (("place", np.arange(len(order), dtype=np.int32)), ("parent", parent.astype(np.int32)), ("edge", edges)):
            made = made.append_column(name, pa.array(values))
        return made

    return link


def anchor_trees(anchors: DataFrame, width: int) -> DataFrame:
    """Anchors with the tree they are in, their place in it, their parent's place and the edge's length.

    Anchors go to the nearest of ``PIVOTS`` of them, and those of one pivot are dealt into trees of about
    ``TREE_ANCHORS``, so no group grows with the table, however many anchors are equal.
    """
    sample = anchors.orderBy(F.xxhash64("rid"), "rid").limit(PIVOTS).select("vec").collect()
    if not sample:
        return anchors.sparkSession.createDataFrame([], _NODE)
    pivots = np.zeros((len(sample), max(1, width)))
    for i, row in enumerate(sample):
        pivots[i, : len(row["vec"])] = row["vec"]
    near = in_arrow(anchors, _nearest(pivots), "rid long, vec_id long, label long, vec array<long>, pivot int")
    near = stored(near, "near-anchors")
    trees = near.groupBy("pivot").agg(F.ceil(F.count("*") / TREE_ANCHORS).alias("trees"))
    dealt = near.join(trees, "pivot").withColumn("tree", F.xxhash64("pivot", F.pmod(F.xxhash64("rid"), "trees")))
    return stored(dealt.select("rid", "vec_id", "label", "vec", "tree").groupBy("tree").applyInArrow(_linked(max(1, width)), _NODE), "anchor-trees")


@dataclass
class _Slot:
    """A window of scores, and the best rows met in it as (score, -id, -rid): the least of them first."""

    number: int
    low: int
    high: int
    best: list

    def floor(self, most: int) -> int:
        """The least score that still counts."""
        return self.best[0][0] if len(self.best) == most else self.low


_WINDOWS = "array<struct<low:long,high:long>>"
_FOUND = "anchor long, slot int, score long, other long, other_rid long"


class _Block:
    """A block of rows, and the search of trees of anchors in it."""

    def __init__(self, parts: list[tuple], same: bool, most: int):
        ids, rids, labels, vectors = (np.concatenate(x) for x in zip(*parts, strict=True))
        # By id, so that ties of a portion fall to the smaller ones.
        order = np.lexsort((rids, ids))
        self.ids, self.rids, self.labels = ids[order], rids[order], labels[order]
        self.vectors = _narrow(vectors[order])
        self.norms = _norms(self.vectors)
        self.same, self.most = same, most
        self.scored = self.bounded = 0

    def search(self, anchors: list[tuple]) -> pa.RecordBatch:
        """The best rows for each window of the anchors of one tree, in order of their places."""
        vectors = np.stack([a["vec"] for a in anchors])
        slots = [
            [_Slot(i, low, high, []) for i, (low, high) in enumerate(a["windows"])] for a in anchors
        ]
        for first in range(0, len(self.ids), PORTION):
            self._portion(slice(first, first + PORTION), anchors, vectors, slots)
        found = [
            (a["rid"], slot.number, score, -back_id, -back_rid)
            for a, own in zip(anchors, slots, strict=True)
            for slot in own
            for score, back_id, back_rid in slot.best
        ]
        columns = [np.array(c, np.int64) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 5
        others = pa.array(columns[3], pa.int64(), mask=columns[3] == _LAST)
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0]), pa.array(columns[1].astype(np.int32)), pa.array(columns[2]), others, pa.array(columns[4])],
            ["anchor", "slot", "score", "other", "other_rid"],
        )

    def _portion(self, rows: slice, anchors, vectors, slots) -> None:
        scorer = _Scorer(self.vectors[rows], vectors)
        ids, rids, labels, norms = self.ids[rows], self.rids[rows], self.labels[rows], self.norms[rows]
        many = len(ids)
        low = np.empty((len(anchors), many))
        high = np.empty((len(anchors), many))
        # A double may be off by this much; scores beyond 2**53 are kept as integers beside the bounds.
        for i, anchor in enumerate(anchors):
            if anchor["parent"] < 0:
                scores = scorer.all_rows(i)
                low[i] = high[i] = scores
                exact = np.arange(many)
            else:
                reach = anchor["edge"] * norms
                np.subtract(low[anchor["parent"]], reach, out=low[i])
                np.add(high[anchor["parent"]], reach, out=high[i])
                low[i] -= np.abs(low[i]) * 1e-9 + 1
                high[i] += np.abs(high[i]) * 1e-9 + 1
                if not slots[i]:
                    continue
                least = min(slot.floor(self.most) for slot in slots[i])
                top = max(slot.high for slot in slots[i])
                fits = (high[i] >= least) & (low[i] <= top)
                fits &= (labels == anchor["label"]) == self.same
                exact = np.flatnonzero(fits)
                self.bounded += many
                self.scored += len(exact)
                scores = scorer.some(exact, i)
                low[i][exact] = high[i][exact] = scores
            if slots[i] and len(exact):
                right = (labels[exact] == anchor["label"]) == self.same
                right &= rids[exact] != anchor["rid"]
                self._offer(slots[i], scores[right], exact[right], ids, rids)

    def _offer(self, slots, scores, places, ids, rids) -> None:
        for slot in slots:
            inside = np.flatnonzero((scores >= slot.floor(self.most)) & (scores <= slot.high))
            if len(inside) > self.most:
                # Rows are in order of ids: of equal scores the first count.
                least = np.partition(scores[inside], len(inside) - self.most)[len(inside) - self.most]
                above = inside[scores[inside] > least]
                inside = np.concatenate([above, inside[scores[inside] == least][: self.most - len(above)]])
            for j in inside.tolist():
                place = places[j]
                item = (int(scores[j]), -int(ids[place]), -int(rids[place]))
                if len(slot.best) < self.most:
                    heapq.heappush(slot.best, item)
                elif item > slot.best[0]:
                    heapq.heapreplace(slot.best, item)


def _searched(width: int, same: bool, most: int):
    """Blocks of rows and then the anchors of one tree after another; ``place`` is null for a row."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        number, parts, block, tree, nodes = None, [], None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = batch["block"].to_numpy()
            is_row = batch["place"].is_null().to_numpy(zero_copy_only=False)
            trees = batch["tree"].fill_null(0).to_numpy()
            changes = (np.diff(numbers) != 0) | (np.diff(is_row) != 0) | (np.diff(trees) != 0)
            cuts = np.flatnonzero(changes) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(numbers)], strict=True):
                part = batch.slice(a, b - a)
                fresh = numbers[a] != number
                if nodes and (fresh or is_row[a] or trees[a] != tree):
                    if block:
                        yield block.search(nodes)
                    nodes = []
                if fresh:
                    number, parts, block = numbers[a], [], None
                if is_row[a]:
                    ids = part["vec_id"].fill_null(_LAST).to_numpy()
                    vectors = _narrow(_matrix(part["vec"], width))
                    parts.append((ids, part["rid"].to_numpy(), part["label"].to_numpy(), vectors))
                    continue
                if parts:
                    block, parts = _Block(parts, same, most), []
                tree = trees[a]
                vectors = _matrix(part["vec"], width)
                windows = part["windows"].to_pylist()
                fixed = part.select(["rid", "label", "parent", "edge"]).to_pylist()
                nodes += [
                    node | {"vec": vec, "windows": [(w["low"], w["high"]) for w in own or []]}
                    for node, vec, own in zip(fixed, vectors, windows, strict=True)
                ]
        if nodes and block:
            yield block.search(nodes)

    return run


def best_in_blocks(rows: DataFrame, nodes: DataFrame, width: int, blocks: int, same: bool, most: int) -> DataFrame:
    """``anchor, slot, score, other, other_rid``: for each window of each anchor the ``most`` best rows of each
    block, among those of the anchor's label or of the others.

    ``nodes`` are anchors with ``windows``.  Rows move once, and each block gets all anchors.
    """
    dealt = rows.select(
        F.pmod("rid", F.lit(blocks)).cast("int").alias("block"),
        F.lit(None).cast("long").alias("tree"),
        F.lit(None).cast("int").alias("place"),
        "rid", "vec_id", "label", "vec",
        F.lit(None).cast("int").alias("parent"),
        F.lit(None).cast("double").alias("edge"),
        F.lit(None).cast(_WINDOWS).alias("windows"),
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    asked = nodes.select(every, *[c for c in dealt.columns if c != "block"])
    both = dealt.unionAll(asked).repartitionById(blocks, "block")
    both = both.sortWithinPartitions("block", F.col("place").isNotNull(), "tree", "place")
    return in_arrow(both, _searched(max(1, width), same, most), _FOUND)


def _ranked(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(
        F.col("score").desc(), F.col("other").asc_nulls_last(), "other_rid"
    )
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _bounds(score: Column, low: int, high: int) -> Column:
    """The whole scores s of which ``low * score <= 100 * s <= high * score``."""
    wide = score.cast("decimal(28,0)")
    least, most = F.ceil(wide * low / 100), F.floor(wide * high / 100)
    return F.struct(least.cast("long").alias("low"), most.cast("long").alias("high"))


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    An anchor's positives are the ``positives`` other rows of its label with the highest scores; for
    each, the ``negatives`` rows of other labels with the highest scores of ``low`` to ``high`` hundredths of
    the positive's.  A score is the inner product of the vectors' ``floor(256 * x)``; equal scores go by
    smaller id, then by the rows' order.  ``is_anchor`` is a condition on ``vec_id``.

    Rows with a null label or vector, or with a null or non-finite component, take no part.  A null id comes
    after all others, and is an anchor only if the condition says so of a null.  Equal rows are different ones,
    each an anchor of its own.  A shorter vector counts as ending in zeros.  Scores that might not fit in 64 bits
    fail.  No rows, or no anchors, give no rows.  Other columns play no part.
    """
    spark = rows.sparkSession
    ready = stored(prepared(rows, id_col, vector_col, label_col), "vectors")
    shape = ready.agg(F.count("*").alias("many"), F.max(F.size("vec")).alias("width")).first()
    width, blocks = shape["width"] or 0, max(LEAST_BLOCKS, -(-shape["many"] // BLOCK_ROWS))
    nodes = anchor_trees(ready.where(is_anchor), width)

    whole = F.array(F.struct(F.lit(-_LAST).alias("low"), F.lit(_LAST).alias("high"))).cast(_WINDOWS)
    near = best_in_blocks(ready, nodes.withColumn("windows", whole), width, blocks, True, positives)
    near = stored(_ranked(near, positives).select("anchor", "rank", "score", F.col("other").alias("positive_id")), "positives")

    # One row an anchor, of a few windows.
    windows = near.groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("own")
    )
    windows = windows.select(
        F.col("anchor").alias("rid"), F.transform("own", lambda p: _bounds(p["score"], low, high)).alias("windows")
    )
    asked = nodes.join(windows, "rid", "left")
    far = best_in_blocks(ready, asked, width, blocks, False, negatives)
    far = _ranked(far, negatives).withColumnsRenamed({"score": "negative_score", "other": "negative_id", "rank": "place"})
    near = near.select("anchor", (F.col("rank") - 1).alias("slot"), "positive_id", F.col("score").alias("positive_score"))
    names = nodes.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (
        far.join(near, ["anchor", "slot"])
        .join(names, "anchor")
        .select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row of ``embeddings``, with a label of every seventh moved on."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    CAST(coalesce(list_dot_product(a.v, b.v), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id,
  positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER w <= 10
"""
