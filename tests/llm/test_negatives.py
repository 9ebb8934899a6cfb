"""Hard negatives against a search by definition."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kerbline.llm import negatives
from kerbline.llm.negatives import hard_negatives, op13_hard_negatives, spanning_tree

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_hand(rows, anchor_of, positives=5, found=10, low=30, high=90) -> list[tuple]:
    ready = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        ready.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    last = lambda vec_id: (vec_id is None, vec_id or 0)
    result = []
    for i, (a_id, a, a_label) in enumerate(ready):
        if not anchor_of(a_id):
            continue
        scored = [
            (-sum(x * y for x, y in zip(a, b, strict=False)), last(b_id), j, b_id, label)
            for j, (b_id, b, label) in enumerate(ready)
            if j != i
        ]
        scored.sort(key=lambda s: s[:3])
        for p in [s for s in scored if s[4] == a_label][:positives]:
            inside = [n for n in scored if n[4] != a_label and low * -p[0] <= 100 * -n[0] <= high * -p[0]]
            result += [(a_id, p[3], rank, n[3], -p[0], -n[0]) for rank, n in enumerate(inside[:found], 1)]
    return sorted(result, key=repr)


def vectors(seed: int, many: int, width: int = 6) -> list[tuple]:
    """Clustered vectors with copies, ties, rows that take no part, and repeated and null ids."""
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(5, width)) * 0.4
    rows = []
    for i in range(many):
        vector = (centres[draw.integers(5)] + draw.normal(size=width) * 0.2).round(2).tolist()
        if i % 9 == 4:
            vector = rows[draw.integers(len(rows))][1]
        rows.append((i, vector, int(draw.integers(4))))
    rows[13] = (13, None, 1)
    rows[14] = (14, rows[3][1], None)
    rows[15] = (15, [0.5] * (width - 1) + [None], 1)
    rows[16] = (16, [0.5] * (width - 1) + [float("nan")], 1)
    rows[17] = (17, [float("-inf")] + [0.5] * (width - 1), 1)
    rows[18] = (18, rows[2][1][: width - 2], 2)
    rows[19] = (19, [], 2)
    rows[21] = (None, rows[1][1], 0)
    rows[22] = (None, rows[2][1], 3)
    return rows + [rows[1], rows[20], rows[20]]


@pytest.mark.parametrize("seed", [1, 2])
def test_as_by_definition(spark, monkeypatch, seed):
    monkeypatch.setattr(negatives, "TREE_ANCHORS", 7)
    monkeypatch.setattr(negatives, "PIVOTS", 3)
    rows = vectors(seed, 260)
    frame = spark.createDataFrame(rows, SCHEMA).coalesce(3)
    found = hard_negatives(frame, F.col("vec_id") % 10 == 0)
    expected = by_hand(rows, lambda i: i is not None and i % 10 == 0)
    assert len(expected) > 500
    assert sorted(map(tuple, found.collect()), key=repr) == expected


def test_query_as_by_definition(spark, tmp_path):
    rows = vectors(5, 420, 16)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    moved = [
        (i, v, (label + 1) % 10 if i is not None and i % 7 == 0 and label is not None else label) for i, v, label in rows
    ]
    expected = by_hand(moved, lambda i: i is not None and i % 100 == 0)
    found = op13_hard_negatives(spark, str(tmp_path))
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert found.dtypes == [(n, "int" if n == "rank" else "bigint") for n in names]
    assert sorted(map(tuple, found.collect()), key=repr) == expected and expected


def test_a_third_of_all_rows_equal(spark):
    rows = vectors(3, 200)
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(120)]
    found = hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0)
    expected = by_hand(rows, lambda i: i is not None and i % 20 == 0)
    assert sorted(map(tuple, found.collect()), key=repr) == expected


def test_odd_tables(spark):
    schema = "rid string, vec_id int, place int, label short, embedding array<double>, block int"
    every = F.lit(True)
    assert hard_negatives(spark.createDataFrame([], schema), every).count() == 0
    one = [("a", 5, 1, 2, [0.5], 9)]
    assert hard_negatives(spark.createDataFrame(one, schema), every).count() == 0
    rows = one + [("b", None, None, 2, [0.6], None), (None, 7, None, 3, [0.3], None)]
    found = hard_negatives(spark.createDataFrame(rows, schema), F.col("vec_id").isNull())
    assert [tuple(r) for r in found.collect()] == [(None, 5, 1, 7, 153 * 128, 153 * 76)]
    nobody = hard_negatives(spark.createDataFrame(rows, schema), F.lit(False))
    assert nobody.count() == 0


def test_scores_beyond_doubles_are_exact(spark):
    big = 2.0**21
    rows = [(0, [big, 1.0], 1), (1, [big, 1.0], 1), (2, [big / 2, 3.0], 2), (3, [big / 2, 3.01], 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = [tuple(r) for r in hard_negatives(frame, F.col("vec_id") == 0).orderBy("rank").collect()]
    first, second = 2**57 + 256 * 770, 2**57 + 256 * 768
    assert found == [(0, 1, 1, 3, 2**58 + 2**16, first), (0, 1, 2, 2, 2**58 + 2**16, second)]
    wide = spark.createDataFrame([(0, [1e300], 1), (1, [-1e300], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="do not fit in 64 bits"):
        hard_negatives(wide, F.col("vec_id") == 0).collect()


def test_trees_span_and_have_the_least_length():
    draw = np.random.default_rng(1)
    points = draw.integers(-300, 300, (80, 5))
    points[10:20] = points[0]
    order, parent, edge = spanning_tree(points)
    assert sorted(order.tolist()) == list(range(80)) and parent[0] == -1
    assert all(p < i for i, p in enumerate(parent))
    true = [float(np.linalg.norm(points[order[i]] - points[order[parent[i]]])) for i in range(1, 80)]
    assert all(e >= t for e, t in zip(edge[1:], true, strict=True))
    pairs = sorted((float(np.linalg.norm(points[i] - points[j])), i, j) for i in range(80) for j in range(i))
    root, least = list(range(80)), 0.0
    for length, i, j in pairs:
        a, b = root[i], root[j]
        if a != b:
            root, least = [a if r == b else r for r in root], least + length
    assert sum(true) == pytest.approx(least)


def test_bounds_spare_most_rows_of_far_clusters():
    """Clusters far from each other: most rows are never scored with the anchors of another one's tree."""
    draw = np.random.default_rng(4)
    centres = np.eye(8)[:4] * 200
    vectors = (centres[draw.integers(0, 4, 4000)] + draw.normal(size=(4000, 8)) * 4).astype(np.int64)
    ids = np.arange(4000)
    block = negatives._Block([(ids, ids, ids % 3, vectors)], same=False, most=10)
    near = np.flatnonzero(vectors[:, 0] > 100)[:40]
    order, parent, edge = spanning_tree(vectors[near])
    nodes = [
        {"rid": int(near[o]), "label": int(near[o]) % 3, "vec": vectors[near[o]], "parent": int(p), "edge": float(e), "windows": [(38000, 39000)]}
        for o, p, e in zip(order, parent, edge, strict=True)
    ]
    found = block.search(nodes)
    assert isinstance(found, pa.RecordBatch) and block.scored < 0.25 * block.bounded
    expected = []
    for node in nodes:
        scores = vectors @ node["vec"]
        right = (ids % 3 != node["label"]) & (scores >= 38000) & (scores <= 39000)
        best = sorted((-s, i) for s, i in zip(scores[right].tolist(), ids[right].tolist(), strict=True))[:10]
        expected += [(node["rid"], -s, i) for s, i in best]
    assert sorted(zip(*(found[c].to_pylist() for c in ("anchor", "score", "other")), strict=True)) == sorted(expected)
