"""Hard negatives against comparing every anchor with every row."""

import math

import numpy as np
import pytest
from llm_fixtures import rows
from pyspark.sql import functions as F

from tickbars.llm import hard_negatives
from tickbars.llm.registry import op11_hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(table, is_anchor, positives=5, negatives=10, low=30, high=90):
    """table: (id, vector, label); each row that takes part once."""
    taken = {(i, label, tuple(v)) for i, v, label in table if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)}
    whole = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in taken]
    out = []
    for anchor, own, q in whole:
        if not is_anchor(anchor):
            continue
        score = [(sum(a * b for a, b in zip(q, v)), i, label) for i, label, v in whole if i != anchor]
        best = sorted(((s, i) for s, i, label in score if label == own), key=lambda x: (-x[0], x[1]))[:positives]
        for p, positive in best:
            fit = sorted(((s, i) for s, i, label in score if label != own and low * p <= 100 * s <= high * p), key=lambda x: (-x[0], x[1]))
            out += [(anchor, positive, rank, i, p, s) for rank, (s, i) in enumerate(fit[:negatives], 1)]
    return sorted(out, key=repr)


def vectors(n, width, seed, spread=0.3):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(4, width))
    for i in range(n):
        label = int(random.integers(4))
        v = centres[int(random.integers(4))] * 0.2 + random.normal(size=width) * spread
        yield i, v.tolist(), label


@pytest.mark.parametrize(("width", "spread", "block", "leaf"), [(8, 0.05, 64, 4), (3, 0.3, 100, 1), (16, 0.3, 10_000, 8), (1, 0.5, 50, 2)])
def test_equal_to_comparing_all(spark, monkeypatch, width, spread, block, leaf):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    table = list(vectors(400, width, width, spread))
    frame = spark.createDataFrame(table, SCHEMA).repartition(3)
    found = hard_negatives.mine(frame, F.col("id") % 10 == 0, block=block, leaf=leaf)
    assert rows(found) == brute(table, lambda i: i % 10 == 0)


def test_hard_rows(spark):
    """Nulls and non-finite components, repeated rows and ids, ties, copies, zero vectors, other widths, few rows."""
    nan, inf = float("nan"), float("inf")
    table = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (10, [0.5, 0.5], 1), (10, [-0.5, 0.5], 1), (10, [0.25, 0.5], 2),
        (1, None, 1), (2, [1.0, None], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [1.0, 1.0], None), (None, [1.0, 1.0], 1),
        (6, [0.9, 0.5], 1), (7, [0.9, 0.5], 1), (8, [0.0, 0.0], 1), (9, [], 1), (20, [], 2), (30, [0.0, 0.0], 3),
        (11, [0.5], 2), (12, [0.5, 0.0, 3.0], 2), *[(100 + i, [0.5, 0.3], 3) for i in range(1, 40) if i % 10],
        (14, [-1.0, -1.0], 1), (15, [0.004, 0.003], 5),
    ]
    frame = spark.createDataFrame(table, SCHEMA).repartition(3)
    for block, leaf in ((5, 1), (1000, 256)):
        found = hard_negatives.mine(frame, F.col("id") % 10 == 0, block=block, leaf=leaf)
        assert rows(found) == brute(table, lambda i: i % 10 == 0)


def test_large_components(spark):
    table = [(0, [2.0**22, 1.0], 1), (1, [2.0**22, 1.0], 1), (2, [2.0**21, -3.0], 2), (3, [2.0**21, 3.0], 2)]
    found = hard_negatives.mine(spark.createDataFrame(table, SCHEMA), F.col("id") == 0)
    assert rows(found) == brute(table, lambda i: i == 0)
    exact = np.array([[2**30 + 1, 3]], np.int64)
    assert hard_negatives.products(exact, exact[0]).tolist() == [(2**30 + 1) ** 2 + 9]
    with pytest.raises(OverflowError):
        hard_negatives.products(exact << 2, exact[0] << 2)


def test_a_tree_skips_nodes_outside_the_window():
    """On rows in clusters the descent scores a small part of the leaves, and finds what a scan finds."""
    random = np.random.default_rng(3)
    centres = random.normal(size=(60, 12)) * 300
    whole = (centres[random.integers(60, size=6000)] + random.normal(size=(6000, 12)) * 10).astype(np.int64)
    norm = float(np.sqrt((whole.astype(float) ** 2).sum(1).max()))
    labels, ids = random.integers(4, size=6000), np.arange(6000)
    tree = hard_negatives.Tree.build(ids, labels, ids, whole, norm, leaf=32)
    inside = np.diff(tree.nodes[:, 3:5])[:, 0]
    assert inside.sum() == 6000 and sorted(tree.points) == ids.tolist()
    scored = []
    plain = hard_negatives.products
    hard_negatives.products = lambda rows, q: scored.append(len(rows)) or plain(rows, q)
    try:
        for i in range(0, 6000, 600):
            exact = plain(whole, whole[i])
            top = int(exact.max())
            one = [np.array([x]) for x in (i, labels[i], i)]
            window = [np.array([0, 1]), np.array([0]), np.array([top // 3]), np.array([top // 2])]
            anchors = hard_negatives.Anchors(*one, whole[i : i + 1], *window)
            ((_, places, best),) = tree.search(anchors, norm, 10, False)
            fit = [(-exact[j], j) for j in range(6000) if labels[j] != labels[i] and top // 3 <= exact[j] <= top // 2]
            assert [(-s, j) for s, j in zip(best.tolist(), tree.ids[places].tolist())] == sorted(fit)[:10]
    finally:
        hard_negatives.products = plain
    assert sum(scored) < 0.2 * 10 * 6000


def test_clashing_columns_and_empty_tables(spark):
    table = [(i, v, label, 1, "x", 2.0) for i, v, label in vectors(30, 4, 1)]
    frame = spark.createDataFrame(table, "key_id long, v array<float>, kind long, point int, id string, score double")
    found = hard_negatives.mine(frame, F.col("id") % 5 == 0, "key_id", "v", "kind")
    single = [(i, np.array(v, np.float32).astype(float).tolist(), label) for i, v, label, *_ in table]
    assert rows(found) == brute(single, lambda i: i % 5 == 0)
    nothing = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(nothing, F.col("id") % 5 == 0).count() == 0
    assert hard_negatives.mine(frame, F.lit(False), "key_id", "v", "kind").count() == 0


def test_query_equals_comparing_all(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    changed = [(r.vec_id, r.embedding, None if r.label is None else (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in table]
    assert rows(op11_hard_negatives(spark, sf_dir)) == brute(changed, lambda i: i % 100 == 0)
