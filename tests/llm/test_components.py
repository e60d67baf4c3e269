import numpy as np
import pytest

from tickbars.llm.components import components


def joined(edges):
    parent = {}

    def top(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = top(u), top(v)
        parent[max(a, b)] = min(a, b)
    return {x: top(x) for x in {x for e in edges for x in e} if top(x) != x}


@pytest.mark.parametrize(
    "edges",
    [
        [(i, i + 1) for i in range(60)],
        [(0, i) for i in range(1, 200)],
        [(7, 7), (3, 1), (1, 3), (9, 3), (20, 21)],
        np.random.default_rng(1).integers(0, 300, (260, 2)).tolist(),
    ],
)
def test_components(spark, edges):
    found = components(spark.createDataFrame(edges, "u long, v long").repartition(5))
    assert {r.node: r.root for r in found.collect()} == joined([tuple(e) for e in edges])


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
