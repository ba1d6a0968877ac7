"""Connected components: few edges in a few partitions, many left to AQE."""

import numpy as np
import pytest

from sentrel.llm import shared


@pytest.mark.parametrize("few", [200_000, 1])
def test_components_equal_union_find_on_both_paths(spark, monkeypatch, few):
    monkeypatch.setattr(shared, "FEW_EDGES", few)
    r = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 60, (30, 2))] + [(100, 100 + i) for i in range(1, 20)] + [(i, i + 1) for i in range(200, 212)] + [(5, 5), (300, 301), (300, 301)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = shared.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert sorted(map(tuple, got)) == sorted((x, root(x)) for x in parent)
