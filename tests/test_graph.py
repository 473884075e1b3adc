import random

import pytest

from wayspan import tables
from wayspan.operators import graph

LINK = "a long, b long"


def classes(links):
    root = {}

    def find(v):
        root.setdefault(v, v)
        while root[v] != v:
            root[v] = v = root[root[v]]
        return v

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {v: find(v) for v in root}


def got(spark, links):
    with tables.scope():
        return {r.node: r.label for r in graph.components(spark.createDataFrame(links, LINK)).collect()}


@pytest.mark.parametrize("n", [60, 1000, 10_000])
def test_chain_in_adverse_order(spark, n):
    """The least node is at one end, its neighbours the largest: labels would crawl one link a round."""
    chain = [0, *range(2 * n, n, -1)][:n]
    assert got(spark, list(zip(chain, chain[1:]))) == {v: 0 for v in chain}


@pytest.mark.parametrize("seed", range(3))
def test_random_links(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    want = classes([x for x in links if x[0] != x[1]])
    assert got(spark, links) == want


def test_star_and_nothing(spark):
    assert got(spark, [(500, i) for i in range(400)]) == {i: 0 for i in [*range(400), 500]}
    assert got(spark, []) == {}


def test_scopes_remove_their_tables(spark):
    root = tables.shared_root(spark).removeprefix("file:")

    def there(df):
        import os

        return all(os.path.exists(f.removeprefix("file:").replace("///", "/")) for f in df.inputFiles())

    with tables.scope() as kept:
        inner = tables.settled(spark.range(10))
        files = inner.inputFiles()
        assert there(inner)
        out = kept.result(inner.where("id > 4"))
    assert out.count() == 5 and there(out)
    import os

    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)
    assert root
