"""Connected components: results against a plain search, and plans that stay small."""

import random

from strandline.llm import _tables, components


def plain(links: list[tuple]) -> dict:
    root = {x: x for link in links for x in link if link[0] != link[1]}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def found(spark, links) -> dict:
    rows = components.min_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    got = {r["node"]: r["component"] for r in rows}
    assert len(got) == len(rows)
    return got


def test_a_round_is_written_in_small_plans(spark, monkeypatch):
    """The driver holds a plan several times and plans anew behind each of its stages: stars are not planned inside each other."""
    leaves = []

    def stored(df):
        leaves.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return _tables.stored(df)

    monkeypatch.setattr(components, "stored", stored)
    links = [(k, k + 1) for k in range(20)]
    assert found(spark, links) == plain(links)
    assert max(leaves) <= 6


def test_hubs_and_loose_links(spark, monkeypatch):
    """Few names are broadcast, and rows of hubs, of one node on either side, are dealt both ways."""
    monkeypatch.setattr(_tables, "HOT_ROWS", 3)
    monkeypatch.setattr(_tables, "HOT_NAMES", 4)
    rnd = random.Random(5)
    links = [(0, k) for k in range(1, 40)] + [(999, k) for k in range(500, 540)] + [(rnd.randrange(1000, 1200), rnd.randrange(1000, 1200)) for _ in range(150)]
    links += [(39, 500), (700, 700), (701, 702), (702, 701)]
    rnd.shuffle(links)
    assert found(spark, links) == plain(links)
