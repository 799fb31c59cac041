import random

from tessera.llm.graph import connected_components


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, 500 + i) for i in range(1, 80)]
    loose = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)]
    edges = [*chain, *star, *loose, (7, 7), (3, 2), (2, 3), (-5, 2)]
    rng.shuffle(edges)
    got = {r.u: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in range(len(edges)):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {x: r for x, r in label.items() if x != r}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
