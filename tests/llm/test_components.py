import random

from transitlake.llm.components import components


def brute(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    linked = {x for a, b in links if a != b for x in (a, b)}
    return {x: find(x) for x in linked}


def run(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    return {r["node"]: r["root"] for r in components(spark, df).collect()}


def test_shapes(spark):
    rng = random.Random(1)
    path = list(range(60))
    rng.shuffle(path)
    links = list(zip(path, path[1:])) + [(1000, 1000 + i) for i in range(1, 200)] + [(-5, 7000), (7000, 7001), (9, 9), (-5, 7000), (8000, 8000)]
    assert run(spark, links) == brute(links)
    assert run(spark, []) == {}


def test_random_graphs(spark):
    rng = random.Random(2)
    links = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)]
    assert run(spark, links) == brute(links)
