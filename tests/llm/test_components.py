import random

from articlelake.llm.common import connected_components


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)]  # a chain and a star
    links += [(rng.randrange(1000, 1060), rng.randrange(1000, 1060)) for _ in range(40)] + [(7, 7), (None, 3), (9, None)]
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
    found = connected_components(spark.createDataFrame(links, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == sorted((x, find(x)) for x in list(parent))
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
