import random

from corpusloom.llm.components import connected


def brute(links):
    label = {x: x for link in links for x in link}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        label[high] = low
    return {x: root(x) for x in label}


def test_against_union_find(spark):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(60)]  # a path
    links += [(2000 - i, 2001 - i) for i in range(0, 40, 2)] + [(900, 900 + i) for i in range(1, 80)]  # pairs, a star
    links += [(rnd.randrange(3000, 3200), rnd.randrange(3000, 3200)) for _ in range(110)]
    rnd.shuffle(links)
    got = {r["id"]: r["label"] for r in connected(spark.createDataFrame(links + links[:9], "a long, b long")).collect()}
    assert got == brute([x for x in links if x[0] != x[1]])


def test_no_links(spark):
    assert connected(spark.createDataFrame([(5, 5)], "a long, b long")).collect() == []
