import random

from corpusloom.llm import near_dups


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    if len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent):
    sets = [(k, shingles(t)) for k, t in rows]
    label = list(range(len(sets)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, (ka, a) in enumerate(sets):
        for j, (kb, b) in enumerate(sets[:i]):
            if ka is not None and kb is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                label[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(sets):
        if k is not None:
            least[root(i)] = min(least.get(root(i), k), k)
    return sorted(((k, len(s), least.get(root(i)), k == least.get(root(i))) for i, (k, s) in enumerate(sets)), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def table(seed):
    rnd = random.Random(seed)

    def text(n):
        return [rnd.choice("abcdefghij") + rnd.choice("xyz") + str(rnd.randrange(40)) for _ in range(n)]

    rows = [(100 + i, " ".join(text(60))) for i in range(20)]
    base = text(200)
    for i in range(40):  # copies that are near the base, less so to each other
        copy = list(base)
        for _ in range(rnd.choice((1, 2, 3, 5))):
            copy[rnd.randrange(200)] = "edit" + str(rnd.random())
        rows.append((1000 - i, " ".join(copy)))
    chain = text(120)  # links from one to the next
    for i in range(12):
        chain = chain[:5 * i] + ["c" + str(rnd.random())] + chain[5 * i + 1 :]
        rows.append((500 + i, " ".join(chain)))
    rows += [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one  TWO\n"), (6, "one two three four five"), (7, "ONE two three four five")]
    rows += [(8, "É é"), (9, "é É"), (10, "one\x85two"), (None, "one two"), (11, " ".join(text(5000))), (12, " ".join(base))]
    return rows


def test_against_brute_force(documents):
    for percent in (85, 80):
        assert result(near_dups.near_duplicates(documents(table(percent)), percent)) == brute(table(percent), percent)


def test_small_stars_and_blocks_are_spread_over_groups(documents, monkeypatch):
    monkeypatch.setattr(near_dups, "STAR", 3)
    monkeypatch.setattr(near_dups, "BLOCK_SETS", 4)
    assert result(near_dups.near_duplicates(documents(table(1)), 85)) == brute(table(1), 85)


def test_empty_table(documents):
    assert near_dups.near_duplicates(documents([]), 85).collect() == []


def test_number_of_bands_follows_the_threshold():
    for threshold in (0.8, 0.85, 0.95):
        assert (1 - threshold**near_dups.ROWS) ** near_dups.bands_for(threshold) <= near_dups.MISS


def test_one_id_with_several_texts(spark, documents):
    a = " ".join(f"w{i}" for i in range(80))
    b = " ".join(f"v{i}" for i in range(80))
    rows = [(1, a), (1, b), (2, a + " end"), (1, a), (3, b + " end"), (3, "something else altogether and more"), (None, a)]
    assert result(near_dups.near_duplicates(documents(rows), 80)) == brute(rows, 80)
    import corpus_pipeline

    kept = corpus_pipeline.drop_near_duplicates(spark, documents(rows), "").select("doc_id", "text").collect()
    want = [(1, a), (1, b), (3, "something else altogether and more"), (None, a)]
    assert sorted(map(tuple, kept), key=repr) == sorted(want, key=repr)
