import random

from corpusloom.llm import decontaminate


def distance(pattern, text):
    """Least edit distance of pattern to any part of text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def edited(text, n, rnd):
    out = list(text)
    for _ in range(n):
        i = rnd.randrange(len(out))
        out[i : i + 1] = rnd.choice(([], ["q"], [out[i], "z"]))
    return "".join(out)


def table(seed=3):
    rnd = random.Random(seed)

    def prose(n):
        return " ".join(rnd.choice(["ve", "monta", "ril", "és", "kanto", "o", "pal"]) for _ in range(n))

    items = [(i, prose(rnd.randrange(12, 40))) for i in range(8)] + [(20, None), (21, "short"), (22, ""), (None, prose(20))]
    items += [(23, items[0][1])]
    rows = [(i, prose(60)) for i in range(10)]
    for i in range(40):
        key, item = items[i % 8]
        budget = len(decontaminate.normal(item)) // decontaminate.CHARS_PER_EDIT
        n = rnd.choice((0, 1, budget, budget + 1, budget + 4))
        rows.append((100 + i, prose(rnd.randrange(30)) + " " + edited(item, n, rnd).upper() + ",\n" + prose(rnd.randrange(30))))
    rows += [(500, None), (501, ""), (502, prose(3000) + "! " + items[1][1]), (100, rows[10][1])]
    return rows, items


def test_against_full_tables(spark, documents):
    rows, items = table()
    want = []
    for key, text in rows:
        t = decontaminate.normal(text or "")
        for item, body in items:
            b = decontaminate.normal(body or "")
            if item is not None and len(b) >= decontaminate.LEAST_CHARS and t:
                d = distance(b, t)
                if d <= len(b) // decontaminate.CHARS_PER_EDIT:
                    want.append((key, item, d))
    benchmark = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, label string")
    got = decontaminate.mark(documents(rows), benchmark).collect()
    assert sorted((r["doc_id"], m["item_id"], m["distance"]) for r in got for m in r["matches"]) == sorted(want)
    for r in got:
        t = decontaminate.normal(r["text"])
        for m in r["matches"]:
            body = decontaminate.normal(dict(items)[m["item_id"]])
            assert distance(body, t[m["start"] : m["end"]]) == m["distance"]


def test_blocks_of_the_benchmark(spark, documents, monkeypatch):
    rows, items = table(5)
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def found():
        got = decontaminate.mark(documents(rows), benchmark).collect()
        return sorted((r["doc_id"], m["item_id"], m["distance"]) for r in got for m in r["matches"])

    whole = found()
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 300)
    assert found() == whole


def test_nothing(spark, documents):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert [r["matches"] for r in decontaminate.mark(documents([(1, "a")]), benchmark).collect()] == [[]]
    assert decontaminate.mark(documents([]), benchmark).collect() == []
