import random

import numpy as np

from corpusloom.llm import suffix_dedup


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for i, b in enumerate(texts):
        for s in range(len(b) - length + 1):
            seen[b[s : s + length]] = seen.get(b[s : s + length], 0) + 1
    out = []
    for (k, _), b in zip(rows, texts):
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((k, len(b), bytes(np.frombuffer(b, np.uint8)[~gone]), spans))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_bytes"], bytes(r["kept"]), len(r["spans"])) for r in df.collect()), key=repr)


def words(rnd, n):
    return " ".join(rnd.choice(["la", "dé", "kor", "mist", "u", "fenna", "tro"]) for _ in range(n))


def rows(seed=3):
    rnd = random.Random(seed)
    passage, other = words(rnd, 130), words(rnd, 150)
    out = [(i, words(rnd, 300)) for i in range(6)]
    out += [(10 + i, words(rnd, 40) + passage + words(rnd, 60)) for i in range(8)]
    out += [(30, passage + " " + other), (31, other + passage), (32, other + "x" + other)]
    out += [(40, None), (41, ""), (42, "short"), (43, passage), (43, passage), (None, other)]
    near = words(rnd, 400)
    out += [(50 + i, near[: 300 * (i + 1)] + "#" + near[300 * (i + 1) :]) for i in range(5)]
    out += [(60, "a" * 1000), (61, "ab" * 500), (62, words(rnd, 5000) + near)]
    return out


def test_against_brute_force(documents):
    assert result(suffix_dedup.remove_repeats(documents(rows()), 400)) == brute(rows(), 400)


def test_hot_leads_are_counted_window_by_window(documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", 3)
    assert result(suffix_dedup.remove_repeats(documents(rows(5)), 400)) == brute(rows(5), 400)


def test_texts_longer_than_a_stretch(documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", 1000)
    assert result(suffix_dedup.remove_repeats(documents(rows(7)), 400)) == brute(rows(7), 400)


def test_empty_table(documents):
    assert suffix_dedup.remove_repeats(documents([]), 400).collect() == []


def test_multikey_quicksort_keeps_equal_windows_only():
    rnd = random.Random(1)
    data = bytes(rnd.choice(b"ab") for _ in range(4000))
    for length in (5, 8, 13):
        starts = np.arange(len(data) - length + 1)
        count = {}
        for s in starts:
            count[data[s : s + length]] = count.get(data[s : s + length], 0) + 1
        want = [s for s in starts if count[data[s : s + length]] > 1]
        got = suffix_dedup.equal_windows(data, starts.copy(), length)
        assert sorted(got.tolist()) == want
        assert [data[s : s + length] for s in got] == sorted(data[s : s + length] for s in want)
