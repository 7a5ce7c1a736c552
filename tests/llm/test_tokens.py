import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusloom.llm import packing, token_files, words

PATH = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    "", None, "a<|endoftext|>b İstanbul ΑΣ x", "İ ß ẞ Σας it's o'clock's don'tx 123 a1b2 ..a.. é é ́x \xa0a\xa0b",
    "\x1c a\x1db", "K ſ Å ", "a.b,c 's 't 'S x'S. x'ſ", "日本語 テスト。　x", "µ µm", "a​b  c", "word.%%% (x)", "\n\n",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_tokenizer(tokenizer, spark, sf, monkeypatch):
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").limit(150).collect()]
    for stretch, cached in ((1 << 20, 10**6), (300, 50)):
        monkeypatch.setattr(words, "STRETCH", stretch)
        monkeypatch.setattr(words, "CACHED_WORDS", cached)
        got = list(words.WordIds(PATH).ids(texts))
        assert [g.tolist() for g in got] == [ids(tokenizer, t) for t in texts]


def test_token_files_read_back(tokenizer, spark, documents, tmp_path):
    rows = [(i * 3 % 31, t) for i, t in enumerate(ODD)] + [(99, "twice"), (99, "twice")]
    path = str(tmp_path / "tokens")
    token_files.write_token_files(documents(rows), path, PATH, end_id=1)
    got = sorted(tuple(r) for r in token_files.token_digests(spark, path).collect())
    start, want = 0, []
    for key, text in sorted(rows, key=lambda r: r[0]):
        all_ids = np.array(ids(tokenizer, text) + [1], "<u4")
        want.append((key, start, len(all_ids), zlib.crc32(all_ids)))
        start += len(all_ids)
    assert got == sorted(want)
    assert {r["doc_id"] for r in token_files.read_token_files(spark, path, [3, 99]).collect()} == {3, 99}


def test_token_files_of_nothing(spark, documents, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_token_files(documents([]), path, PATH, end_id=1)
    assert token_files.token_digests(spark, path).collect() == []


def check_packed(rows, texts, tokenizer, capacity):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for key, text in texts:
        all_ids, at = np.array(ids(tokenizer, text) + [2], "<u4"), 0
        for r in sorted(by_doc[key], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(all_ids))
            assert r["ids_crc32"] == zlib.crc32(all_ids[at : at + r["length"]])
            at += r["length"]
        assert at == len(all_ids)
    for part in by_sequence.values():
        at = 0
        for r in sorted(part, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return 1 - sum(r["length"] for r in rows) / capacity / max(len(by_sequence), 1)


def test_packing(tokenizer, spark, sf, documents):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts += [(1000 + i, t) for i, t in enumerate(ODD)] + [(5000, "long tale " * 9000)]
    docs = documents(texts)
    packed = packing.pack_documents(docs, PATH)
    assert check_packed(packed.collect(), texts, tokenizer, 4096) < 0.02
    full = packing.sequences(docs, packed, PATH).collect()
    assert all(len(r["ids"]) == 4096 for r in full)
    assert sum(r["n_ids"] for r in full) == sum(len(ids(tokenizer, t)) + 1 for _, t in texts)


def test_packing_of_nothing_and_of_repeated_rows(documents):
    assert packing.pack_documents(documents([]), PATH).collect() == []
    rows = packing.pack_documents(documents([(1, "same"), (1, "same")]), PATH).collect()
    assert len(rows) == 2 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 2


def test_patterns_place_all_pieces_with_little_waste():
    rng = np.random.default_rng(5)
    sizes = np.array([*range(1, 8), *range(8, 64, 8)])
    demand = rng.integers(0, 4000, len(sizes))
    patterns = packing.patterns_for(sizes, demand, 64)
    assert (sum(a * n for a, n in patterns) == demand).all()
    assert all((a * sizes).sum() <= 64 for a, _ in patterns)
    assert sum(n for _, n in patterns) <= 1.005 * (sizes * demand).sum() / 64 + len(sizes)


def test_best_pattern_against_enumeration():
    sizes, worth = np.array([3, 5, 7]), np.array([0.29, 0.52, 0.71])
    value, pattern = packing.best_pattern(sizes, worth, 17)
    every = [(a * 0.29 + b * 0.52 + c * 0.71) for a in range(6) for b in range(4) for c in range(3) if 3 * a + 5 * b + 7 * c <= 17]
    assert abs(value - max(every)) < 1e-12 and abs((pattern * worth).sum() - value) < 1e-12
