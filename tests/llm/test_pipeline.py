"""The pipeline on a small folder, stage by stage against plain Python."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from tests.llm import test_decontaminate, test_near_dups, test_secret_scan, test_tokens  # noqa: E402

INSULTS = ("vermin", "scumbag")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, items = test_decontaminate.table()
    rows = [(k, t) for k, t in dict(rows).items()]
    rows += [(3000 + k, t) for k, t in test_near_dups.table(80) if k is not None]
    rows += [(6000 + i, t) for i, t in enumerate(test_secret_scan.texts()[:17])]
    rows += [(8000 + i, f"you {INSULTS[i % 2]} " * 3 + f"number {i} says so") for i in range(40)]
    path = tmp_path_factory.mktemp("tables")
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    docs = [(k, t, "en", "src0", len(t or "")) for k, t in rows]
    spark.createDataFrame(docs, kind).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(k, 1, int(any(i in (t or "") for i in INSULTS))) for k, t in rows if k % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), rows, items


def test_run(spark, folder):
    path, rows, items = folder
    clean = [(k, t) for k, t in rows if not any(i in (t or "") for i in INSULTS)]
    single = {r[0] for r in test_near_dups.brute(clean, 80) if r[3]}
    bodies = [test_decontaminate.decontaminate.normal(t or "") for i, t in items if i is not None]

    def leaks(text):
        t = test_decontaminate.decontaminate.normal(text or "")
        return any(
            len(b) >= 24 and t and test_decontaminate.distance(b, t) <= len(b) // 16 for b in bodies
        )

    kept = [(k, t) for k, t in clean if k in single and not leaks(t)]
    got = corpus_pipeline.run(spark, path).collect()
    assert {r["doc_id"] for r in got} == {k for k, _ in kept}
    masked = []
    for k, t in kept:
        spans = test_secret_scan.base(t or "")
        masked.append((k, t) if not spans else None)
    plain = [m for m in masked if m and m[0] < 6000]
    from tokenizers import Tokenizer

    mine = [r for r in got if r["doc_id"] in dict(plain)]
    tokenizer = Tokenizer.from_file(test_tokens.PATH)
    for key, text in plain:
        n = len(test_tokens.ids(tokenizer, text)) + 1
        assert sum(r["length"] for r in mine if r["doc_id"] == key) == n


def test_stages_keep_the_columns_of_documents(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns


def test_secrets_are_masked(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    rows = {r["doc_id"]: r for r in corpus_pipeline.mask_secrets(spark, docs, path).collect()}
    assert len(rows) == docs.count()
    assert not any(test_secret_scan.base(r["text"] or "") for r in rows.values())
    assert rows[6002]["text"] == "plain words only" and rows[6006]["n_chars"] == len(rows[6006]["text"])


def test_empty_documents(spark, folder, tmp_path):
    path, _, _ = folder
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{path}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.read.parquet(f"{path}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_keep_null_texts_and_clashing_columns(spark, folder):
    path, _, _ = folder
    kind = "doc_id long, text string, n_chars long, score string, spans string, matches string, _rest string, no_text int"
    rows = [(1, None, None), (2, "", 0), (3, "plain words and nothing more", 28), (4, "key AKIA" + "X7" * 10, 28), (4, None, 9)]
    docs = spark.createDataFrame([(*r, "s", "p", "m", "r", 1) for r in rows], kind)
    same = sorted((tuple(r) for r in docs.collect()), key=repr)
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_contaminated, corpus_pipeline.drop_near_duplicates):
        out = stage(spark, docs, path)
        assert out.columns == docs.columns and sorted((tuple(r) for r in out.collect()), key=repr) == same, stage.__name__
    masked = corpus_pipeline.mask_secrets(spark, docs, path)
    assert masked.columns == docs.columns
    got = {r: r.text for r in masked.collect()}
    assert sorted((r.n_chars, r.text) for r in got if r.doc_id == 4 and r.text) == [(12, "key [secret]")]
    assert sorted((tuple(r) for r in got if r.text is None or r.doc_id != 4), key=repr) == [s for s in same if s[0] != 4 or s[1] is None]
    assert corpus_pipeline.mask_secrets(spark, docs.limit(0), path).isEmpty()
