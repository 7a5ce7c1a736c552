"""Cleaning, tokens, stems and sources on small frames with known answers."""

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions.stem import stem, stem_table
from corpusloom.operators import clean, tokens as T
from corpusloom.sources import posts as P
from corpusloom.sources.vectors import read_word_vectors

POST = [
    "From: a@b.edu", "Subject: x", "", "In article <1@x.edu> bob writes:", "> quoted", "}quoted too",
    "|piped", "A real line 1.", "a", "a>b", "He writes...", "   indented text", "-- ", "sig", "later",
]


def lines(spark, post=POST):
    rows = [("g", "1", n + 1, t) for n, t in enumerate(post)]
    return spark.createDataFrame(rows, "newsgroup string, id string, line_no int, text string")


def as_post(df):
    packed = F.array_sort(F.collect_list(F.struct("line_no", "text"))).alias("lines")
    return df.groupBy("newsgroup", "id").agg(packed)


def test_header_and_signature_both_shapes(spark):
    body = clean.strip_header_and_signature(lines(spark))
    assert sorted(r.line_no for r in body.collect()) == list(range(3, 13))
    rows = as_post(lines(spark)).withColumn("lines", clean.body_of(F.col("lines")))
    assert sorted(r.line_no for r in clean.to_lines(rows).collect()) == list(range(3, 13))


def test_quotes_and_merge(spark):
    kept = clean.strip_quotes(clean.strip_header_and_signature(lines(spark)))
    assert sorted(r.line_no for r in kept.collect()) == [8, 12]
    assert clean.merge_lines(kept).head().post_txt == "A real line 1.    indented text"
    assert clean.clean_posts(as_post(lines(spark))).head().post_txt == "A real line 1.    indented text"


def test_dash_in_header_or_no_blank_line_removes_post(spark):
    for post in (["-x", "", "text 1"], ["head", "text 1"]):
        assert clean.strip_header_and_signature(lines(spark, post)).count() == 0
        assert clean.clean_posts(as_post(lines(spark, post))).count() == 0


def test_tokens_and_ngrams(spark):
    text = "Mail bob@x.edu at https://a.b/c?d now: #tag don't 12.5 well-known 'cat's'"
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    toks = T.tokenise(df).head().toks
    assert toks == ["Mail", "bob@x.edu", "at", "now", "tag", "don't", "well-known", "cat's"]
    one = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    assert [r.g for r in one.select(X.ngrams(F.col("t"), 2).alias("g")).collect()] == [["a_b", "b_c"], [], []]
    assert one.select(X.ngrams(F.col("t"), 3).alias("g")).head().g == ["a_b_c"]
    clean_toks = T.classify_tokens(df).head().toks
    assert clean_toks == ["mail", "now", "tag", "well-known", "cat's"]


def test_presets_differ_in_order(spark):
    df = spark.createDataFrame([(1, "the cat's house of cards")], "doc_id int, text string")
    assert T.classify_tokens(df, bigrams=True).head().toks == [
        "cat's", "house", "cards", "cat's_house", "house_cards"]
    assert "the_cat's" in T.cluster_tokens(df).head().toks
    assert T.embed_tokens(df).head().toks == ["cat", "house", "cards"]


def test_stems(spark):
    pairs = {
        "consistency": "consist", "knightly": "knight", "running": "run", "hopping": "hop",
        "hoping": "hope", "relational": "relat", "generously": "generous", "skies": "sky",
        "cries": "cri", "ties": "tie", "happily": "happili", "conditional": "condit",
        "nationalism": "nation", "proceed": "proceed", "dying": "die", "news": "news",
        "consolation": "consol", "agreed": "agre", "sensational": "sensat", "kneel": "kneel",
    }
    assert {w: stem(w) for w in pairs} == pairs
    df = spark.createDataFrame([(w,) for w in pairs], "term string")
    assert {r.term: r.stem for r in stem_table(df).collect()} == pairs


def test_read_posts_and_csv(spark, tmp_path):
    for split in ("train", "test"):
        folder = tmp_path / split / "sci.x"
        folder.mkdir(parents=True)
        (folder / "10").write_text("From: a\n\nLine, \"quoted\" one\nLine two\n")
    raw = P.read_split_posts(spark, str(tmp_path))
    assert raw.count() == 2
    row = raw.where("split = 'train'").head()
    assert (row.newsgroup, row.id, [x.line_no for x in row.lines]) == ("sci.x", "10", [1, 2, 3, 4])
    folder = P.read_folder(spark, str(tmp_path / "train" / "sci.x"))
    assert folder.count() == 4 and {r.id for r in folder.collect()} == {"10"}
    cleaned = clean.clean_posts(raw.where("split = 'train'")).select("newsgroup", "id", "post_txt")
    P.write_clean_csv(cleaned, str(tmp_path / "csv"))
    P.write_clean(cleaned, str(tmp_path / "pq"))
    want = [("sci.x", "10", 'Line, "quoted" one Line two')]
    assert [tuple(r) for r in P.read_clean_csv(spark, str(tmp_path / "csv")).collect()] == want
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "pq")).collect()] == want


def test_read_word_vectors(spark, tmp_path):
    (tmp_path / "v.txt").write_text("the 0.5 -1.25\ncat 1 2\n")
    rows = {r.term: list(r.vec) for r in read_word_vectors(spark, str(tmp_path / "v.txt")).collect()}
    assert rows == {"the": [0.5, -1.25], "cat": [1.0, 2.0]}


def test_text_of_a_task_is_bounded(spark, monkeypatch):
    """Ten times the text makes ten times the tasks, whatever the settings of the session."""
    monkeypatch.setattr(T, "TEXT_BYTES", 1000)
    rows = spark.createDataFrame([(i, "word " * 20) for i in range(200)] + [(200, None)], "doc_id bigint, text string")
    assert T.colocate(rows).rdd.getNumPartitions() == 20
    assert T.colocate(rows.where("doc_id < 20")).rdd.getNumPartitions() == 2
    assert T.colocate(rows.where("false")).rdd.getNumPartitions() == 1
