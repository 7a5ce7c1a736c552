import pytest


@pytest.fixture(scope="session", autouse=True)
def shared(spark, tmp_path_factory):
    """The folder that stands for the cluster's shared one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


@pytest.fixture
def documents(spark):
    """A table of documents with columns that clash with names inside the operators."""

    def make(rows):
        kind = "doc_id long, text string, lang string, source string, n_chars long, label int, key string, spans string"
        full = [(k, t, "en", "src0", len(t or ""), 1, "x", "y") for k, t in rows]
        return spark.createDataFrame(full, kind)

    return make
