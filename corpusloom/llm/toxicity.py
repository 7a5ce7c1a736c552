"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its words and the beginnings of words, hashed: whether one occurs, occurs
twice, and occurs often for the length of the text. Terms that tell the classes apart are chosen by
their chi-square over the training rows, where copies count once. A factorization machine (Spark ML) gives each chosen term
a weight and a vector; products of vectors stand for pairs of terms, so two terms that are harmless
alone can be toxic together. It is fitted on at most `most_rows` labelled rows, chosen by hash; all
texts are scored, each over its whole length.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import Batches, mapped, stored, text_or_empty
from corpusloom.llm.words import PrefixHash, mixed

SPACE = 1 << 22  # hashed terms
BEGINNINGS = (5, 6, 7)  # bytes of words
LEAST_CHI = 30.0  # below this a term can look telling by chance, among so many
SETTLED = 1e-3  # change of the parameters in a round, as a share of their length, that ends the fit
OFTEN = 200  # at least two occurrences, and one per so many words
STRETCH = 1 << 20

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def _hashed(owner: np.ndarray, hashes: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """owner * SPACE + term for terms that occur, occur twice, occur often."""
    place = (hashes >> np.uint64(24)) % np.uint64(SPACE)
    code, times = np.unique(owner * SPACE + place.astype(np.int64), return_counts=True)
    twice = times > 1
    often = twice & (times * OFTEN >= lengths[code // SPACE])

    def other(c, salt):
        moved = mixed((c % SPACE).astype(np.uint64) + np.uint64(salt << 32)) % np.uint64(SPACE)
        return c // SPACE * SPACE + moved.astype(np.int64)

    return [code, other(code[twice], 1), other(code[often], 2)]


def terms(texts: list[str], prefix: PrefixHash) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and hashed terms of texts, ordered, each pair once."""
    raw = [t.lower().encode() for t in texts]
    view = np.frombuffer(b"\n".join(raw), np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], _LETTER[view], [False]]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    owner = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), starts, side="right")
    lengths = np.bincount(owner, minlength=len(texts))
    found = _hashed(owner, prefix.of(view, starts, ends), lengths)
    for n in BEGINNINGS:
        longer = ends - starts > n
        hashes = mixed(prefix.of(view, starts[longer], starts[longer] + n) + np.uint64(n))
        found += _hashed(owner[longer], hashes, lengths)
    codes = np.unique(np.concatenate(found))
    return codes // SPACE, codes % SPACE


def _stretches(batch: pa.RecordBatch):
    """Rows of a batch in stretches of about STRETCH characters: slice and texts."""
    texts = batch.column("text").to_pylist()
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= STRETCH or i == len(texts) - 1:
            yield batch.slice(at, i + 1 - at), texts[at : i + 1]
            at, size = i + 1, 0


def _term_counts(batches: Batches) -> Batches:
    """Per partition: term, rows of label 1 with it, rows of label 0 with it; term -1 counts rows."""
    prefix = PrefixHash()
    with_term = np.zeros((2, SPACE), np.int64)
    rows = np.zeros(2, np.int64)
    for batch in batches:
        for part, texts in _stretches(batch):
            label = part.column("toxic").to_numpy()
            owner, term = terms(texts, prefix)
            for y in (0, 1):
                with_term[y] += np.bincount(term[label[owner] == y], minlength=SPACE)
                rows[y] += int((label == y).sum())
    used = np.flatnonzero(with_term.sum(axis=0) > 0)
    columns = [np.append(used, -1), np.append(with_term[1][used], rows[1]), np.append(with_term[0][used], rows[0])]
    yield pa.record_batch([pa.array(c) for c in columns], names=["term", "ones", "zeros"])


def _chosen_terms(batches: Batches, chosen: np.ndarray) -> Batches:
    """label and the chosen terms of each text, by their place among the chosen."""
    prefix = PrefixHash()
    where = np.full(SPACE, -1)
    where[chosen] = np.arange(len(chosen))
    for batch in batches:
        for part, texts in _stretches(batch):
            owner, term = terms(texts, prefix)
            known = where[term] >= 0
            owner, place = owner[known], where[term[known]]
            cuts = np.searchsorted(owner, np.arange(1, len(texts)))
            words = [[str(t) for t in x.tolist()] for x in np.split(place, cuts)]
            label = part.column("toxic").to_numpy().astype(float)
            yield pa.record_batch([pa.array(label), pa.array(words, pa.list_(pa.string()))], names=["label", "terms"])


class Model:
    """Chosen terms with weights and vectors; without chosen terms a constant."""

    def __init__(self, chosen: np.ndarray, intercept: float, weights: np.ndarray, factors: np.ndarray):
        self.chosen, self.intercept, self.weights, self.factors = chosen, intercept, weights, factors

    def scores(self, owner: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
        raw = self.intercept + np.bincount(owner, self.weights[place], minlength=n)
        for v in self.factors.T:
            x = v[place]
            raw += (np.bincount(owner, x, minlength=n) ** 2 - np.bincount(owner, x * x, minlength=n)) / 2
        return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def fit(
    docs: DataFrame, labels: DataFrame, most_rows: int = 20_000, most_terms: int = 1_000, factors: int = 4, rounds: int = 1_000
) -> Model:
    """A model of labels (doc_id, toxic 0 or 1) on docs (doc_id, text).

    Of a document with several labels the largest counts; null labels and other values are left
    out. Terms are chosen over distinct texts (their words and label). The fit ends when the
    parameters settle, at the latest after `rounds`. Without rows of both labels the model is the share of label 1 (0 without rows).
    """
    spark = docs.sparkSession
    marked = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    rows = stored(docs.select("doc_id", text_or_empty()).join(F.broadcast(sample), "doc_id").select("text", "toxic"), "labelled")
    rows = rows.repartition(spark.sparkContext.defaultParallelism)
    words = F.trim(F.regexp_replace(F.lower("text"), "[\\x00-\\x60\\x7b-\\x7f]+", " "))
    once = rows.withColumn("_words", F.sha2(words, 256)).dropDuplicates(["_words", "toxic"]).select("text", "toxic")
    counts = (
        mapped(once, _term_counts, "term long, ones long, zeros long")
        .groupBy("term")
        .agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    )
    counts = stored(counts, "terms")
    totals = counts.filter("term = -1").first()
    ones, zeros = (totals["ones"], totals["zeros"]) if totals else (0, 0)
    if not ones or not zeros:
        share = ones / max(ones + zeros, 1)
        return Model(np.zeros(0, np.int64), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))), np.zeros(0), np.zeros((0, 1)))
    a, b = F.col("ones"), F.col("zeros")
    n, c, d = ones + zeros, ones - a, zeros - b
    chi = n * F.pow(a * d - b * c, 2) / ((a + b) * (c + d + 1e-9) * float(ones) * float(zeros))
    best = (
        counts.filter("term >= 0")
        .withColumn("chi", chi)
        .filter(F.col("chi") >= LEAST_CHI)
        .orderBy(F.desc("chi"), "term")
        .limit(most_terms)
    )
    chosen = np.array(sorted(r["term"] for r in best.collect()), np.int64)  # at most most_terms
    if not len(chosen):
        return Model(chosen, float(np.log(ones / zeros)), np.zeros(0), np.zeros((0, 1)))
    lists = mapped(rows, partial(_chosen_terms, chosen=chosen), "label double, terms array<string>")
    sparse = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(len(chosen))], inputCol="terms", outputCol="features"
    ).setMinTF(1.0)
    data = sparse.transform(lists).select("label", "features").cache()
    machine = FMClassifier(
        factorSize=factors, maxIter=rounds, tol=SETTLED, stepSize=0.05, regParam=0.0, solver="adamW", seed=7, initStd=0.01
    ).fit(data)
    data.unpersist()
    return Model(chosen, float(machine.intercept), machine.linear.toArray(), machine.factors.toArray())


def _score(batches: Batches, model: Model) -> Batches:
    prefix = PrefixHash()
    where = np.full(SPACE, -1)
    where[model.chosen] = np.arange(len(model.chosen))
    for batch in batches:
        for part, texts in _stretches(batch):
            owner, term = terms(texts, prefix)
            known = where[term] >= 0
            scores = model.scores(owner[known], where[term[known]], len(texts))
            yield pa.record_batch([*part.columns, pa.array(scores)], names=[*part.schema.names, "score"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with column score: 0 to 1, higher where toxic is likelier. A null text is scored as an
    empty one; an input column named score is replaced; no other column has influence."""
    rest = docs.drop("score").withColumn("text", text_or_empty())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema) + ", score double"
    return mapped(rest, partial(_score, model=model), schema)
