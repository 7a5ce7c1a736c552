"""Fitted models in folders: their tables, then a note of kind, version and settings.

The note is written last and read first, so a folder is a model only when all of it is there.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession

from corpusloom.operators.gibbs import Corpus, Topics
from corpusloom.operators.lsa import Lsa
from corpusloom.operators.trees import BaggedForest

VERSION = 1


class NotAModel(ValueError):
    """The folder holds no finished model of the kind and version asked for."""


def _write(path: str, kind: str, tables: dict[str, DataFrame], settings: dict) -> None:
    for name, table in tables.items():
        table.write.parquet(f"{path}/{name}")
    spark = next(iter(tables.values())).sparkSession
    note = spark.createDataFrame([(kind, VERSION, json.dumps(settings))], "kind string, version int, settings string")
    note.coalesce(1).write.parquet(f"{path}/note")


def _read(spark: SparkSession, path: str, kind: str) -> dict:
    try:
        note = spark.read.parquet(f"{path}/note").head()
    except AnalysisException as e:
        raise NotAModel(f"{path} holds no finished model") from e
    if (note["kind"], note["version"]) != (kind, VERSION):
        raise NotAModel(f"{path} holds {note['kind']} of version {note['version']}, not {kind} of version {VERSION}")
    return json.loads(note["settings"])


def save_lsa(model: Lsa, path: str) -> None:
    _write(path, "lsa", {"terms": model.terms, "documents": model.documents}, {"s": [float(x) for x in model.s]})


def load_lsa(spark: SparkSession, path: str) -> Lsa:
    s = np.array(_read(spark, path, "lsa")["s"])
    return Lsa(s, spark.read.parquet(f"{path}/terms"), spark.read.parquet(f"{path}/documents"))


TOPIC_TABLES = ("chains", "state", "counts", "trace")


def save_topics(model: Topics, path: str) -> None:
    tables = {name: getattr(model, name) for name in TOPIC_TABLES}
    tables |= {"blocks": model.corpus.blocks, "places": model.corpus.places}
    _write(path, "topics", tables, {"terms": model.corpus.terms})


def load_topics(spark: SparkSession, path: str) -> Topics:
    terms = _read(spark, path, "topics")["terms"]

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{path}/{name}")

    return Topics(Corpus(table("blocks"), table("places"), terms), *(table(name) for name in TOPIC_TABLES))


def save_forest(model: BaggedForest, path: str) -> None:
    for bag, part in enumerate(model.models):
        part.write().save(f"{path}/bag-{bag}")
    _write(path, "forest", {"data": model.data}, {"labels": model.labels, "seed": model.seed, "bags": len(model.models)})


def load_forest(spark: SparkSession, path: str) -> BaggedForest:
    note = _read(spark, path, "forest")
    models = [RandomForestClassificationModel.load(f"{path}/bag-{bag}") for bag in range(note["bags"])]
    return BaggedForest(models, note["labels"], note["seed"], spark.read.parquet(f"{path}/data"))
