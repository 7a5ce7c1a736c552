"""Secrets in texts: fixed forms, and strings that a tokenizer's vocabulary spells inefficiently.

Known forms (assignments to names such as password, access keys, long hexadecimal runs) are found
by pattern. Beside them, a run of characters of keys that needs many tokens for its length is
unlike words and names: below `most_chars_per_token` characters per token it counts as random.
Known digests (hexadecimal runs of usual digest lengths) and identifiers (UUIDs, numbers, names whose
parts are all in the vocabulary, by one token or two long ones) are no secrets by that test.
"""

from __future__ import annotations

import base64
import re
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import Batches, mapped, text_or_empty

# The patterns of known forms, and the least lengths of their matches.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_VALUE = 8
ACCESS = re.compile("AKIA[A-Z0-9]+")
ACCESS_LENGTH = 16
HEX = re.compile("[0-9a-f]+")
HEX_LENGTH = 32
KINDS = ("assign", "access", "hex", "random")

MOST_CHARS_PER_TOKEN = 2.0
RANDOM_LENGTH = 16  # shorter runs hold too few tokens to judge
NUMBER_LENGTH = 19  # digits of a 64-bit or card number: every number has about two of them a token
DIGEST_LENGTHS = frozenset((32, 40, 56, 64, 96, 128))
_UUID = re.compile("[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_ANY_HEX = re.compile("[0-9A-Fa-f]+")
_RUN = re.compile("[A-Za-z0-9+/_=-]+")
_PARTS = re.compile("[_/=+-]+")
_NUMBER = re.compile("v?[0-9]{0,8}")
_LIKELY = np.zeros(256, bool)
_LIKELY[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
STRETCH = 1 << 20


def load_encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _is_known(part: str, encoding: tiktoken.Encoding, most: float) -> bool:
    """Whether part of a name is a short number, one token, or two that are long for tokens of keys."""
    if _NUMBER.fullmatch(part):
        return True
    n = len(encoding.encode_ordinary(part))
    return n == 1 or n == 2 and len(part) > most * n


def is_random(run: str, encoding: tiktoken.Encoding, most: float) -> bool:
    """Whether run (of the characters of keys) is too inefficient to spell for a word or name."""
    if len(run) < RANDOM_LENGTH or _UUID.fullmatch(run):
        return False
    if len(run) in DIGEST_LENGTHS and _ANY_HEX.fullmatch(run):
        return False
    if len(run) <= NUMBER_LENGTH and run.isdigit() or len(run) > most * len(encoding.encode_ordinary(run)):
        return False
    return not all(_is_known(p, encoding, most) for p in _PARTS.split(run))


def _likely_runs(data: bytes) -> list[tuple[int, int]]:
    """Byte ranges of runs of characters of keys that reach the least length of any test."""
    inside = np.concatenate([[False], _LIKELY[np.frombuffer(data, np.uint8)], [False]])
    edge = np.flatnonzero(np.diff(inside.astype(np.int8)))
    a, b = edge[0::2], edge[1::2]
    long = b - a >= ACCESS_LENGTH
    return list(zip(a[long].tolist(), b[long].tolist()))


def spans_of(text: str, runs: list[tuple[int, int]], encoding: tiktoken.Encoding, most: float):
    """(kind, start, end) in code points, by start and then kind; runs as from _likely_runs."""
    found = []
    lower = text.lower()
    if any(name in lower for name in ASSIGN_NAMES):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if runs:
        data = text.encode()
        points = None if text.isascii() else np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) - 1
        for a, b in runs:
            run = data[a:b].decode()
            start = a if points is None else int(points[a])
            found += [
                (kind, start + m.start(), start + m.end())
                for kind, pattern, least in (("access", ACCESS, ACCESS_LENGTH), ("hex", HEX, HEX_LENGTH))
                for m in pattern.finditer(run)
                if m.end() - m.start() >= least
            ]
            if is_random(run, encoding, most):
                found.append(("random", start, start + b - a))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _scan(batches: Batches, path: str, most: float) -> Batches:
    encoding = load_encoding(path)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        texts = batch.column("text").to_pylist()
        out, at = [], 0
        while at < len(texts):  # runs are sought in stretches of several texts
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size < STRETCH):
                size += len(texts[stop])
                stop += 1
            raw = [t.encode() for t in texts[at:stop]]
            ends = np.cumsum([len(r) + 1 for r in raw])
            runs: dict[int, list[tuple[int, int]]] = {}
            for a, b in _likely_runs(b"\n".join(raw)):
                i = int(np.searchsorted(ends, a, side="right"))
                before = int(ends[i - 1]) if i else 0
                runs.setdefault(i, []).append((a - before, b - before))
            for i, text in enumerate(texts[at:stop]):
                out.append([{"kind": k, "start": a, "end": b} for k, a, b in spans_of(text, runs.get(i, []), encoding, most)])
            at = stop
        names = [*batch.schema.names, "spans"]
        yield pa.record_batch([*batch.columns, pa.array(out, kind)], names=names)


def scan(docs: DataFrame, vocabulary: str, most_chars_per_token: float = MOST_CHARS_PER_TOKEN) -> DataFrame:
    """docs with column spans: array of (kind, start, end), ends exclusive, in code points.

    Row by row over the whole text: no shuffle, and no state between rows. A null text comes back as an
    empty one without spans; an input column named spans is replaced; very long texts
    are read whole. vocabulary is the path of a file of tiktoken ranks.
    """
    rest = docs.drop("spans").withColumn("text", text_or_empty())
    kind = "array<struct<kind: string, start: bigint, end: bigint>>"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema) + f", spans {kind}"
    return mapped(rest, partial(_scan, path=vocabulary, most=most_chars_per_token), schema)


def joined(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """text with every span replaced by mark; spans that overlap or touch share one mark."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def add(state, s):
        fresh = (s["start"] > state["at"]) | (state["at"] == 0)
        gap = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        out = F.when(fresh, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"])
        return F.struct(out.alias("out"), F.greatest(state["at"], s["end"]).alias("at"))

    return F.when(
        F.size(spans) > 0,
        F.aggregate(spans, start, add, lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text)))),
    ).otherwise(text)
