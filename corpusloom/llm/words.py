"""Token ids of whole texts: every distinct word of a stretch of text is tokenized once."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Iterator, Sequence

import numpy as np
from tokenizers import Tokenizer

STRETCH = 2 << 20  # characters that are handled at once
CACHED_WORDS = 1_500_000  # bounds the table of known words, about 40 bytes each

_ALONE = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")  # texts with these go to the tokenizer whole
_LETTERS = re.compile("[a-zß-öø-ÿ]+")
_SPACE = re.compile("[ \t\n\r]")
_ODD = 0x9E3779B97F4A7C15  # an odd multiplier, so that it has an inverse modulo 2**64

_KIND = np.zeros(256, np.uint8)  # 1: white space, 2: a-z, 4: marks that always start a new word after a-z
_KIND[[32, *range(9, 14)]] = 1
_KIND[97:123] = 2
_KIND[list(b".,;:!?#$%&*")] = 4


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base % 2**64, np.uint64)
    p[0] = 1
    return np.cumprod(p)


class PrefixHash:
    """Hashes of any byte ranges of one buffer, from one pass over it."""

    def __init__(self):
        self._up = self._down = np.ones(1, np.uint64)

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(data)
        if n >= len(self._up):
            self._up = _powers(_ODD, n + 1)
            self._down = _powers(pow(_ODD, -1, 2**64), n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._up[:n], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self._down[starts])


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than ASCII white space."""
    space = _KIND[data] == 1
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    return edge[0::2], edge[1::2]


def _pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """word_bounds, cut also between a letter and a mark after it."""
    kind = np.concatenate([[1], _KIND[data], [1]]).astype(np.uint8)
    here, after = kind[:-1], kind[1:]
    cut = (here == 2) & (after == 4)
    starts = np.flatnonzero(((here == 1) & (after != 1)) | cut)
    ends = np.flatnonzero(((here != 1) & (after == 1)) | cut)
    return starts, ends


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds:
    """The ids that the tokenizer gives to whole texts (without special tokens).

    Words never reach over white space in this tokenizer, nor does a run of letters go on over
    punctuation, so a text's ids are those of its words in turn. Words of plain letters go to the
    model directly; others, and texts with control strings, to the whole tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self._model = self.tokenizer.model
        self._letters = _byte_letters()
        self._hash = PrefixHash()
        self._reset()

    def _reset(self) -> None:
        self._known = np.zeros(0, np.uint64)  # ascending hashes of known words
        self._start = np.zeros(0, np.int64)  # in _flat
        self._len = np.zeros(0, np.int64)
        self._flat = np.zeros(0, np.uint32)

    def _learn(self, words: list[str], hashes: np.ndarray) -> None:
        ids: list[list[int]] = [[]] * len(words)
        other = []
        tokenize, letters = self._model.tokenize, self._letters
        for i, w in enumerate(words):
            if _LETTERS.fullmatch(w):
                if not w.isascii():
                    w = w.encode().decode("latin-1").translate(letters)
                ids[i] = [t.id for t in tokenize(w)]
            else:
                other.append(i)
        if other:
            found = self.tokenizer.encode_batch_fast([words[i] for i in other], add_special_tokens=False)
            for i, e in zip(other, found):
                ids[i] = e.ids
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        known = np.concatenate([self._known, hashes])
        order = np.argsort(known, kind="stable")
        self._known = known[order]
        self._start = np.concatenate([self._start, len(self._flat) + np.cumsum(lens) - lens])[order]
        self._len = np.concatenate([self._len, lens])[order]
        new = np.fromiter((x for w in ids for x in w), np.uint32, int(lens.sum()))
        self._flat = np.concatenate([self._flat, new])

    def _stretch(self, parts: list[str]) -> list[np.ndarray]:
        raw = [p.encode() for p in parts]
        data = b"\n".join(raw)
        view = np.frombuffer(data, np.uint8)
        starts, ends = _pieces(view)
        if not len(starts):
            return [np.zeros(0, np.uint32)] * len(parts)
        found, first, which = np.unique(self._hash.of(view, starts, ends), return_index=True, return_inverse=True)
        if len(self._known) + len(found) > CACHED_WORDS:
            self._reset()
        at = np.searchsorted(self._known, found)
        missing = at == len(self._known)
        missing[~missing] = self._known[at[~missing]] != found[~missing]
        if missing.any():
            where = first[missing]
            words = [data[a:b].decode() for a, b in zip(starts[where].tolist(), ends[where].tolist())]
            self._learn(words, found[missing])
            at = np.searchsorted(self._known, found)
        begin, lens = self._start[at][which], self._len[at][which]
        upto = np.cumsum(lens)
        ids = self._flat[np.repeat(begin - (upto - lens), lens) + np.arange(upto[-1])]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        last = np.searchsorted(starts, np.cumsum(sizes + 1))  # words before the next part
        cut = np.concatenate([[0], upto])[last].tolist()
        return [ids[a:b] for a, b in zip([0, *cut], cut)]

    def ids(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """One array per text, in order."""
        pending: list[str] = []
        owners: list[int] = []
        done: dict[int, list[np.ndarray]] = {}
        size = turn = 0

        def flush():
            nonlocal size
            for owner, part in zip(owners, self._stretch(pending)):
                done.setdefault(owner, []).append(part)
            pending.clear()
            owners.clear()
            size = 0

        for i, text in enumerate(texts):
            text = text or ""
            if any(x in text for x in _ALONE):
                done[i] = [np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)]
            else:
                if _is_latin(text):  # elsewhere lower case is left to the tokenizer
                    text = text.lower()
                for part in _cut(text):
                    pending.append(part)
                    owners.append(i)
                    size += len(part)
                    if size >= STRETCH:
                        flush()
            if size == 0 or i == len(texts) - 1:
                if pending:
                    flush()
                for j in range(turn, i + 1):
                    parts = done.pop(j)
                    yield parts[0] if len(parts) == 1 else np.concatenate(parts)
                turn = i + 1


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def worker_words(path: str) -> WordIds:
    """One WordIds per Python process, kept over its tasks: its table of words is worth keeping.

    It lives outside this module, because functions travel with the job and bring their own copy.
    """
    kept = sys.modules.setdefault("corpusloom_worker", types.ModuleType("corpusloom_worker"))
    if getattr(kept, "words_path", None) != path:
        kept.words_path, kept.words = path, WordIds(path)
    return kept.words


def _cut(text: str) -> Iterator[str]:
    """text in parts that end before white space, of about STRETCH characters."""
    at = 0
    while len(text) - at > 2 * STRETCH:
        space = _SPACE.search(text, at + STRETCH)
        if not space:
            break
        yield text[at : space.start()]
        at = space.start()
    yield text[at:] if at else text
