"""Byte-level BPE encoding and decoding with a pair occurrence index.

A partition's distinct pre-tokens are laid end to end as one symbol array.
An index maps every mergeable adjacent pair to all its positions in that
array; the active ranks are taken in ascending order, each merge is applied
at all its positions at once, and only the lists of the pairs beside them
are updated. A rank's merge can only create pairs of other ranks, which join
the queue; so every pre-token sees its merges in the order in which the
tokenizer itself would apply them.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from racelake.llm.common import doc_steps, give_back, id_and_text, utf8

# The byte-level pre-token pattern (fixed by the vocabulary); White_Space is
# spelt out because the regex library's \s also takes \x1c-\x1f.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
# The same pre-tokens by the faster standard library, for texts without the
# characters the two libraries class differently.
_PLAIN = re.compile(r" ?[^\W\d_]+|'s|'t|'re|'ve|'m|'ll|'d| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+").findall
_FULL = regex.compile(PATTERN).findall
_OTHER = re.compile("[\x1c-\x1f²³¹¼½¾\u0250-\U0010ffff]").search


def pretokens(text: str) -> list[str]:
    return _FULL(text) if _OTHER(text) else _PLAIN(text)


# Distinct pre-tokens merged in one index, and kept encoded per worker.
INDEX_WORDS = 200_000
CACHE_WORDS = 400_000
# A rank with that many positions or more is applied by numpy at once.
MANY = 32


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte, by the rule of
    byte-level vocabularies: printable Latin-1 bytes stand for themselves,
    the others for the code points from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tables of a byte-level BPE file (tokenizers' JSON): token bytes, merge
    ranks by id pair, special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        vocab = spec["model"]["vocab"]
        self.bytes: dict[int, bytes] = {
            i: bytes(symbols[c] for c in token) for token, i in vocab.items()}
        self.byte_id = {b[0]: i for i, b in self.bytes.items() if len(b) == 1}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes.update({i: text.encode() for text, i in self.special.items()})
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = rank, vocab[a + b]
        # The same as arrays: pairs as one number each, in order, with ranks.
        self.base = max(self.bytes) + 1
        keys = np.array([a * self.base + b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.keys = np.r_[keys[order], np.iinfo(np.int64).max]
        self.key_ranks = np.r_[np.array([r for r, _ in self.merges.values()], np.int64)[order], -1]
        self.ints = [0] * self.base  # the very objects that the tables hold
        for i in self.bytes:
            self.ints[i] = i
        self.byte_ids = np.array([self.byte_id[i] for i in range(256)], np.int64)
        self.pair_of = [p for p, _ in sorted(self.merges.items(), key=lambda x: x[1][0])]
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, -1 where there is none."""
        pair = a * self.base + b
        at = np.searchsorted(self.keys, pair)
        return np.where((self.keys[at] == pair) & (a >= 0) & (b >= 0), self.key_ranks[at], -1)

    def split(self, text: str) -> list[str]:
        """Pre-tokens in order; a special string is one item."""
        if self.cut is None or not any(s in text for s in self.special):
            return pretokens(text)
        out: list[str] = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out += pretokens(part)
        return out


def merge_all(words: list[str], v: Vocabulary) -> list[list[int]]:
    """Token ids of each pre-token, merged through one pair index. A rank
    with many positions is applied by numpy, one with few step by step."""
    lengths = np.array([len(w.encode()) for w in words], np.int64)
    raw = np.frombuffer("".join(words).encode(), np.uint8)
    n = len(raw) + len(words)
    # A separator, which no pair reaches over, behind each word; one more at
    # the end, which the first symbol's left neighbour (-1) is too.
    sym = np.full(n + 1, -1, np.int64)
    sym[np.arange(len(raw)) + np.repeat(np.arange(len(words)), lengths)] = v.byte_ids[raw]
    nxt, prv = np.arange(1, n + 2), np.arange(-1, n)
    where: dict[int, list[int]] = {}
    active: list[int] = []

    def note(places: np.ndarray, ranks: np.ndarray) -> None:
        held = ranks >= 0
        places, ranks = places[held], ranks[held]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, flat = ranks[order], places[order].tolist()
        edges = np.flatnonzero(np.diff(ranks)) + 1
        for rank, lo, hi in zip(ranks[np.r_[0, edges]].tolist(), [0, *edges.tolist()], [*edges.tolist(), len(flat)]):
            listed = where.get(rank)
            if listed is None:
                where[rank] = flat[lo:hi]
                heapq.heappush(active, rank)
            else:
                listed += flat[lo:hi]

    note(np.arange(n), v.ranks(sym[:-1], sym[1:]))
    while active:
        rank = heapq.heappop(active)
        places = where.pop(rank, None)
        if places is None:
            continue
        a, b = v.pair_of[rank]
        new = v.merges[a, b][1]
        if a != b and len(places) >= MANY:
            p = np.sort(np.array(places))
            # Two merges of one rank can note the pair between them twice,
            # and earlier merges may have taken one of a pair's two symbols.
            p = p[np.r_[True, p[1:] != p[:-1]] & (sym[p] == a) & (sym[nxt[p]] == b)]
            j = nxt[p]
            k = nxt[j]
            sym[p], sym[j] = new, -2
            nxt[p], prv[k] = k, p
            note(p, v.ranks(sym[p], sym[k]))
            h = prv[p]
            note(h, v.ranks(sym[h], sym[p]))
            continue
        for i in sorted(set(places)):
            j = int(nxt[i])
            if sym[i] != a or sym[j] != b:
                continue
            k = int(nxt[j])
            sym[i], sym[j] = new, -2
            nxt[i], prv[k] = k, i
            h = int(prv[i])
            for at, pair in ((i, (new, int(sym[k]))), (h, (int(sym[h]), new))):
                m = v.merges.get(pair)
                if m is not None:
                    if m[0] not in where:
                        where[m[0]] = []
                        heapq.heappush(active, m[0])
                    where[m[0]].append(at)
    kept = sym != -2
    ends = np.cumsum(kept)[np.cumsum(lengths + 1) - 1].tolist()  # each just behind its word's separator
    flat = list(map(v.ints.__getitem__, sym[kept].tolist()))  # one object per id, not per place
    return [flat[p:q - 1] for p, q in zip([0, *ends], ends)]


class Encoder:
    """Encodes batches of texts; keeps up to CACHE_WORDS encoded pre-tokens
    besides those of the batch, in two halves: words in use move to the
    younger half, and when that is full the older one is dropped. Memory
    does not grow with the partition."""

    def __init__(self, path: str):
        self.v = Vocabulary(path)
        self.known: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    def _learn(self, words: Iterable[str]) -> None:
        known, older = self.known, self.older
        new = []
        for w in words:
            if w not in known:
                ids = older.get(w)
                if ids is None:
                    new.append(w)
                else:
                    known[w] = ids
        for i in range(0, len(new), INDEX_WORDS):
            part = new[i:i + INDEX_WORDS]
            known.update(zip(part, merge_all(part, self.v)))
        for text, number in self.v.special.items():
            known[text] = [number]

    def encode(self, texts: list[str]) -> list[list[int]]:
        split = [self.v.split(t) for t in texts]
        if len(self.known) > CACHE_WORDS // 2:
            self.known, self.older = {}, self.known
        self._learn(set().union(*split))
        ids_of = self.known.__getitem__
        return [list(chain.from_iterable(map(ids_of, words))) for words in split]

    def forget(self) -> None:
        """Drops the encoded pre-tokens; the vocabulary stays."""
        self.known, self.older = {}, {}

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.v.bytes.__getitem__, ids)).decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file (read once per worker)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def text_groups(texts: list[str], size: int = 4 << 20):
    """Index ranges of about ``size`` characters (one text at least)."""
    lo, n = 0, 0
    for i, t in enumerate(texts):
        if i > lo and n + len(t) > size:
            yield lo, i
            lo, n = i, 0
        n += len(t)
    if lo < len(texts):
        yield lo, len(texts)


# Bytes of text that are split and encoded at a time.
STEP_BYTES = 1 << 20


def _encoded(batches, path: str):
    """(ids of the documents, their token ids, the encoder) for runs of whole
    documents. What a task has learnt goes with it: a worker outlives its
    task, and would hold that memory while tasks of other kinds run."""
    enc = encoder(path)
    try:
        for b in batches:
            if not b.num_rows:
                continue
            _, bounds = utf8(b.column(1))
            for lo, hi in doc_steps(bounds, STEP_BYTES):
                part = b.slice(lo, hi - lo)
                yield part.column(0), enc.encode(part.column(1).to_pylist()), enc
    finally:
        enc.forget()
        give_back()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``ids`` (array<int>). ``path`` is the
    vocabulary file, present on every executor. NULL texts are empty and have
    no ids. No shuffle; recomputed tasks give the same rows."""
    def run(batches):
        for doc_id, ids, _ in _encoded(batches, path):
            yield pa.RecordBatch.from_arrays([doc_id, pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``text`` from ``doc_id``, ``ids`` (NULL ids: NULL text)."""
    def run(batches):
        enc = encoder(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([None if x is None else enc.decode(x)
                                        for x in b.column(1).to_pylist()], pa.string())],
                ["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Round trip without moving the ids: per document ``doc_id``,
    ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas) and
    ``decoded_sha256`` (UTF-8 of the text decoded from those ids)."""
    def run(batches):
        decimal = {i: str(i) for i in encoder(path).v.bytes}
        sha = hashlib.sha256
        for doc_id, encoded, enc in _encoded(batches, path):
            rows = [(len(ids), sha(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest(),
                     sha(enc.decode(ids).encode()).hexdigest()) for ids in encoded]
            yield pa.RecordBatch.from_arrays([doc_id, *(pa.array(c) for c in zip(*rows))],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
