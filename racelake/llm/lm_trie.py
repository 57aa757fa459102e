"""Language-model scoring with Elias-Fano bigram tries.

A trie shard has two levels. The first holds the hashes of its words in an
Elias-Fano sequence, with their counts and quantised unigram probabilities;
monotone pointers (Elias-Fano again) lead to the second, which holds for each
word its contexts (the words seen before it) as offsets relative to the
word's own range, so the whole level is one monotone sequence, with a
quantised gain per context. A lookup finds the word by successor search and
then searches the context only among the word's own successors. Levels are
bytes that are memory-mapped, never unpacked.

The model is a bigram with Dirichlet smoothing (MacKay and Peto, 1995):

    p(w | u) = (c(u w) + M p(w)) / (c(u) + M)
    p(w) = (1 - e) c(w) / N,   p(unknown) = e,   e = words seen once / N

so log p(w | u) = log p(w) + log(M / (c(u) + M)) + gain(u, w) with
gain = log(1 + c(u w) / (M p(w))) and 0 for an unseen pair: a text's score is
a plain sum over its words and pairs, and each shard adds its own part.
"""

from __future__ import annotations

import tempfile
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelake.llm.common import give_back, mix, ship_package, stored, text_bytes, text_chunks, word_hashes

END, BEGIN = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
MASS = 8.0  # M: context counts that weigh as much as the unigram
STEP = 1 / 2048  # quantum of stored log10 values (16 bits: up to 32)
SHARD_TEXT_BYTES = 8 << 20


# --- Elias-Fano ------------------------------------------------------------

class EliasFano:
    """A monotone sequence of n values: ``low`` bits of each packed, the rest
    as unary gaps. Made with ``encode``; reads a buffer in place."""

    def __init__(self, raw):
        self.n, self.low_bits, low_bytes, high_bytes = (int(x) for x in np.frombuffer(raw, "<i8", 4))
        self.low = np.frombuffer(raw, np.uint8, low_bytes, 32)
        self.high = np.frombuffer(raw, np.uint8, high_bytes, 32 + low_bytes)
        # Rank directory: the upper part of every value, by its unary place.
        self.upper = np.flatnonzero(np.unpackbits(self.high, bitorder="little")) - np.arange(self.n)

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = min(56, max(0, (top // n).bit_length() - 1)) if n else 0
        packed = []
        shifts = np.arange(low_bits, dtype=np.uint64)
        for i in range(0, n if low_bits else 0, 1 << 15):  # whole bytes per step
            bits = (values[i:i + (1 << 15), None] >> shifts) & np.uint64(1)
            packed.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little"))
        low = b"".join(p.tobytes() for p in packed) + b"\0" * 8
        place = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(place[-1]) + 1 if n else 0, np.uint8)
        unary[place] = 1
        high = np.packbits(unary, bitorder="little").tobytes()
        return np.array([n, low_bits, len(low), len(high)], "<i8").tobytes() + low + high

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        words = self.low[(at >> 3)[:, None] + np.arange(8)].view("<u8")[:, 0]
        return (words >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.upper[i].astype(np.uint64) << np.uint64(self.low_bits)) | self._low(i)

    def successor(self, x: np.ndarray, lo=None, hi=None) -> np.ndarray:
        """Index of the first value >= x (within lo:hi if given)."""
        h, low = (x >> np.uint64(self.low_bits)).astype(np.int64), x & np.uint64((1 << self.low_bits) - 1)
        at = np.searchsorted(self.upper, h, "left")
        end = np.searchsorted(self.upper, h, "right")
        if lo is not None:
            at, end = np.maximum(at, lo), np.minimum(end, hi)
        # Binary search by the low bits among the values of one upper part: a
        # common word has thousands of contexts there.
        todo = np.flatnonzero(at < end)
        while len(todo):
            mid = (at[todo] + end[todo]) >> 1
            less = self._low(mid) < low[todo]
            at[todo[less]] = mid[less] + 1
            end[todo[~less]] = mid[~less]
            todo = todo[at[todo] < end[todo]]
        return at

    def find(self, x: np.ndarray, lo=None, hi=None) -> np.ndarray:
        """Index of each x, or -1."""
        at = self.successor(x, lo, hi)
        top = self.n if hi is None else hi
        ok = at < top
        safe = np.where(ok, at, 0)
        if self.n:
            ok = ok & (self.get(safe) == x)
        return np.where(ok, at, -1)


# --- a trie shard ------------------------------------------------------------

def quantise(x: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(x / STEP), 0, 65535).astype("<u2")


class Trie:
    """One shard. ``words`` and ``contexts`` are the two levels, ``pointers``
    the monotone starts of the words' successor ranges."""

    def __init__(self, raw):
        sizes = np.frombuffer(raw, "<i8", 6)
        ends = 48 + np.cumsum(sizes)
        part = lambda i: raw[ends[i] - sizes[i]:ends[i]]
        self.words, self.pointers, self.contexts = (EliasFano(part(i)) for i in range(3))
        self.counts = np.frombuffer(part(3), "<i8")
        self.unigram = np.frombuffer(part(4), "<u2")
        self.gains = np.frombuffer(part(5), "<u2")

    @staticmethod
    def build(words, counts, pairs_per_word, contexts, pair_counts, total: int, once: float, mass: float) -> bytes:
        """From the sorted words, their counts, and their sorted contexts
        (32-bit prints) with pair counts, words one after another."""
        p = (1 - once) * counts / total
        number = np.repeat(np.arange(len(words), dtype=np.uint64), pairs_per_word)
        relative = (number << np.uint64(32)) | contexts.astype(np.uint64)
        gain = np.log10(1 + pair_counts / (mass * p[number.astype(np.int64)]))
        parts = [EliasFano.encode(words), EliasFano.encode(np.append(0, np.cumsum(pairs_per_word))),
                 EliasFano.encode(relative), counts.astype("<i8").tobytes(),
                 quantise(-np.log10(p)).tobytes(), quantise(gain).tobytes()]
        parts = [x + b"\0" * (-len(x) % 8) for x in parts]
        return np.array([len(x) for x in parts], "<i8").tobytes() + b"".join(parts)

    def lookup_words(self, words: np.ndarray) -> np.ndarray:
        return self.words.find(words)

    def lookup_pairs(self, word: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """Gain (log10) of contexts (32-bit prints) of words (indices, -1: unknown)."""
        out = np.zeros(len(word))
        known = np.flatnonzero(word >= 0)
        w = word[known]
        if len(w):
            lo, hi = (self.pointers.get(w + k).astype(np.int64) for k in (0, 1))
            at = self.contexts.find((w.astype(np.uint64) << np.uint64(32)) | contexts[known].astype(np.uint64), lo, hi)
            hit = at >= 0
            out[known[hit]] = self.gains[at[hit]] * STEP
        return out


def mapped(raw: bytes):
    """The bytes memory-mapped from an unlinked scratch file of this task, so
    that the levels are file pages and not worker memory."""
    with tempfile.TemporaryFile() as f:
        f.write(raw)
        f.flush()
        return memoryview(np.memmap(f, np.uint8, "r"))


# --- tokens of a chunk ---------------------------------------------------------

def _tokens(data, bounds):
    """Tokens of a chunk's documents: word, word before it, document."""
    words, counts = word_hashes(data, bounds, lower=True)
    n = len(words) + len(counts)
    w = np.empty(n, np.uint64)
    ends = np.cumsum(counts + 1) - 1
    own = np.ones(n, bool)
    own[ends] = False
    w[own] = words
    w[ends] = END
    del words, own
    before = np.empty(n, np.uint64)
    before[1:] = w[:-1]
    before[ends - counts] = BEGIN
    return w, before, np.repeat(np.arange(len(counts), dtype=np.uint32), counts + 1)


def _print32(u: np.ndarray) -> np.ndarray:
    return (mix(u) >> np.uint64(32)).astype("<u4")


def _shard(w: np.ndarray, u: np.ndarray, common: np.ndarray, shards: int) -> np.ndarray:
    """A word's pairs lie in one shard; those of common words are dealt to
    all shards by context."""
    key = np.where(np.isin(w, common), mix(w ^ (u * np.uint64(0x9E3779B97F4A7C15))), w)
    return (((key >> np.uint64(33)).astype(np.int64) * shards) >> 31).astype(np.int32)


def _freed(run):
    """``run`` over a task's batches, returning at its end what it freed: a
    worker outlives its task and would hold that memory beside later ones."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped


def _freed_group(run):
    def wrapped(rows: pd.DataFrame) -> pd.DataFrame:
        try:
            return run(rows)
        finally:
            give_back()
    return wrapped


def _freed_cogroup(run):
    def wrapped(rows: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        try:
            return run(rows, others)
        finally:
            give_back()
    return wrapped


def _train_counts(batches):
    for batch, data, bounds in text_chunks(batches):
        keep = np.asarray(batch.column("train"))
        w, _, doc = _tokens(data, bounds)
        w, n = np.unique(w[keep[doc]], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n)], ["w", "n"])


def _train_pairs(shards: int, common):
    """(shard, payload): a chunk's distinct training pairs with counts."""
    def run(batches):
        for batch, data, bounds in text_chunks(batches):
            keep = np.asarray(batch.column("train"))
            w, u, doc = _tokens(data, bounds)
            mine = keep[doc]
            if not mine.any():
                continue
            w, u = w[mine], u[mine]
            shard, ctx = _shard(w, u, common.value[0], shards), _print32(u)
            del u, doc, mine
            order = np.lexsort((ctx, w, shard))
            w, ctx, shard = w[order], ctx[order], shard[order]
            del order
            new = np.append(True, (w[1:] != w[:-1]) | (ctx[1:] != ctx[:-1]) | (shard[1:] != shard[:-1]))
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(w)))
            w, ctx, shard = w[at], ctx[at], shard[at]
            out = []
            for s, lo, hi in _slices(shard):
                words, per = _grouped(w[lo:hi])
                out.append((s, _join(words, per.astype("<u4"), ctx[lo:hi], n[lo:hi].astype("<u4"))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())],
                ["shard", "payload"])
    return run


def _slices(x: np.ndarray):
    edges = np.append(np.flatnonzero(np.diff(x, prepend=-1)), len(x))
    for lo, hi in zip(edges, edges[1:]):
        yield int(x[lo]), int(lo), int(hi)


def _grouped(sorted_: np.ndarray):
    at = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
    return sorted_[at], np.diff(np.append(at, len(sorted_)))


_KINDS = ("u1", "<u2", "<u4", "<u8", "<i8", "<f8")


def _join(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes; counts and indices in the narrowest type that fits."""
    parts = []
    for x in arrays:
        if x.dtype == np.uint32:
            top = int(x.max()) if len(x) else 0
            x = x.astype("u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4")
        parts.append(x)
    kinds = [_KINDS.index(x.dtype.str.replace("|", "").replace("=", "<")) for x in parts]
    head = np.array([len(parts), *kinds, *(x.nbytes for x in parts)], "<i8").tobytes()
    return head + b"".join(x.tobytes() for x in parts)


def _arrays(raw: bytes) -> int:
    return int(np.frombuffer(raw, "<i8", 1)[0])


def _split(raw: bytes) -> list[np.ndarray]:
    n = _arrays(raw)
    kinds, sizes = (np.frombuffer(raw, "<i8", n, 8 + 8 * n * i) for i in (0, 1))
    at, out = 8 + 16 * n, []
    for size, kind in zip(sizes.tolist(), kinds.tolist()):
        kind = np.dtype(_KINDS[kind])
        out.append(np.frombuffer(raw, kind, size // kind.itemsize, at))
        at += size
    return out


def _build_shard(total: int, once: float, mass: float, common):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [_split(p) for p in rows["payload"]]
        w = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
        ctx, n = (np.concatenate([p[i] for p in parts]) for i in (2, 3))
        del parts
        order = np.lexsort((ctx, w))
        w, ctx, n = w[order], ctx[order], n[order]
        del order
        at = np.flatnonzero(np.append(True, (w[1:] != w[:-1]) | (ctx[1:] != ctx[:-1])))
        w, ctx, n = w[at], ctx[at], np.add.reduceat(n.astype(np.int64), at)
        words, per = _grouped(w)
        counts = np.add.reduceat(n, np.cumsum(per) - per)
        spread, whole = common.value
        if len(spread):  # their pairs are split over shards, their count is not
            i = np.minimum(np.searchsorted(spread, words), len(spread) - 1)
            counts = np.where(spread[i] == words, whole[i], counts)
        raw = Trie.build(words, counts, per, ctx, n, total, once, mass)
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "trie": [raw]})
    return run


@dataclass
class Model:
    """A trained model: ``tries`` (shard, trie) lies in the shared folder."""
    tries: DataFrame
    shards: int
    tokens: int
    vocabulary: int
    documents: int
    once: float
    mass: float
    common: object


def train(docs: DataFrame, train_on, mass: float = MASS, id_col: str = "doc_id",
          text_col: str = "text") -> Model:
    """Learns from the rows where the boolean column ``train_on`` holds.

    Two passes: word counts (hash aggregation of each chunk's distinct
    words), then pair counts, as one packed row per chunk and shard. Shards
    grow with the text, one per SHARD_TEXT_BYTES. Words of over 1 / (4
    shards) of all tokens (at most 4 * shards of them, broadcast) have their
    pairs dealt over all shards. With no training text every word is
    unknown."""
    d = _fold(docs, train_on, id_col, text_col)
    shards = max(1, -(-text_bytes(d) // SHARD_TEXT_BYTES))
    counts = stored(d.mapInArrow(_freed(_train_counts), "w bigint, n bigint").groupBy("w").agg(F.sum("n").alias("n")), "words")
    n, v, one, texts = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("w"), F.count_if(F.col("n") == 1),
        F.coalesce(F.sum(F.when(F.col("w") == int(END.view(np.int64)), F.col("n"))), F.lit(0))).first()
    rows = counts.filter(F.col("n") * (4 * shards) > n).collect() if shards > 1 else []
    spread = np.array([r["w"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(spread)
    common = d.sparkSession.sparkContext.broadcast(
        (spread[order], np.array([r["n"] for r in rows], np.int64)[order]))
    once = min(0.5, max(one, 1) / max(n, 1))
    tries = stored(
        d.mapInArrow(_freed(_train_pairs(shards, common)), "shard int, payload binary")
        .repartition(shards, "shard").groupBy("shard")
        .applyInPandas(_freed_group(_build_shard(n, once, mass, common)), "shard int, trie binary"), "tries")
    return Model(tries, shards, n, v, texts, once, mass, common)


def _fold(docs, train_on, id_col, text_col):
    ship_package(docs.sparkSession)
    d = docs.withColumn("__train", F.coalesce(train_on, F.lit(True)))
    return d.select(d[id_col].cast("bigint").alias("doc_id"),
                    F.coalesce(d[text_col], F.lit("")).alias("text"), F.col("__train").alias("train"))


# --- scoring --------------------------------------------------------------------

def _queries(shards: int, common):
    """(shard, chunk, payload): a chunk's distinct pairs by shard, each with
    the documents that hold it; and per chunk its documents (shard -1 - k)."""
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for seq, (batch, data, bounds) in enumerate(text_chunks(batches)):
            chunk = (part << 32) | seq
            w, u, doc = _tokens(data, bounds)
            shard, ctx = _shard(w, u, common.value[0], shards), _print32(u)
            del u
            order = np.lexsort((doc, ctx, w, shard))
            w, ctx, shard, doc = w[order], ctx[order], shard[order], doc[order]
            del order
            pair = np.append(True, (w[1:] != w[:-1]) | (ctx[1:] != ctx[:-1]) | (shard[1:] != shard[:-1]))
            hold = pair.copy()
            hold[1:] |= doc[1:] != doc[:-1]
            at = np.flatnonzero(hold)
            times = np.diff(np.append(at, len(w))).astype(np.uint32)
            w, ctx, shard, doc, pair = w[at], ctx[at], shard[at], doc[at], pair[at]
            out = []
            for s, lo, hi in _slices(shard):
                first = np.flatnonzero(pair[lo:hi]) + lo
                docs_per = np.diff(np.append(first, hi))
                words, per = _grouped(w[first])
                out.append((s, chunk, _join(
                    words, per.astype("<u4"), ctx[first], docs_per.astype("<u4"),
                    doc[lo:hi], times[lo:hi])))
            ids = batch.column("doc_id")
            known = ids.fill_null(0).to_numpy().astype("<i8")
            out.append((-1 - chunk % shards, chunk, _join(
                known, np.asarray(ids.is_null()).astype("u1"), np.asarray(batch.column("train")).astype("u1"),
                np.bincount(doc, weights=times, minlength=len(bounds) - 1).astype("<i8"), np.empty(0, "u1"))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int64()),
                 pa.array([x[2] for x in out], pa.binary())], ["shard", "chunk", "payload"])
    return run


def _answer(model_once: float, total: int, texts: int, mass: float, common):
    """Each chunk's part of one shard: per document the known tokens, the
    base sum of log10(c + 1) and the model's log10 sum."""
    begin = np.log10(mass / (texts + mass))
    unknown = -np.log10(model_once)

    def run(queries: pd.DataFrame, tries: pd.DataFrame) -> pd.DataFrame:
        if not len(queries):
            return pd.DataFrame({"chunk": [], "payload": []})
        if int(queries["shard"].iloc[0]) < 0:
            return queries[["chunk", "payload"]]
        trie = Trie(mapped(tries["trie"].iloc[0])) if len(tries) else None
        spread, whole = common.value
        out = []
        for chunk, raw in zip(queries["chunk"], queries["payload"]):
            words, per, ctx, docs_per, doc, times = _split(raw)
            at = trie.lookup_words(words) if trie else np.full(len(words), -1)
            safe = np.maximum(at, 0)
            count = np.where(at >= 0, trie.counts[safe], 0) if trie else np.zeros(len(words), np.int64)
            p = np.where(at >= 0, trie.unigram[safe] * STEP, unknown) if trie else np.full(len(words), unknown)
            if len(spread):  # a common word may lack this shard's pairs
                i = np.minimum(np.searchsorted(spread, words), len(spread) - 1)
                is_spread = spread[i] == words
                count = np.where(is_spread, whole[i], count)
                p = np.where(is_spread, quantise(-np.log10((1 - model_once) * whole[i] / total)) * STEP, p)
            as_context = np.where(words == END, 0.0, np.log10(mass / (count + mass)))
            gain = trie.lookup_pairs(np.repeat(at, per), ctx) if trie else np.zeros(len(ctx))
            score = np.repeat(np.repeat(as_context - p, per) + gain, docs_per) * times
            known = np.repeat(np.repeat(count > 0, per), docs_per) * times
            base = np.repeat(np.repeat(np.log10(count + 1.0), per), docs_per) * times
            ids, where = np.unique(doc, return_inverse=True)
            ends = doc[np.repeat(np.repeat(words == END, per), docs_per)]
            add = np.bincount(np.searchsorted(ids, ends), minlength=len(ids)) * begin
            out.append((chunk, _join(
                ids.astype("<u4"), np.bincount(where, known, len(ids)).astype("<u4"),
                np.bincount(where, base, len(ids)), np.bincount(where, score, len(ids)) + add)))
        return pd.DataFrame(out, columns=["chunk", "payload"])
    return run


def _total(tokens: int, vocabulary: int):
    denominator = float(np.log10(tokens + vocabulary + 1))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        payloads = list(rows["payload"])
        own = next(i for i, p in enumerate(payloads) if _arrays(p) == 5)  # the chunk's documents
        ids, nulls, trained, sizes, _ = _split(payloads.pop(own))
        n = len(ids)
        known, base, score = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        for raw in payloads:
            doc, k, b, s = _split(raw)
            known[doc] += k
            base[doc] += b
            score[doc] += s
        doc_id = pd.array(ids, "Int64")
        doc_id[nulls > 0] = pd.NA
        return pd.DataFrame({
            "doc_id": doc_id, "held_out": trained == 0, "n_tokens": sizes, "n_known": known,
            "train_tokens": np.full(n, tokens), "base_score": base - sizes * denominator, "score": score})
    return run


SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double")


def score(docs: DataFrame, model: Model, train_on, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``held_out`` (not trained on),
    ``n_tokens`` (words and one end), ``n_known``, ``train_tokens``,
    ``base_score`` (add-one unigram) and ``score`` (log10 probability).

    A chunk's distinct pairs go to their shards with the documents that hold
    them, as one packed row per chunk and shard; each shard answers from its
    memory-mapped trie with one partial sum per document and chunk. NULL and
    blank texts are one end token. Chunks are named by partition and place,
    so ``docs`` should be read from files (a fixed row order)."""
    d = _fold(docs, train_on, id_col, text_col)
    asked = d.mapInArrow(_freed(_queries(model.shards, model.common)), "shard int, chunk bigint, payload binary")
    parts = (asked.repartition(model.shards, "shard").groupBy("shard")
             .cogroup(model.tries.repartition(model.shards, "shard").groupBy("shard"))
             .applyInPandas(_freed_cogroup(_answer(model.once, max(model.tokens, 1), model.documents, model.mass,
                                                   model.common)), "chunk bigint, payload binary"))
    return parts.groupBy("chunk").applyInPandas(_freed_group(_total(model.tokens, model.vocabulary)), SCORES)
