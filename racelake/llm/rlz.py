"""Substring dedup by relative Lempel-Ziv parsing.

The corpus is cut into reference blocks by content: the least hash of the
k-grams inside a window of MIN_WORDS words (its anchor) names the block that
indexes the window, so two equal windows always meet in one block. A block
indexes its passages (runs of consecutive windows of one document) by a
suffix array whose letters are whole windows: a match of m letters is one of
m + MIN_WORDS - 1 words. Every passage is parsed greedily against it: at a
window the longest match with any other place of the block is the factor, a
window without a match is a literal. The window after a factor begins inside
the factor's last MIN_WORDS - 1 words, so these are carried over and repeats
that straddle a factor boundary are looked up too.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelake.llm.common import id_and_text, mix, ranges, stored, text_bytes, text_chunks, word_hashes

MIN_WORDS = 35
ANCHOR_WORDS = 8
# Text bytes whose windows one reference block indexes on average.
BLOCK_TEXT_BYTES = 4 << 20

_ROW = "block int, payload binary"
_FACTORS = "doc_id bigint, th bigint, factors binary"
_FACTOR = np.dtype([("start", "<i4"), ("words", "<i4")])


def _gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of words[i:i+k] at every i (uint64)."""
    if len(words) < k:
        return np.empty(0, np.uint64)
    n = len(words) - k + 1
    r = np.uint64(0xD6E8FEB86659FD93)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * r + words[j:j + n]
    return mix(out)


def _window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """The same for long windows, by prefix sums of words times powers
    (modulo 2^64, the power divided out again)."""
    if len(words) < length:
        return np.empty(0, np.uint64)
    r, inv = 0xA0761D6478BD642F, pow(0xA0761D6478BD642F, -1, 1 << 64)
    n = len(words)
    powers = np.full(n, r, np.uint64)
    back = np.full(n, inv, np.uint64)
    powers[0] = back[0] = 1
    powers, back = np.multiply.accumulate(powers), np.multiply.accumulate(back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers)])
    return mix((sums[length:] - sums[:-length]) * back[:n - length + 1])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i:i+width]) at every i, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _runs(anchor: np.ndarray, doc: np.ndarray, place: np.ndarray, alone: np.ndarray | None = None):
    """Bounds of the passages: runs of consecutive windows of one document
    and anchor. Windows marked ``alone`` are passages of their own."""
    cut = np.ones(len(anchor), bool)
    cut[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + 1)
    if alone is not None:
        cut |= alone
    return np.append(np.flatnonzero(cut), len(anchor))


def _common_anchors(blocks: int, length: int, anchor_words: int):
    """(anchor, passages) of the anchors that may exceed a share of
    1 / (4 blocks) of all passages: those at half that share in a chunk."""
    def run(batches):
        for _, data, bounds in text_chunks(batches):
            _, anchor, _, doc, place = _windows(data, bounds, length, anchor_words)
            if len(anchor):
                a, n = np.unique(anchor[_runs(anchor, doc, place)[:-1]], return_counts=True)
                often = n >= max(2, int(n.sum()) // (8 * blocks))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[often].view(np.int64)), pa.array(n[often].astype(np.int64)),
                     pa.array(np.full(often.sum(), n.sum() / max(1, often.sum())))], ["anchor", "n", "total"])
    return run


def _spread_anchors(d: DataFrame, blocks: int, length: int, anchor_words: int) -> np.ndarray:
    """Anchors of over 1 / (8 blocks) of all passages (at most 8 * blocks of
    them): their windows are dealt to blocks one by one, by window hash."""
    if blocks == 1:
        return np.empty(0, np.uint64)
    seen = stored(d.mapInArrow(_common_anchors(blocks, length, anchor_words),
                               "anchor bigint, n bigint, total double"), "anchors")
    total = seen.agg(F.sum("total")).first()[0] or 0
    rows = (seen.groupBy("anchor").agg(F.sum("n").alias("n"))
            .filter(F.col("n") * (8 * blocks) > F.lit(total)).select("anchor").collect())
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


def _windows(data, bounds, length, anchor_words):
    """Of a chunk: anchor, window hash, document and first word of every window."""
    words, counts = word_hashes(data, bounds, lower=False)
    n = np.maximum(counts - length + 1, 0)
    if not n.sum():
        return counts, *(np.empty(0, np.uint64),) * 2, *(np.empty(0, np.int64),) * 2
    first = np.cumsum(counts) - counts
    at = ranges(first, n)
    doc = np.repeat(np.arange(len(counts)), n)
    anchors = _sliding_min(_gram_hashes(words, anchor_words), length - anchor_words + 1)
    return counts, anchors[at], _window_hashes(words, length)[at], doc, at - first[doc]


def _letters(anchor: np.ndarray, window: np.ndarray) -> np.ndarray:
    """A dense number from 1 for every distinct (window, anchor), int32."""
    order = np.argsort(window ^ mix(anchor), kind="stable")
    w, a = window[order], anchor[order]
    out = np.empty(len(w), np.int32)
    out[order] = np.cumsum(np.append(True, (w[1:] != w[:-1]) | (a[1:] != a[:-1]))[:len(w)])
    return out


def _suffix_ranks(letters: np.ndarray, left: np.ndarray):
    """The suffix array of the passages and, per level k, the rank of the
    first 2^k letters at every place (by prefix doubling). ``left``: letters
    from a place to its passage's end; what lies beyond ranks 0."""
    levels, order = [letters], np.argsort(letters, kind="stable")
    classes, step, longest = int(letters.max()), 1, int(left.max())
    while step < longest:
        rank = levels[-1]
        after = np.zeros(len(rank), np.int64)
        inside = np.flatnonzero(left > step)
        after[inside] = rank[inside + step]
        key = rank.astype(np.int64) << 32 | after
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(len(key), np.int32)
        rank[order] = np.cumsum(np.append(True, key[1:] != key[:-1]))
        levels.append(rank)
        if rank.max() == classes:  # no class was split: none ever will be
            break
        classes, step = int(rank.max()), step * 2
    return order, levels


def _match_lengths(letters: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Letters of the longest match of every place with any other place, from
    the common prefixes of neighbours in the suffix array."""
    order, levels = _suffix_ranks(letters, left)
    i, j = order[:-1], order[1:]
    most = np.minimum(left[i], left[j])
    common = np.where(levels[-1][i] == levels[-1][j], most, 0)  # one rank at the top: equal to the end
    for k in range(len(levels) - 2, -1, -1):
        at = np.flatnonzero(common < most)
        at = at[levels[k][i[at] + common[at]] == levels[k][j[at] + common[at]]]
        common[at] = np.minimum(common[at] + (1 << k), most[at])
    out = np.empty(len(letters), np.int64)
    out[order] = np.maximum(np.append(0, common), np.append(common, 0))
    return out


def _factorise(letters: np.ndarray, head: np.ndarray, size: np.ndarray):
    """Greedy parse of the passages (runs of ``size`` letters from ``head``)
    against the index of all of them. Returns (first letter, number of
    letters) of each factor; literals are left out."""
    if not len(letters):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    end = np.repeat(head + size, size)
    longest = _match_lengths(letters, end - np.arange(len(letters)))
    hits = np.flatnonzero(longest)
    # By hit: the first hit at or after the factor's end. A factor that ends
    # its passage is followed by the next passage's first hit.
    follow = np.searchsorted(hits, hits + longest[hits]).tolist()
    taken, at = [], 0
    while at < len(follow):
        taken.append(at)
        at = follow[at]
    begin = hits[taken]
    return begin, longest[begin]


def _route(blocks: int, length: int, anchor_words: int, spread):
    """Rows for the blocks, from chunks of documents.

    Passages (runs of windows of one anchor) that occur several times in the
    chunk are already known repeats: their factors are emitted at once and
    only one copy goes on to the block, marked as repeated, so a passage
    that many documents share reaches its block once per chunk."""
    def run(batches):
        for batch, data, bounds in text_chunks(batches):
            counts, anchor, window, doc, place = _windows(data, bounds, length, anchor_words)
            if not len(anchor):
                continue
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            nulls = np.asarray(batch.column("doc_id").is_null())
            ths = batch.column("th").to_numpy()
            wide = np.isin(anchor, spread.value)
            cut = _runs(anchor, doc, place, wide)
            head, size = cut[:-1], np.diff(cut)
            # Equal passages: equal anchor, length and window hashes.
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(
                mix(window + np.uint64(0x9E3779B97F4A7C15) * (np.arange(len(window)) - np.repeat(head, size)).astype(np.uint64)))])
            print_ = mix(sums[cut[1:]] - sums[cut[:-1]]) ^ mix(size.astype(np.uint64)) ^ anchor[head]
            _, which, inverse, times = np.unique(print_, return_index=True, return_inverse=True, return_counts=True)
            repeated = times[inverse] > 1
            known = np.flatnonzero(repeated)
            lists = list(_by(doc[head[known]], known))
            for lo in range(0, len(lists), 512):  # dealt evenly, whatever the documents
                part = lists[lo:lo + 512]
                at = np.concatenate([x for _, x in part])
                f = np.empty(len(at), _FACTOR)
                f["start"], f["words"] = place[head[at]], size[at] + length - 1
                d = np.array([x for x, _ in part])
                turn = mix(np.array([int(ths[d].astype(np.uint64).sum() & np.uint64(2**63 - 1)) + lo], np.uint64))[0]
                yield _batch([-1 - int(turn % np.uint64(blocks))], [_pack_known(
                    ids, nulls, ths, d, np.array([len(x) for _, x in part]), f)])
            # One copy of every distinct passage, by block.
            which.sort()
            # Anchors are minima and crowd near 0: mixed before they are dealt.
            key = mix(np.where(wide[head[which]], window[head[which]], anchor[head[which]]))
            block = (key >> np.uint64(33)).astype(np.int64) * blocks >> 31
            order = np.argsort(block, kind="stable")
            which, block = which[order], block[order]
            edges = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
            rows = []
            for lo, hi in zip(edges, edges[1:]):
                mine = which[lo:hi]
                rows.append((int(block[lo]), _pack(
                    ids, nulls, ths, doc[head[mine]], place[head[mine]], anchor[head[mine]],
                    size[mine], window[ranges(head[mine], size[mine])], repeated[mine])))
            yield _batch(*zip(*rows))
    return run


def _by(keys: np.ndarray, values: np.ndarray):
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    edges = np.append(np.flatnonzero(np.diff(keys, prepend=-1)), len(keys))
    for lo, hi in zip(edges, edges[1:]):
        yield int(keys[lo]), values[lo:hi]


def _batch(block, payload) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(payload, pa.binary())],
                                      ["block", "payload"])


def _pack_known(ids, nulls, ths, d, counts, factors) -> bytes:
    known = np.where(nulls[d], 0, np.nan_to_num(ids[d])).astype("<i8")
    return b"".join([np.array([len(d)], "<i8").tobytes(), known.tobytes(), ths[d].astype("<i8").tobytes(),
                     counts.astype("<i8").tobytes(), nulls[d].astype("u1").tobytes(), factors.tobytes()])


def _known_rows(raw: bytes):
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    ids, ths, counts = (np.frombuffer(raw, "<i8", n, 8 + 8 * n * k) for k in range(3))
    nulls = np.frombuffer(raw, "u1", n, 8 + 24 * n)
    at = 8 + 25 * n
    for i, th, c, null in zip(ids.tolist(), ths.tolist(), counts.tolist(), nulls.tolist()):
        yield None if null else i, th, raw[at:at + c * _FACTOR.itemsize]
        at += c * _FACTOR.itemsize


def _rows(out) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": pd.array([x[0] for x in out], "Int64"),
                         "th": np.array([x[1] for x in out], np.int64), "factors": [x[2] for x in out]})


def _pack(ids, nulls, ths, doc, start, anchor, size, windows, repeated) -> bytes:
    docs, own = np.unique(doc, return_inverse=True)
    known = np.where(nulls[docs], 0, np.nan_to_num(ids[docs])).astype("<i8")
    return b"".join([
        np.array([len(docs), len(size), len(windows)], "<i8").tobytes(), known.tobytes(),
        nulls[docs].astype("u1").tobytes(), ths[docs].astype("<i8").tobytes(),
        own.astype("<u4").tobytes(), start.astype("<u4").tobytes(), anchor.astype("<u8").tobytes(),
        size.astype("<u4").tobytes(), repeated.astype("u1").tobytes(), windows.astype("<u8").tobytes()])


def _unpack(raw: bytes):
    at = 24
    docs, passages, windows = np.frombuffer(raw, "<i8", 3)
    out = []
    for n, kind in ((docs, "<i8"), (docs, "u1"), (docs, "<i8"), (passages, "<u4"), (passages, "<u4"),
                    (passages, "<u8"), (passages, "<u4"), (passages, "u1"), (windows, "<u8")):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return out


def _parse_block(length: int):
    """The factors of one reference block's passages, by document."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        if int(rows["block"].iloc[0]) < 0:  # factors known before: passed on
            return _rows([x for p in rows["payload"] for x in _known_rows(p)])
        parts = [_unpack(p) for p in rows["payload"]]
        docs = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])])
        ids, nulls, ths = (np.concatenate([p[i] for p in parts]) for i in range(3))
        doc = np.concatenate([p[3].astype(np.int64) + o for p, o in zip(parts, docs)])
        start, anchor, size, repeated, window = (
            np.concatenate([p[i] for p in parts]) for i in range(4, 9))
        size = size.astype(np.int64)
        head = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(window)) - head[owner]
        # A passage known to repeat stands for its other copies: listed twice.
        again = np.flatnonzero(repeated)
        twice = ranges(head[again], size[again])
        sizes = np.append(size, size[again])
        letters = _letters(np.append(anchor[owner], anchor[owner][twice]), np.append(window, window[twice]))
        begin, count = _factorise(letters, np.cumsum(sizes) - sizes, sizes)
        mine = begin < len(window)
        begin, count = begin[mine], count[mine]
        whose = owner[begin]
        keep = repeated[whose] == 0  # the others' factors are out already
        begin, count, whose = begin[keep], count[keep], whose[keep]
        out = []
        for d, at in _by(doc[whose], np.arange(len(whose))):
            f = np.empty(len(at), _FACTOR)
            f["start"] = start[whose[at]] + place[begin[at]]
            f["words"] = count[at] + length - 1
            out.append((None if nulls[d] else int(ids[d]), int(ths[d]), f.tobytes()))
        return _rows(out)
    return run


def duplicate_factors(docs: DataFrame, length: int = MIN_WORDS, anchor_words: int = ANCHOR_WORDS,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``th`` (xxhash64 of the text) and ``factors`` (binary: int32
    pairs of first word and number of words): the parts of every document
    that repeat in windows of ``length`` words, anywhere, itself included.

    One shuffle of windows' 64-bit hashes; windows are equal if their hashes
    and their anchors' hashes are equal (128 bits). A window lies in one
    block, a block holds about BLOCK_TEXT_BYTES of text, blocks grow with
    the input. A passage of many copies reaches its block once per chunk, and
    the windows of an anchor common to many passages are dealt to all blocks
    (the list of those anchors is bounded by 8 per block)."""
    d = id_and_text(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    blocks = max(1, -(-text_bytes(d) // BLOCK_TEXT_BYTES))
    spread = d.sparkSession.sparkContext.broadcast(_spread_anchors(d, blocks, length, anchor_words))
    rows = d.mapInArrow(_route(blocks, length, anchor_words, spread), _ROW)
    return (rows.repartition(blocks, "block").groupBy("block")
            .applyInPandas(_parse_block(length), _FACTORS))


def remove_duplicates(docs: DataFrame, length: int = MIN_WORDS, anchor_words: int = ANCHOR_WORDS,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed``,
    ``kept_text`` (the words outside all duplicate factors, unchanged, joined
    by one space).

    NULL and blank texts have no words; documents shorter than ``length``
    keep all. Repeated rows are documents of their own and repeat each
    other. A very long text of one anchor is one passage, parsed in time
    n log n: a million words repeating one phrase or another such text take
    some seconds and 0.4 GB. The texts are shuffled once, to meet their
    factors."""
    d = id_and_text(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    found = (duplicate_factors(docs, length, anchor_words, id_col, text_col)
             .groupBy("doc_id", "th").agg(F.collect_list("factors").alias("factors")))
    both = (d.alias("d").join(found.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))
                              & (F.col("d.th") == F.col("f.th")), "left")
            .select("d.doc_id", "d.text", "f.factors"))
    return both.mapInArrow(_cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")


def _cut(batches):
    import re

    from racelake.llm.bpe import text_groups
    from racelake.llm.common import WORD

    words_of = re.compile(WORD).findall
    for b in batches:
        texts, lists = b.column("text").to_pylist(), b.column("factors")
        for lo, hi in text_groups(texts):
            rows = []
            for i in range(lo, hi):
                words = words_of(texts[i])
                f = lists[i].as_py()
                removed = 0
                n = len(words)
                if f:
                    x = np.frombuffer(b"".join(f), _FACTOR)
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, x["start"], 1)
                    np.add.at(edge, x["start"] + x["words"], -1)
                    keep = np.cumsum(edge)[:n] == 0
                    removed = int(n - keep.sum())
                    words = [w for w, k in zip(words, keep.tolist()) if k]
                rows.append((n, removed, " ".join(words)))
            n, removed, kept = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(lo, hi - lo), pa.array(n, pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text"])


def digest(removed: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256``."""
    return removed.select("doc_id", "n_words", "n_removed",
                          F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
