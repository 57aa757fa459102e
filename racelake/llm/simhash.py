"""SimHash near-duplicates through a Gray-order hierarchical index.

Distinct fingerprints are factored by shared masked bit patterns: the 64 bits
are cut into ``max_bits + shared`` ranges, so two fingerprints within
``max_bits`` agree on at least ``shared`` whole ranges; every choice of
``shared`` ranges is an upper node mask, and fingerprints with one masked
pattern form a group. A group is sorted by Gray rank and indexed by a tree
whose nodes keep the bits all their fingerprints share; pairs of nodes whose
shared bits differ in more than ``max_bits`` places are pruned whole.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelake.llm.common import doc_steps, give_back, id_and_text, ranges, stored, utf8

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
LEAF = 32
FAN = 8
SMALL_GROUP = 32
PAIR_STEP = 1 << 13  # members of small groups compared at a time
BUCKET_ROWS = 400_000
GROUP_ROWS = 100_000  # larger groups are split
MAX_BROADCAST_GROUPS = 1_000_000  # split groups, 12 bytes each
_BYTES = np.uint64(0x0101010101010101)
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+").findall


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 of every shingle of a UTF-8 text (A-Z lower-cased)."""
    w = _WORDS(text.lower())
    h = xxhash.xxh64_intdigest
    if len(w) <= words:
        return [h(b" ".join(w), SEED)] if w else []
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    view = memoryview(joined)
    return [h(view[s:e], SEED) for s, e in zip(starts[:len(w) - words + 1].tolist(), ends[words - 1:].tolist())]


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per run of ``counts`` hashes, the bits set in over half of them."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    n = counts[some]
    pieces = -(-n // 255)  # byte counters hold 255
    first = np.cumsum(n) - n
    k = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cuts = np.repeat(first, pieces) + 255 * k
    to_doc = np.cumsum(pieces) - pieces
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & _BYTES, cuts)
        ones = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), to_doc, axis=0)
        high = (2 * ones > n[:, None]).astype(np.uint64)
        for byte in range(8):
            out[some] |= high[:, byte] << np.uint64(8 * byte + shift)
    return out


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id``, ``th`` (xxhash64 of the text), ``fp`` (bigint, the 64 bits): NULL and blank texts get 0,
    texts shorter than a shingle hash their whole sequence."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            data, bounds = utf8(b.column(1))
            fps = []
            for lo, hi in doc_steps(bounds, 1 << 20):
                hashes = [shingle_hashes(data[bounds[i]:bounds[i + 1]].tobytes(), words) for i in range(lo, hi)]
                counts = np.fromiter(map(len, hashes), np.int64, hi - lo)
                flat = np.fromiter((x for h in hashes for x in h), np.uint64, int(counts.sum()))
                fps.append(majority_bits(flat, counts))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(np.concatenate(fps).view(np.int64))], ["doc_id", "th", "fp"])
        give_back()
    return (id_and_text(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
            .mapInArrow(run, "doc_id bigint, th bigint, fp bigint"))


# --- the index of one group ----------------------------------------------

def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of a bit pattern in the reflected Gray sequence."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class GroupIndex:
    """Tree over fingerprints in Gray order. Level 0 holds leaves of LEAF
    fingerprints, each level above nodes of FAN; a node is the pattern of its
    fingerprints and the mask of bits on which all of them agree."""

    def __init__(self, fps: np.ndarray):
        self.order = np.argsort(gray_rank(fps), kind="stable")
        self.fps = fps[self.order]
        cuts = np.arange(0, len(fps), LEAF)
        ands, ors = np.bitwise_and.reduceat(self.fps, cuts), np.bitwise_or.reduceat(self.fps, cuts)
        self.levels = [(ands, ~(ands ^ ors))]
        while len(ands) > 1:
            cuts = np.arange(0, len(ands), FAN)
            ands, ors = np.bitwise_and.reduceat(ands, cuts), np.bitwise_or.reduceat(ors, cuts)
            self.levels.append((ands, ~(ands ^ ors)))

    def leaf_pairs(self, max_bits: int):
        """Batches of leaf pairs (a <= b) that the upper nodes don't prune."""
        stack = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, a, b = stack.pop()
            if len(a) > 1 << 16:
                half = len(a) // 2
                stack += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
                continue
            pattern, mask = self.levels[level]
            near = np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b]) <= max_bits
            a, b = a[near], b[near]
            if not len(a):
                continue
            if level == 0:
                yield a, b
                continue
            width = len(self.levels[level - 1][0])
            i = np.repeat(np.arange(FAN), FAN)
            x, y = (a[:, None] * FAN + i).ravel(), (b[:, None] * FAN + np.tile(np.arange(FAN), FAN)).ravel()
            fit = (x <= y) & (x < width) & (y < width)
            stack.append((level - 1, x[fit], y[fit]))

    def components(self, max_bits: int) -> np.ndarray:
        """A label per fingerprint (in the given order): equal if linked."""
        n = len(self.fps)
        label = np.arange(n)
        leaves = -(-n // LEAF)
        for a, b in self.leaf_pairs(max_bits):
            for lo in range(0, len(a), 2048):
                label = _joined(label, *self._links(a[lo:lo + 2048], b[lo:lo + 2048], label, leaves, max_bits))
        out = np.empty(n, np.int64)
        out[self.order] = label
        return out

    def _links(self, a, b, label, leaves, max_bits):
        n = len(self.fps)
        cuts = np.arange(0, n, LEAF)
        low, high = np.minimum.reduceat(label, cuts), np.maximum.reduceat(label, cuts)
        open_ = ~((low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b]))  # not yet one component
        a, b = a[open_], b[open_]
        if not len(a):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        k = np.arange(LEAF)
        x, y = a[:, None] * LEAF + k, b[:, None] * LEAF + k
        fx, fy = self.fps[np.minimum(x, n - 1)], self.fps[np.minimum(y, n - 1)]
        near = np.bitwise_count(fx[:, :, None] ^ fy[:, None, :]) <= max_bits
        p, i, j = np.nonzero(near)
        i, j = x[p, i], y[p, j]
        fit = (i < n) & (j < n) & (i != j)
        return i[fit], j[fit]


def _joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after linking i to j (minimum of a component's labels)."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            break
        i, j = i[apart], j[apart]
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def bucket_links(key: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links (fingerprint, least fingerprint of its local component)
    over all groups (equal ``key``) of a bucket."""
    order = np.lexsort((fps, key))
    key, fps = key[order], fps[order]
    new = np.ones(len(fps), bool)
    new[1:] = (key[1:] != key[:-1]) | (fps[1:] != fps[:-1])
    key, fps = key[new], fps[new]
    cuts = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key)) if len(key) else np.zeros(1, int)
    head, size = cuts[:-1], np.diff(cuts)
    nodes, node = np.unique(fps, return_inverse=True)
    label = np.arange(len(nodes))
    small = np.flatnonzero((size > 1) & (size <= SMALL_GROUP))
    # Each member against those after it in its group, all small groups at once.
    members = ranges(head[small], size[small])
    after = np.repeat(head[small] + size[small], size[small]) - members - 1
    for lo in range(0, len(members), PAIR_STEP):
        m, n = members[lo:lo + PAIR_STEP], after[lo:lo + PAIR_STEP]
        i, j = np.repeat(m, n), ranges(m + 1, n)
        near = np.bitwise_count(fps[i] ^ fps[j]) <= max_bits
        label = _joined(label, node[i[near]], node[j[near]])
    for g in np.flatnonzero(size > SMALL_GROUP):
        part = slice(head[g], head[g] + size[g])
        own = GroupIndex(fps[part]).components(max_bits)
        label = _joined(label, node[part], node[part][own])
    linked = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[linked], nodes[label[linked]]


def _choices(max_bits: int, shared: int) -> np.ndarray:
    """The masks of all choices of ``shared`` out of max_bits + shared bit ranges."""
    edges = np.linspace(0, 64, max_bits + shared + 1).astype(int)
    parts = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return np.array([sum(c) for c in combinations(parts, shared)], np.uint64)


def shared_ranges(distinct: int, max_bits: int) -> int:
    """How many ranges a group shares: the fewest for which random
    fingerprints make groups of about eight or fewer. Every value is exact."""
    for shared in range(1, 5):
        if distinct <= 8 << (64 * shared // (max_bits + shared)):
            return shared
    return 5


def groups(distinct: DataFrame, masks: np.ndarray, n: int, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, int]:
    """Rows (``fp``, ``key`` of its group) for every mask, and their number;
    ``n`` is the number of rows of ``distinct``.

    A pattern of more than ``group_rows`` fingerprints is dealt into blocks of
    half as many, and each pair of its blocks is a group: every two of its
    fingerprints still meet in a group, and no group has more (but for the
    spread of the hash that deals them)."""
    patterns = [F.struct(F.lit(i).alias("choice"),
                         F.col("fp").bitwiseAND(F.lit(int(m.view(np.int64)))).alias("pattern"))
                for i, m in enumerate(masks)]
    rows = (distinct.select("fp", F.explode(F.array(*patterns)).alias("m"))
            .select("fp", F.xxhash64("m.choice", "m.pattern").alias("key")))
    total = n * len(masks)
    if n <= group_rows:
        return rows, total
    size = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group_rows)
    large = stored(size.withColumn("blocks", F.ceil(2 * F.col("n") / F.lit(group_rows)).cast("int")), "large-groups")
    some, more = large.agg(F.count(F.lit(1)), F.sum(F.col("n") * (F.col("blocks") - 2))).first()
    if not some:
        return rows, total
    large = large.select("key", "blocks")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.transform(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: x != own),
                        lambda x: F.xxhash64("key", F.least(x, own), F.greatest(x, own)))
    rows = (rows.join(F.broadcast(large) if some <= MAX_BROADCAST_GROUPS else large, "key", "left")
            .select("fp", F.explode(F.when(F.col("blocks").isNull(), F.array("key")).otherwise(pairs)).alias("key")))
    return rows, total + more


def links(distinct: DataFrame, max_bits: int = MAX_BITS, shared: int | None = None,
          group_rows: int = GROUP_ROWS) -> DataFrame:
    """``a``, ``b`` (b < a as unsigned patterns of a local component): enough
    links to connect every two fingerprints within ``max_bits`` of each other
    in the table ``distinct`` (column ``fp``); at most one row per
    fingerprint and bucket, never all pairs of a group.

    Each fingerprint is sent once per choice of shared ranges, as 16 bytes,
    to the bucket of its masked pattern; of patterns with more than
    ``group_rows`` fingerprints, to those of its pairs of blocks."""
    n = distinct.count()
    shared = shared or max(2, shared_ranges(n, max_bits))
    rows, total = groups(distinct, _choices(max_bits, shared), n, group_rows)
    buckets = max(1, -(-total // BUCKET_ROWS))
    rows = rows.withColumn("bucket", F.pmod(F.col("key"), F.lit(buckets)).cast("int"))

    def run(t: pd.DataFrame) -> pd.DataFrame:
        a, b = bucket_links(t["key"].to_numpy(), t["fp"].to_numpy().view(np.uint64), max_bits)
        give_back()
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})
    return rows.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(run, "a bigint, b bigint")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root`` (least node reachable) for every node of an edge.

    Alternates large-star and small-star steps (Kiveris et al., 2014): the
    number of edges never grows, each round is two hash aggregations and
    joins over edges, written to the shared folder."""
    pair = lambda x, y: edges.select(F.col(x).alias("u"), F.col(y).alias("v"))
    now = stored(pair(a, b).unionAll(pair(b, a)).filter("u > v").distinct(), "edges")
    seen = None
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = stored(small.select("e.*").filter("u > v").distinct(), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
    return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits),
    ``component_id`` (smallest doc_id whose fingerprint is reachable over
    links of ``max_bits`` or fewer differing bits; NULL ids are passed over),
    ``group_fp`` (a fingerprint that names the component), ``text_hash``
    (xxhash64 of the text).

    Copies share a fingerprint, so groups of copies of any size are one
    index entry."""
    fp = stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    distinct = fp.groupBy("fp").agg(F.min("doc_id").alias("least"))
    root = components(links(distinct.select("fp"), max_bits))
    classes = stored(distinct.join(root, distinct["fp"] == root["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("group_fp")), "classes")
    first = classes.groupBy("group_fp").agg(F.min("least").alias("component_id"))
    named = classes.join(first, "group_fp").select("fp", "group_fp", "component_id")
    return fp.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "group_fp",
        F.col("th").alias("text_hash"))
