"""Spelling variants: words one edit apart, found by blocked Gram matrices.

A word is a vector of letter counts. One replaced letter puts two words of
equal length at squared distance 2, one inserted letter puts words of
adjacent lengths at squared distance 1, so every near pair is among the
pairs at squared distance 2 or less, which numpy reads off products of
blocks of such vectors (|x|^2 + |y|^2 - 2 x.y); the edit itself is then
verified letter by letter.

Blocks are cut by length and by the letters' classes: one edit moves one
letter into, out of or between classes, so a block has a fixed set of
neighbours and every other pair of blocks is too far apart to be multiplied.
Coarse blocks (length and a few class counts) are dealt by Spark as pairs of
bounded tiles; inside a task the tiles are cut again by finer classes.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelake.llm.common import id_and_text, mix, stored

RUN = r"[A-Za-zÀ-ÿ]+"
MIN_LETTERS = 6
MIN_COUNT = 5
DROP = 199       # a run whose hash this divides loses one letter
RATIO = 5        # a form is at least that much more frequent
# Letters in a tile; the words of a coarse block are dealt over as many tiles
# as they need, and every pair of tiles is one group.
TILE_LETTERS = 200_000
# Coarse class counts beside the length: one more for every eightfold of
# words, so that blocks stay of a size. Only the plan depends on it.
SPLIT_WORDS = 200_000
FINE = 8          # classes inside a task
CHECK = 200_000   # candidate pairs verified in one numpy step

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# What a run can hold once A-Z are lower-cased.
LETTERS = _UPPER.lower() + "".join(map(chr, range(0xC0, 0x100)))


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word``, ``n``: the runs of letters of all texts, A-Z lower-cased, one
    letter dropped where the hash of ``<doc_id>:<run>`` says so, of
    MIN_LETTERS or more and MIN_COUNT or more occurrences. NULL texts have
    none; a NULL id counts as ''; repeated rows count each time."""
    d = id_and_text(docs, id_col, text_col)
    low = F.translate("text", _UPPER, _UPPER.lower())
    # A shorter run cannot become a word.
    pattern = RUN.removesuffix("+") + "{%d,}" % MIN_LETTERS
    runs = d.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("i"),
                    F.explode(F.regexp_extract_all(low, F.lit(pattern), F.lit(0))).alias("r"))
    h = F.crc32(F.concat("i", F.lit(":"), "r").cast("binary"))
    at = (h % F.length("r")).cast("int")
    word = F.when(h % DROP == 0, F.concat(F.substring(F.col("r"), F.lit(1), at),
                                          F.substring(F.col("r"), at + 2, F.length("r")))).otherwise(F.col("r"))
    return (runs.select(word.alias("word")).filter(F.length("word") >= MIN_LETTERS)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_COUNT))


def _splits(n_words: int) -> int:
    return 1 + max(0, int(math.log(max(n_words, 1) / SPLIT_WORDS, 8)))


def _coarse(word: Column, splits: int) -> Column:
    """Length, then the number of letters in each class but the last."""
    counts = [F.length(word) - F.length(F.translate(word, LETTERS[c::splits + 1], "")) for c in range(splits)]
    return F.array(F.length(word), *counts)


def neighbours(splits: int) -> list[tuple[int, ...]]:
    """Offsets of coarse keys that one edit can make, each unordered pair of
    keys once: itself, a letter inserted, a letter replaced."""
    def unit(c):  # a letter more in class c; the last class has no count
        return [int(c == k) for k in range(splits)]
    classes = range(splits + 1)
    out = [tuple([0] * (splits + 1))]
    out += [(1, *unit(c)) for c in classes]
    out += [(0, *[a - b for a, b in zip(unit(x), unit(y))]) for x, y in itertools.combinations(classes, 2)]
    return out


def near_words(table: DataFrame) -> DataFrame:
    """``word``, ``n_near``, ``best`` (struct of ``n``, ``word``: the near
    word of largest n, ties to the first in code-point order) for the words
    of ``table`` (``word``, ``n``) that have a near word. All pairs one edit
    apart count; none is emitted, each tile pair sends one row per word."""
    spark = table.sparkSession
    splits = _splits(table.count())
    rows = table.select("word", "n", _coarse(F.col("word"), splits).alias("key"))
    blocks = (rows.groupBy("key").agg(F.sum(F.length("word")).alias("letters"))
              .select("key", F.ceil(F.col("letters") / TILE_LETTERS).cast("int").alias("tiles")))
    rows = (rows.join(blocks, "key")
            .select("word", "n", "key", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int").alias("tile")))
    offsets = F.array(*[F.array(*map(F.lit, o)) for o in neighbours(splits)])
    other = blocks.select(F.col("key").alias("key2"), F.col("tiles").alias("tiles2"))
    pairs = (blocks.select("key", "tiles", F.explode(offsets).alias("o"))
             .select("key", "tiles", F.zip_with("key", "o", lambda a, b: a + b).alias("key2"))
             .join(other, "key2")
             .select("key", "key2", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), "tiles2")
             .select("key", "key2", "tile", F.explode(F.sequence(F.lit(0), F.col("tiles2") - 1)).alias("tile2"))
             .filter((F.col("key") != F.col("key2")) | (F.col("tile") <= F.col("tile2")))
             .withColumn("pair", F.concat_ws("/", F.col("key").cast("string"), "tile",
                                             F.col("key2").cast("string"), "tile2")))
    pairs = stored(pairs, "variant-pairs")
    left = rows.join(pairs, ["key", "tile"]).select("pair", F.lit(0).alias("side"), "word", "n")
    right = (rows.select("word", "n", F.col("key").alias("key2"), F.col("tile").alias("tile2"))
             .join(pairs.filter((F.col("key") != F.col("key2")) | (F.col("tile") != F.col("tile2"))),
                   ["key2", "tile2"]).select("pair", F.lit(1).alias("side"), "word", "n"))
    found = left.unionByName(right).groupBy("pair").applyInPandas(
        _near_of_tiles, "word string, n_near bigint, best_n bigint, best_word string")
    return (found.groupBy("word")
            .agg(F.sum("n_near").alias("n_near"),
                 F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best_word").alias("w"))).alias("m"))
            .select("word", "n_near", F.struct((-F.col("m.n")).alias("n"), F.col("m.w").alias("word")).alias("best")))


def _near_of_tiles(rows: pd.DataFrame) -> pd.DataFrame:
    side = rows["side"].to_numpy()
    rows = rows.iloc[np.argsort(side, kind="stable")]
    text, n = rows["word"].to_numpy(), rows["n"].to_numpy(np.int64)
    cut = int((side == 0).sum())
    near = Best(text, n)
    left = Tile(text[:cut])
    if cut == len(text):
        for i, j in left.close(left, True):
            near.add(i, j)
    else:
        for i, j in left.close(Tile(text[cut:]), False):
            near.add(i, j + cut)
    return near.rows()


class Best:
    """Number of near words and the best of them, per word."""

    def __init__(self, text: np.ndarray, n: np.ndarray):
        self.text, self.n = text, n
        self.rank = np.empty(len(text), np.int64)
        self.rank[np.argsort(np.array(text, dtype=object), kind="stable")] = np.arange(len(text))
        self.count = np.zeros(len(text), np.int64)
        self.best = np.full(len(text), -1, np.int64)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        """Links i - j, each given once."""
        src, dst = np.concatenate([i, j]), np.concatenate([j, i])
        self.count += np.bincount(src, minlength=len(self.count))
        held = np.unique(src)
        held = held[self.best[held] >= 0]  # what is best so far competes too
        src, dst = np.concatenate([src, held]), np.concatenate([dst, self.best[held]])
        order = np.lexsort((self.rank[dst], -self.n[dst], src))
        src, dst = src[order], dst[order]
        first = np.r_[True, src[1:] != src[:-1]] if len(src) else np.empty(0, bool)
        self.best[src[first]] = dst[first]

    def rows(self) -> pd.DataFrame:
        has = np.flatnonzero(self.count)
        best = self.best[has]
        return pd.DataFrame({"word": self.text[has], "n_near": self.count[has],
                             "best_n": self.n[best], "best_word": self.text[best]})


_CODES = mix(np.arange(1, FINE + 1, dtype=np.uint64))  # a random number per fine class


class Tile:
    """Words of one length as letters, letter counts and fine blocks."""

    def __init__(self, text: np.ndarray):
        self.length = len(text[0])
        letters = np.frombuffer("".join(text).encode("latin-1"), np.uint8).reshape(len(text), self.length)
        # A fine class holds every FINE-th letter; the key is a sum of class
        # numbers, so an edit changes it by a fixed offset. Keys that collide
        # only make a block larger.
        key = _CODES[letters % FINE].sum(axis=1, dtype=np.uint64)
        self.order = np.argsort(key, kind="stable")
        self.letters = letters[self.order]
        self.keys, start = np.unique(key[self.order], return_index=True)
        self.edges = np.r_[start, len(text)]

    def counts(self, alphabet: np.ndarray) -> np.ndarray:
        place = np.zeros(256, np.int64)
        place[alphabet] = np.arange(len(alphabet))
        m, d = len(self.letters), len(alphabet)
        flat = (np.arange(m)[:, None] * d + place[self.letters]).ravel()
        return np.bincount(flat, minlength=m * d).reshape(m, d).astype(np.float32)

    def close(self, other: "Tile", same: bool):
        """Arrays of (index here, index there) of words one edit apart, in
        steps; ``other`` holds words of equal length or one letter more, and
        is this tile itself if ``same``."""
        grown = other.length - self.length
        alphabet = np.union1d(np.unique(self.letters), np.unique(other.letters))
        x = self.counts(alphabet)
        y = x if same else other.counts(alphabet)
        xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
        with np.errstate(over="ignore"):
            if grown:
                offsets = list(_CODES)
            else:
                pairs = itertools.combinations(_CODES, 2) if same else itertools.permutations(_CODES, 2)
                offsets = [np.uint64(0), *[a - b for a, b in pairs]]
        want = 1 if grown else 2
        held, size = [], 0
        for offset in offsets:
            with np.errstate(over="ignore"):
                wanted = self.keys + offset
            at = np.searchsorted(other.keys, wanted)
            at[at == len(other.keys)] = 0
            for b in np.flatnonzero(other.keys[at] == wanted):
                lo, hi = self.edges[b], self.edges[b + 1]
                lo2, hi2 = other.edges[at[b]], other.edges[at[b] + 1]
                step = max(1, 4_000_000 // int(hi2 - lo2))  # rows of one product
                for p in range(lo, hi, step):
                    q = min(p + step, hi)
                    d2 = x[p:q] @ y[lo2:hi2].T
                    d2 *= -2
                    d2 += xx[p:q, None]
                    d2 += yy[lo2:hi2]
                    i, j = np.nonzero(d2 == want)
                    if not len(i):
                        continue
                    i, j = i + p, j + lo2
                    if same and not offset:
                        once = i < j
                        i, j = i[once], j[once]
                    held.append((i, j))
                    size += len(i)
                    if size >= CHECK:
                        yield self._verified(other, held, grown)
                        held, size = [], 0
        if held:
            yield self._verified(other, held, grown)

    def _verified(self, other: "Tile", held: list, grown: int):
        i, j = (np.concatenate(v) for v in zip(*held))
        ok = np.zeros(len(i), bool)
        step = max(1, 20_000_000 // (self.length + 1))
        for p in range(0, len(i), step):
            a, b = self.letters[i[p:p + step]], other.letters[j[p:p + step]]
            if grown:  # equal up to some place, and from there shifted by one
                begin = np.cumprod(a == b[:, :-1], axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int64)
                end = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int64)
                ok[p:p + step] = begin + end >= self.length
            else:
                ok[p:p + step] = (a != b).sum(axis=1) == 1
        return self.order[i[ok]], other.order[j[ok]]


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: ``word``, ``form`` (the near word of largest n if
    that is RATIO times the word's n or more, else NULL), ``root`` (reached
    by following forms to the last; the word itself if it has none), ``n``,
    ``n_near``, ``form_n``.

    NULL, empty and blank texts have no words, and an empty table gives no
    rows; texts of any length are read whole; repeated rows count each time;
    ties go to the first word in code-point order; other columns of ``docs``
    are not read. Words are written to the shared folder first, so a lost
    executor costs only what it held of a later step."""
    table = stored(words(docs, id_col, text_col), "variant-words")
    near = near_words(table)
    formed = F.col("best.n") >= RATIO * F.col("n")
    rows = stored(table.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(formed, F.col("best.word")).alias("form"), F.when(formed, F.col("best.n")).alias("form_n")),
        "variant-forms")
    return rows.join(_roots(rows), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(rows: DataFrame) -> DataFrame:
    """``word``, ``root`` of the words that have a form. Counts grow at
    least RATIO-fold along a chain, which bounds its length; every round
    doubles the length of chain that is followed."""
    links = rows.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    most = rows.agg(F.max("n")).first()[0] or MIN_COUNT
    chain = math.log(max(most / MIN_COUNT, 1), RATIO) + 1  # links in a row, at most
    for _ in range(max(0, math.ceil(math.log2(chain)))):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("last"))
        links = stored(links.join(further, "root", "left").select(
            "word", F.coalesce("last", "root").alias("root")), "variant-roots")
    return links
