"""How far a source's words are from its language's other sources.

Documents become exact sparse count vectors by CountVectorizer (minDF, the
largest vocabSize there is), one vocabulary per language: a term is fitted
with its language behind it, so that one fit serves all languages. It is
fitted on rows that have each term as often as the documents of a few chunks,
or minDF times if that is less: that decides the same terms. Vectors are summed
per group (language and source): the terms of those documents are added up by
group before they are transformed. Sums become integer shares in
exact arithmetic, and groups are compared on the entries that are not zero:
a pair of sources costs its blocks of terms, and what both lack is one
product.

CountVectorizer holds its vocabulary on the driver and broadcasts it. Terms
are therefore dealt by hash into parts of at most about PART_TERMS distinct
terms (estimated first, all terms counted, not only those kept), written one
folder each, and every part is fitted by itself: nothing on the driver grows
with the corpus, and each part is read alone. Terms (runs of A-Z, a-z and
everything beyond ASCII, A-Z lower-cased) are cut from UTF-8 bytes by numpy.
"""

from __future__ import annotations

import math
import zlib
from collections import namedtuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from racelake.llm.common import (STEP_BYTES, doc_steps, give_back, mix, powers, ship_package, stored,
                                 text_chunks, utf8)
from racelake.session import scratch_path

MIN_DOCS = 10
MAX_VOCABULARY = 2**31 - 1
TOP_TERMS = 10
PART_TERMS = 2_000_000  # distinct terms in one fit; the driver holds those it keeps (about 0.1 KB each)
# A group of the pair evaluation: terms of one block against two tiles of
# sources, as two integer matrices of TILE x BLOCK.
BLOCK = 4096
TILE = 128
SCALE = 1_000_000_000


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _share(count: Column, total: Column, vocabulary: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * vocabulary)) by long
    division, three digits a step: exact while the divisor is below 9e15."""
    d = total + 2 * vocabulary
    rest, out = count + 2, F.lit(0).cast("bigint")
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + _div(rest, d)
        rest = rest % d
    return out + 1


def _distance(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _named(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    ship_package(docs.sparkSession)
    return docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(name)
                         for name, c in (("lang", lang_col), ("source", source_col), ("text", text_col))])


# Bytes of UTF-8 that make up terms, A-Z lower-cased; 0 parts them.
_FOLD = np.zeros(256, np.uint8)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
_TERM_VALUE = np.where(_FOLD > 0, _VALUE[_FOLD], np.uint64(0))  # 0 parts terms
# The estimate counts distinct terms whose hash falls below one part in so many.
ONE_IN = 64


def _starts(black: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where terms begin in the documents ``bounds`` parts."""
    first = black.copy()
    first[1:] &= ~black[:-1]
    edge = bounds[:-1][bounds[:-1] < len(black)]
    first[edge] = black[edge]
    return np.flatnonzero(first)


def _cut(data: np.ndarray, bounds: np.ndarray):
    """Terms of the documents ``data[bounds[i]:bounds[i + 1]]``: their bytes
    end to end, the length of each, and its document."""
    low = _FOLD[data]
    black = low != 0
    at = _starts(black, bounds)
    letters = low[black]
    begin = np.cumsum(black, dtype=np.int32)[at] - 1
    length = np.diff(np.append(begin, len(letters)))
    per = np.diff(np.searchsorted(at, bounds))
    return letters, length, np.repeat(np.arange(len(per)), per)


def _sampled(data: np.ndarray, bounds: np.ndarray):
    """Hashes of those terms whose hash falls below the sample's bound, and
    the document of each."""
    values = _TERM_VALUE[data]
    at = _starts(values != 0, bounds)
    if not len(at):
        return np.empty(0, np.uint64), at
    up, down = powers(len(data))
    h = mix(np.add.reduceat(values * up, at) * down[at])
    few = np.flatnonzero(h < 2**64 // ONE_IN)
    return h[few], np.searchsorted(bounds, at[few], "right") - 1


def _distinct_terms(named: DataFrame) -> int:
    """About how many distinct terms there are (per language, summed): the
    number of hashes below a fixed bound, scaled up."""
    def run(batches):
        for batch, data, bounds in text_chunks(batches):
            lang = batch.column(0).dictionary_encode()
            salt = mix(np.array([zlib.crc32(x.as_py().encode()) for x in lang.dictionary], np.uint64))
            salt = salt[lang.indices.to_numpy()]
            for lo, hi in doc_steps(bounds, STEP_BYTES):
                h, doc = _sampled(data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo])
                h = np.unique(mix(h ^ salt[lo + doc]))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])
    return ONE_IN * named.mapInArrow(run, "h bigint").distinct().count()


def _terms(named: DataFrame, n: int, most: int | None = None) -> DataFrame:
    """Terms dealt by hash over ``n`` parts, each with its language behind
    it, so that one vocabulary holds all languages apart: ``lang``,
    ``source``, ``weight``, ``part``, ``terms`` (array).

    Rows of ``weight`` 0 stand for documents in what decides whether a term
    is in enough of them: a term is in as many rows as it has documents in a
    few chunks of a task (``HELD_BYTES``), or in ``most`` if those are fewer
    (a sum over all chunks reaches ``most`` with them if and only if it does
    without). They have no language and source. Rows of other weights
    add up, times the weight, to the vectors of a group's documents: the
    counts of those documents are added up by group, and a term is in
    the row of every power of two that its sum consists of."""
    def run(batches):
        held, size = [], 0
        try:
            for chunk, data, bounds in text_chunks(batches):
                held.append(_counts(chunk, data, bounds))
                size += sum(x.nbytes for x in held[-1][:-1])
                if size >= HELD_BYTES:
                    yield from _rows(held, n, most)
                    held, size = [], 0
            if held:
                yield from _rows(held, n, most)
        finally:
            held.clear()
            give_back()
    return named.mapInArrow(run, "lang string, source string, weight bigint, part int, terms array<string>")


# Counts of chunks that a task holds before it adds them up and emits them.
HELD_BYTES = 64 << 20

# Of a chunk: its terms with their languages (``kinds``) and the documents each
# is in; per group and term that occur together, the group's place in
# ``groups`` (language, source), the term's in ``kinds``, and the count.
Counts = namedtuple("Counts", "kinds docs group item count groups")


def _counts(chunk: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray) -> Counts:
    cuts = [(lo, _cut(data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo]))
            for lo, hi in doc_steps(bounds, STEP_BYTES)]
    letters = np.concatenate([c[0] for _, c in cuts])
    length = np.concatenate([c[1] for _, c in cuts])
    doc = np.concatenate([c[2] + lo for lo, c in cuts])
    del cuts
    words = pa.StringArray.from_buffers(
        len(length), pa.py_buffer(np.append(0, np.cumsum(length)).astype(np.int32)),
        pa.py_buffer(letters)).dictionary_encode()
    width = max(1, len(words.dictionary))
    pair, count = np.unique(doc * width + words.indices.to_numpy(), return_counts=True)
    doc, word = _divided(pair, width)
    # From here on terms are words with their language.
    lang = chunk.column(0).dictionary_encode()
    langs = max(1, len(lang.dictionary))
    key = word * langs + lang.indices.to_numpy()[doc]
    named_term, docs = _added(key, np.ones(len(key), np.int64), width * langs)
    term = np.searchsorted(named_term, key)
    kinds = pc.binary_join_element_wise(words.dictionary.take(pa.array(named_term // langs)),
                                        lang.dictionary.take(pa.array(named_term % langs)), "\x00")
    groups = {}
    of = np.array([groups.setdefault(g, len(groups))
                   for g in zip(chunk.column(0).to_pylist(), chunk.column(1).to_pylist())], np.int64)
    width = max(1, len(kinds))
    pair, count = _added(of[doc] * width + term, count, len(groups) * width)
    group, item = _divided(pair, width)
    return Counts(kinds, docs, group.astype(np.int32), item.astype(np.int32), count, list(groups))


def _rows(held: list[Counts], n: int, most: int | None):
    """The rows of ``_terms`` for the documents of some chunks together."""
    kinds = pa.concat_arrays([c.kinds for c in held]).dictionary_encode()
    code, kinds = kinds.indices.to_numpy(), kinds.dictionary
    # Terms in the order of their parts: what is sorted by group and term
    # has the terms of one part side by side.
    part = _part_of(kinds, n)
    order = np.argsort(part, kind="stable")
    part, kinds = part[order], kinds.take(pa.array(order))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    code = place[code]
    docs = np.bincount(code, np.concatenate([c.docs for c in held]), len(kinds)).astype(np.int64)
    for row in range(int(docs.max(initial=0)) if most is None else most):
        item = np.flatnonzero(docs > row)
        if not len(item):
            break
        yield _lists(part[item], np.zeros(len(item), np.int64), 0, kinds.take(pa.array(item)), [("", "")])
    groups, key, start, width = {}, [], 0, max(1, len(kinds))
    for c in held:
        number = np.array([groups.setdefault(g, len(groups)) for g in c.groups], np.int64)
        key.append(number[c.group] * width + code[start + c.item])
        start += len(c.kinds)
    key, count = _added(np.concatenate(key), np.concatenate([c.count for c in held]), len(groups) * width)
    group, item = _divided(key, width)
    for bit in range(int(count.max(initial=0)).bit_length()):
        has = np.flatnonzero((count >> bit) & 1)
        if len(has):
            yield _lists(part[item[has]], group[has], 1 << bit, kinds.take(pa.array(item[has])), list(groups))


# Keys below this are added up in a table of all of them, others by sorting.
TABLE_KEYS = 1 << 22


def _added(key: np.ndarray, amount: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys (below ``size``) in order, and the sum of the
    positive amounts of each."""
    if size <= TABLE_KEYS:
        sums = np.bincount(key, amount, size)
        keys = np.flatnonzero(sums)
        return keys, sums[keys].astype(np.int64)
    if not len(key):
        return key, amount
    order = np.argsort(key)
    key = key[order]
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[at], np.add.reduceat(amount[order], at)


def _divided(x: np.ndarray, by: int) -> tuple[np.ndarray, np.ndarray]:
    """Quotients and remainders; numpy's divmod takes some times as long."""
    whole = x // by
    return whole, x - whole * by


def _part_of(kinds: pa.StringArray, n: int) -> np.ndarray:
    """The vocabulary part of each term, by a hash of its bytes."""
    if n == 1 or not len(kinds):
        return np.zeros(len(kinds), np.int64)
    data, bounds = utf8(kinds)  # no term is empty
    up, down = powers(len(data))
    begin = bounds[:-1]
    return (mix(np.add.reduceat(_VALUE[data] * up, begin) * down[begin]) % np.uint64(n)).astype(np.int64)


def _lists(part: np.ndarray, group: np.ndarray, weight: int, terms: pa.StringArray,
           groups: list[tuple[str, str]]) -> pa.RecordBatch:
    """A row per run of entries of one part and group."""
    new = np.ones(len(part), bool)
    new[1:] = (part[1:] != part[:-1]) | (group[1:] != group[:-1])
    at = np.flatnonzero(new)
    lang, source = (pa.array(x, pa.string()).take(pa.array(group[at])) for x in zip(*groups))
    return pa.RecordBatch.from_arrays(
        [lang, source, pa.array(np.full(len(at), weight, np.int64)), pa.array(part[at].astype(np.int32)),
         pa.ListArray.from_arrays(pa.array(np.append(at, len(part)).astype(np.int32)), terms)],
        ["lang", "source", "weight", "part", "terms"])


def _parts(named: DataFrame, min_docs: int) -> list[DataFrame]:
    """The documents' terms, written, in one or more parts of the vocabulary."""
    spark = named.sparkSession
    n = max(1, math.ceil(_distinct_terms(named) / PART_TERMS))
    folder = scratch_path(spark, "divergence-terms")
    rows = _terms(named, n, max(1, min_docs)).withColumn("kind", F.when(F.col("weight") == 0, "document").otherwise("group"))
    rows.write.partitionBy("part", "kind").parquet(folder)
    held = spark.read.schema("lang string, source string, weight bigint, terms array<string>, "
                             "part int, kind string").parquet(folder)
    return [held.filter(F.col("part") == i).drop("part") for i in range(n)]


VECTOR = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


def _sums(part: DataFrame, number: int, min_docs: int) -> DataFrame:
    """``lang``, ``source``, ``term``, ``tid`` (unique number), ``n``: one
    part's document vectors summed by group. The vocabulary is fitted on the
    documents' rows; vectors are made of the groups' rows (see ``_terms``)."""
    spark = part.sparkSession
    model = CountVectorizer(inputCol="terms", outputCol="v", minDF=float(min_docs),
                            vocabSize=MAX_VOCABULARY).fit(part.filter("kind = 'document'"))
    saved = scratch_path(spark, "divergence-model")
    model.write().save(saved)
    vectors = scratch_path(spark, "divergence-vectors")
    model.transform(part.filter("kind = 'group'")).select("lang", "source", "weight", "v").write.parquet(vectors)
    # Read back as what a sparse vector is stored as.
    entries = (spark.read.schema(f"lang string, source string, weight bigint, v {VECTOR}").parquet(vectors)
               .select("lang", "source", "weight", "v.values", F.posexplode("v.indices").alias("k", "i"))
               .select("lang", "source", "i", (F.get("values", F.col("k")).cast("bigint") * F.col("weight")).alias("n")))
    sums = entries.groupBy("lang", "source", "i").agg(F.sum("n").alias("n"))
    words = spark.read.parquet(f"{saved}/data").select(F.posexplode("vocabulary").alias("i", "t"))
    words = words.select("i", F.substring_index("t", "\x00", 1).alias("term"))
    return stored(sums.join(words, "i").select(
        "lang", "source", "term", (F.lit(number << 32) + F.col("i")).alias("tid"), "n"), "divergence-sums")


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """Rows of ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Part ``pair``: the group's distance to each other source of its language,
    all ranks; 0 if the language keeps no term. Part ``term``: the terms
    whose share in the group exceeds that in the language, by distance, the
    first ``top``. Distances are floor((p - q)^2 / (p + q)) of shares
    p = 1 + floor(SCALE * (count + 2) / (N + 2 V)); ties go to the item that
    is first in UTF-8 order.

    NULL text, lang or source counts as ''; empty texts make a group with no
    terms; a group that occurs has its rows even so; a language of one
    source has no pairs; texts of any length are read whole; repeated rows
    count each time; an empty table gives no rows; other columns are not
    read. Sums and vectors are written to the shared folder, so a lost
    executor costs only what it held of a later step."""
    named = _named(docs, text_col, lang_col, source_col)
    sums = None
    for number, part in enumerate(_parts(named, min_docs)):
        rows = _sums(part, number, min_docs)
        sums = rows if sums is None else sums.unionByName(rows)
    by_lang = Window.partitionBy("lang", "term")
    sums = sums.withColumn("lang_n", F.sum("n").over(by_lang))
    sums = stored(sums.withColumn("first", F.col("source") == F.min("source").over(by_lang)), "divergence-counts")
    langs = sums.groupBy("lang").agg(F.sum("n").alias("lang_total"),
                                     F.count_if("first").cast("bigint").alias("v"))
    totals = sums.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    numbered = Window.partitionBy("lang").orderBy("source")
    groups = (named.select("lang", "source").distinct()
              .withColumn("s", F.row_number().over(numbered) - 1)
              .join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", "s", F.coalesce("total", F.lit(0)).alias("total"),
                      F.coalesce("lang_total", F.lit(0)).alias("lang_total"), F.coalesce("v", F.lit(0)).alias("v")))
    groups = groups.withColumn("none", F.when(F.col("v") > 0, _share(F.lit(0).cast("bigint"), F.col("total"), F.col("v"))))
    groups = stored(groups, "divergence-groups")
    entries = sums.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("v")))
    out = _pairs(entries, groups).unionByName(_top_terms(entries, top))
    return out.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                       F.row_number().over(order).alias("rank"))


def _top_terms(entries: DataFrame, top: int) -> DataFrame:
    """The rank filter lets Spark keep the first rows per group in each task
    before the shuffle, so no task gathers a group's whole vocabulary."""
    rows = entries.withColumn("q", _share(F.col("lang_n"), F.col("lang_total"), F.col("v"))).filter("p > q")
    rows = rows.select("lang", "source", F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value"))
    return _ranked(rows, "term").filter(F.col("rank") <= top)


def _pairs(entries: DataFrame, groups: DataFrame) -> DataFrame:
    tile = (F.col("s") / TILE).cast("int")
    last = F.max("s").over(Window.partitionBy("lang"))
    dealt = groups.withColumns({"tile": tile, "tiles": (last / TILE).cast("int") + 1,
                                "blocks": F.ceil(F.col("v") / BLOCK).cast("int")})
    # Every group that meets a block must be there, with or without entries.
    bare = (dealt.filter("v > 0")
            .select("lang", "s", "tile", "tiles", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                    F.lit(-1).cast("bigint").alias("tid"), F.col("none").alias("p")))
    full = entries.select("lang", "source", "tid", "p").join(
        dealt.select("lang", "source", "s", "tile", "tiles", "blocks"), ["lang", "source"]).select(
        "lang", "s", "tile", "tiles", F.pmod(F.xxhash64("tid"), F.col("blocks")).cast("int").alias("block"), "tid", "p")
    rows = bare.unionByName(full).select(
        "lang", "s", "block", "tid", "p", F.col("tile").alias("t"),
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    rows = rows.select("lang", "s", "block", "tid", "p", "t", F.least("t", "other").alias("i"),
                       F.greatest("t", "other").alias("j"))
    partial = (rows.groupBy("lang", "block", "i", "j").applyInPandas(_pair_block, "lang string, a int, b int, f bigint")
               .groupBy("lang", "a", "b").agg(F.sum("f").alias("f")))
    both = partial.unionByName(partial.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "f"))
    left = groups.select("lang", "source", F.col("s").alias("a"), "v", F.col("none").alias("p"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("s").alias("b"), F.col("none").alias("q"))
    rows = left.join(right, "lang").filter("a <> b").join(both, ["lang", "a", "b"], "left")
    # Terms that both lack, then what the entries change.
    value = F.when(F.col("v") == 0, F.lit(0).cast("bigint")).otherwise(
        F.col("v") * _distance(F.col("p"), F.col("q")) + F.coalesce("f", F.lit(0)))
    return _ranked(rows.select("lang", "source", "item", value.alias("value")), "pair")


def _pair_block(rows: pd.DataFrame) -> pd.DataFrame:
    """Per pair of sources a < b: the distances over the terms of this block
    that occur in either tile, less what those terms would add as absent."""
    lang, i, j = rows["lang"].iloc[0], rows["i"].iloc[0], rows["j"].iloc[0]
    entry = rows["tid"].to_numpy() >= 0
    terms, column = np.unique(rows["tid"].to_numpy()[entry], return_inverse=True)

    def matrix(t):
        own = rows["t"].to_numpy() == t
        bare = rows[own & ~entry].sort_values("s")
        s, none = bare["s"].to_numpy(), bare["p"].to_numpy(np.int64)
        m = np.repeat(none[:, None], len(terms), axis=1)
        held = own[entry]
        m[np.searchsorted(s, rows["s"].to_numpy()[entry][held]), column[held]] = rows["p"].to_numpy()[entry][held]
        return s, none, m

    s, none, m = matrix(i)
    s2, none2, m2 = (s, none, m) if i == j else matrix(j)
    first, second, change = [], [], []
    for k in range(len(s)):
        lo = k + 1 if i == j else 0
        d, t = m2[lo:] - m[k], m2[lo:] + m[k]
        d *= d
        absent = (none2[lo:] - none[k]) ** 2 // (none2[lo:] + none[k])
        first.append(np.full(len(s2) - lo, s[k]))
        second.append(s2[lo:])
        change.append((d // t).sum(axis=1) - len(terms) * absent)
    a = np.concatenate(first)
    return pd.DataFrame({"lang": np.full(len(a), lang, object), "a": a, "b": np.concatenate(second),
                         "f": np.concatenate(change)})
