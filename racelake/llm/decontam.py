"""Benchmark decontamination by spaced seeds, built-in expressions only.

A mask of ones and zeros is laid over the token sequence at every position;
the tokens under its ones are hashed, those under its zeros are ignored, so a
substituted word under a zero does not hide a copied passage. Seeds of the
training documents and of the benchmark are joined on their hash; every hit
fixes an alignment of a document and an item, which is then verified token
by token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelake.llm.common import id_and_text, stored

SPLIT = "[\\x20\\x09-\\x0D]+"
# Any floor(n / 5) substitutions in n words, 7 <= n <= 20, leave one of these
# masks intact somewhere (tests/llm/test_exact.py tries them all).
MASKS = ("11011", "110011", "1010011")
# Besides them, for items of that many words: with these, so does one
# substitution in 5 or 6 words. Fewer words must agree in all of them.
SHORT = {**{n: ("1" * n,) for n in range(1, 5)}, 5: ("1111", "10111", "11101"), 6: ("1111",)}
WINDOW = 20
PIECE = 256  # tokens of a document's piece, at least (the longest item's if that is longer)
SHARE = 80  # percent of a window's tokens that must agree
# Above this many seeds the benchmark is no longer broadcast (24 bytes each).
MAX_BROADCAST_SEEDS = 1_000_000


def _tokens(text: Column) -> Column:
    """Words with A-Z lower-cased."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.transform(F.filter(F.split(low, SPLIT), lambda w: w != ""), lambda w: F.xxhash64(w))


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _seeds(tokens: Column, masks) -> Column:
    """Array of seeds: one hash per mask and position that has the whole
    mask; the masks' hashes are separated by the mask's number. Index i of a
    mask's part is position i."""
    def of(t, number, mask):
        ones = [k for k, c in enumerate(mask) if c == "1"]
        return F.when(F.size(t) >= len(mask), F.transform(
            F.sequence(F.lit(0), F.size(t) - len(mask)),
            lambda i: F.xxhash64(F.lit(number), *[F.get(t, i + k) for k in ones])))
    return _let(tokens, lambda t: F.array(*[F.coalesce(of(t, n, m), F.array().cast("array<bigint>"))
                                            for n, m in enumerate(masks)]))


def _all_masks(items: DataFrame) -> dict[str, list[int]]:
    """MASKS, and those of SHORT that items need, each with the item lengths
    it is for (none: any)."""
    short = (items.filter(F.size("item_tokens").isin(list(SHORT)))
             .agg(F.collect_set(F.size("item_tokens")).alias("n")).first()["n"])
    masks: dict[str, list[int]] = {m: [] for m in MASKS}
    for n in sorted(short):
        for m in SHORT[n]:
            masks.setdefault(m, []).append(n)
    return masks


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_items`` (bigint, distinct items
    found), ``items`` (their ids, ascending), ``best_share`` (double, largest
    share of agreeing tokens in a window; 0 if none) and ``contaminated``.

    An item is found if, at an alignment given by a seed, some window of
    WINDOW of its tokens (the whole item if shorter) agrees with the
    document in SHARE percent of its tokens or more. NULL and blank texts
    have no tokens and match nothing; items of NULL id are ignored;
    documents of equal id and text get equal rows.

    Texts of any length, repetitive ones too, are verified in pieces of
    bounded length: the rows of a document grow with its length, the size of
    a row does not. Seeds are exploded as (document key, position, hash): the
    text stays behind and only documents with a hit are read again. The
    benchmark's seeds are broadcast up to MAX_BROADCAST_SEEDS (counted
    first), beyond that the join is shuffled and AQE splits hot seeds."""
    d = id_and_text(docs, id_col, text_col).withColumns({
        "th": F.xxhash64("text"), "dk": F.coalesce(F.col("doc_id").cast("string"), F.lit(""))})
    items = benchmark.select(
        benchmark[item_col].cast("bigint").alias("item_id"),
        _tokens(F.coalesce(benchmark[item_text_col], F.lit(""))).alias("item_tokens")
    ).filter(F.col("item_id").isNotNull())
    masks = _all_masks(items)

    marks = items.select("item_id", F.size("item_tokens").alias("n"),
                         F.posexplode(_seeds(F.col("item_tokens"), masks)).alias("mask", "part"))
    lengths = F.array(*[F.array(*map(F.lit, n)).cast("array<int>") for n in masks.values()])
    marks = (marks.filter((F.col("mask") < len(MASKS)) | F.array_contains(F.get(lengths, F.col("mask")), F.col("n")))
        .select("item_id", F.posexplode("part").alias("item_pos", "seed")))
    if marks.count() <= MAX_BROADCAST_SEEDS:
        marks = F.broadcast(marks)

    # Written, so that its size is known when the documents are joined to it.
    found = stored(d.select("dk", "th", F.explode(_seeds(_tokens(F.col("text")), masks)).alias("part"))
                   .select("dk", "th", F.posexplode("part").alias("pos", "seed"))
                   .join(marks, "seed")
                   .select("dk", "th", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift"))
                   .distinct(), "seed-hits")
    # Pieces of the documents that have hits: every alignment's tokens lie in
    # the piece it begins in, so no row ever holds a whole document.
    longest = items.agg(F.max(F.size("item_tokens"))).first()[0] or 1
    step = max(PIECE, longest)
    pieces = (d.select("dk", "th", "text").join(found.select("dk", "th").distinct(), ["dk", "th"], "left_semi")
              .dropDuplicates(["dk", "th"])
              .select("dk", "th", F.explode(_pieces(_tokens(F.col("text")), step, longest)).alias("x"))
              .select("dk", "th", "x.piece", "x.tokens"))
    begin = F.greatest("shift", F.lit(0))
    aligned = found.withColumn("piece", (begin / step).cast("int")).join(pieces, ["dk", "th", "piece"])
    aligned = aligned.join(items, "item_id")
    lead = begin - F.col("shift")  # tokens of the item before the document's first
    cut = F.slice("tokens", begin - F.col("piece") * step + 1,
                  F.greatest(F.size("item_tokens") - lead, F.lit(0)).cast("int"))
    # A repetitive text aligns in many places with few different slices.
    slices = aligned.select("dk", "th", "item_id", F.concat(
        F.array_repeat(F.lit(None).cast("bigint"), lead.cast("int")), cut).alias("part")).distinct()
    verified = (slices.join(items, "item_id")
                .select("dk", "th", "item_id", _best_window(F.col("part"), F.col("item_tokens")).alias("share"))
                .filter(F.col("share") * 100 >= SHARE)
                .groupBy("dk", "th")
                .agg(F.sort_array(F.collect_set("item_id")).alias("items"),
                     F.max("share").alias("best_share")))
    return (d.select("doc_id", "dk", "th").join(verified, ["dk", "th"], "left")
            .select("doc_id", F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
                    F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
                    F.coalesce("best_share", F.lit(0.0)).alias("best_share"),
                    F.col("items").isNotNull().alias("contaminated"), F.col("th").alias("text_hash")))


def _pieces(tokens: Column, step: int, reach: int) -> Column:
    """Array of (piece, tokens): ``step`` tokens and the ``reach`` after."""
    def cut(t):
        return F.transform(F.sequence(F.lit(0), F.greatest(F.size(t) - 1, F.lit(0)), F.lit(step)), lambda i: F.struct(
            (i / step).cast("int").alias("piece"), F.slice(t, i + 1, F.lit(step + reach)).alias("tokens")))
    return _let(tokens, cut)


def _best_window(part: Column, item: Column) -> Column:
    """Largest share of agreeing tokens over the item's windows."""
    same = F.transform(item, lambda x, j: F.when(F.get(part, j) == x, 1).otherwise(0))
    width = F.least(F.lit(WINDOW), F.size(item))

    def best(m):
        sums = F.transform(F.sequence(F.lit(1), F.size(m) - width + 1),
                           lambda i: F.aggregate(F.slice(m, i, width), F.lit(0), lambda a, x: a + x))
        return F.array_max(sums).cast("double") / width
    return _let(same, best)
