"""Quality rules as a bitmask ledger, built-in expressions only.

Every rule is evaluated once per document. The ledger keeps the measurements
and one bit per rule (1: the document fails it); a policy is a versioned set
of bits, so verdicts and ablations of any policy come from the stored bits
without reading a text again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelake.llm.common import id_and_text

WHITE = " \t\n\u000b\f\r"
SPLIT = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
REPEAT_WORDS = 5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

# Bit of each rule and when a document's measurements m fail it (integer
# arithmetic only).
RULES = {
    "few_words": (1, lambda m: m["n_words"] < 10),
    "repeated_words": (2, lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"]),
    "symbols": (4, lambda m: (10 * m["n_symbols"] > 2 * m["n_words"]) & (m["n_symbols"] >= 5)),
    "duplicate_lines": (8, lambda m: 100 * m["n_dup_lines"] > 30 * m["n_lines"]),
    "short_words": (16, lambda m: (m["n_words"] > 0) & (m["word_chars"] < 2 * m["n_words"])),
    "long_words": (32, lambda m: m["word_chars"] > 20 * m["n_words"]),
}
BASE = RULES["few_words"][0] | RULES["repeated_words"][0]
POLICIES: dict[str, int] = {
    "base-1": BASE,
    "strict-1": sum(bit for bit, _ in RULES.values()),
}
DEFAULT_POLICY = "strict-1"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row: a lambda's
    variable is bound to it, so it is not repeated for each array element."""
    return F.transform(F.array(value), body)[0]


def _length_without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _repeated_words(hashes: Column) -> Column:
    """Words inside REPEAT_WORDS-word windows that occur twice or more."""
    def windows(h):
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - REPEAT_WORDS),
            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(REPEAT_WORDS)]))

    def covered(g):
        placed = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        twice = _let(placed, lambda s: F.filter(
            s, lambda x, j: (F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                             | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)))))
        places = F.sort_array(F.transform(twice, lambda x: x["p"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-REPEAT_WORDS).alias("last"))
        return F.aggregate(
            places, start,
            lambda a, p: F.struct(
                (a["n"] + F.least(F.lit(REPEAT_WORDS), p - a["last"])).alias("n"), p.alias("last")),
            lambda a: a["n"])

    def count(g):
        return F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(covered(g))

    return _let(hashes, lambda h: F.when(F.size(h) < REPEAT_WORDS + 1, 0)
                .otherwise(_let(windows(h), count)))


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.translate(x, WHITE, "") != "")


def with_ledger(docs: DataFrame, text_col: str = "text", name: str = "__ledger") -> DataFrame:
    """``docs`` with a struct column ``name``: the measurements (bigint) and
    ``failed`` (bigint, one bit per rule of RULES).

    NULL and blank texts have no words and fail ``few_words``. Windows are
    compared by a 64-bit hash within one text. Work and memory are bounded
    by the document; no shuffle."""
    text = F.coalesce(docs[text_col], F.lit(""))
    words = lambda t: F.filter(F.split(t, SPLIT), lambda x: x != "")

    def measure(t):
        by_word = _let(F.transform(words(t), lambda w: F.xxhash64(w)), lambda h: F.struct(
            F.size(h).alias("n_words"), _repeated_words(h).alias("n_repeat_words")))
        by_line = _let(_lines(t), lambda x: F.struct(
            F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
        return _let(by_word, lambda w: _let(by_line, lambda n: F.struct(*[
            c.cast("bigint").alias(k) for k, c in (
                ("n_words", w["n_words"]), ("word_chars", _length_without(t, WHITE)),
                ("n_symbols", F.length(t) - _length_without(t, SYMBOLS)), ("n_lines", n["n_lines"]),
                ("n_dup_lines", n["n_dup_lines"]), ("n_repeat_words", w["n_repeat_words"]))])))

    def judge(m):
        failed = F.lit(0).cast("bigint")
        for bit, test in RULES.values():
            failed = failed.bitwiseOR(F.when(test(m), F.lit(bit)).otherwise(F.lit(0)).cast("bigint"))
        return F.struct(*[m[k].alias(k) for k in MEASURES], failed.alias("failed"))
    return docs.withColumn(name, _let(_let(text, measure), judge))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and the fields of ``with_ledger``."""
    return with_ledger(id_and_text(docs, id_col, text_col)).select("doc_id", "__ledger.*")


def keeps(failed: Column, policy: str = DEFAULT_POLICY) -> Column:
    """No bit of the base policy or of ``policy`` is set."""
    return failed.bitwiseAND(F.lit(POLICIES[policy] | BASE)) == 0


def apply_policy(rows: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` to the rows of a ledger."""
    return (rows.withColumn("base_failed", F.col("failed").bitwiseAND(F.lit(BASE)) != 0)
            .withColumn("kept", keeps(F.col("failed"), policy)))


def ablation(rows: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """What each rule of a policy does: ``rule``, ``n_failed`` (documents
    that fail it), ``n_only`` (documents only it rejects, kept without it)
    and ``n_rejected`` (by the whole policy).

    Documents are first counted per distinct bitmask (at most 2^rules
    groups, combined before the shuffle)."""
    mask = POLICIES[policy]
    seen = (rows.select(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits"))
            .groupBy("bits").agg(F.count(F.lit(1)).alias("n")))
    rules = [(name, bit) for name, (bit, _) in RULES.items() if bit & mask]
    zero = F.lit(0)
    sums = [F.sum(F.when(F.col("bits") != 0, F.col("n")).otherwise(zero)).alias("n_rejected")]
    for name, bit in rules:
        sums += [F.sum(F.when(F.col("bits").bitwiseAND(F.lit(bit)) != 0, F.col("n")).otherwise(zero)).alias(f"f_{name}"),
                 F.sum(F.when(F.col("bits") == bit, F.col("n")).otherwise(zero)).alias(f"o_{name}")]
    one = seen.agg(*sums)
    return one.select(F.explode(F.array(*[F.struct(
        F.lit(name).alias("rule"), F.coalesce(F.col(f"f_{name}"), zero).alias("n_failed"),
        F.coalesce(F.col(f"o_{name}"), zero).alias("n_only"),
        F.coalesce(F.col("n_rejected"), zero).alias("n_rejected")) for name, _ in rules])).alias("r")).select("r.*")
