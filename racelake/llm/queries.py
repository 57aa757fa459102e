"""The registered queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from racelake.llm import (bitpack, bpe, decontam, divergence, licenses, lm_trie, pii, rlz, rules, secrets, simhash,
                          toxicity, variants)
from racelake.llm.common import crc_fold, documents
from racelake.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lm_trie(spark, sf_dir):
    docs = documents(spark, sf_dir)
    trained = crc_fold(docs["doc_id"], 7) != 2
    return lm_trie.score(docs, lm_trie.train(docs, trained), trained)


def op2_rlz_dedup(spark, sf_dir):
    return rlz.digest(rlz.remove_duplicates(documents(spark, sf_dir)))


def op3_rule_ledger(spark, sf_dir):
    rows = rules.apply_policy(rules.ledger(documents(spark, sf_dir)))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "base_failed", "kept", "failed")


def op4_toxic_segments(spark, sf_dir):
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, lambda i: crc_fold(i, 4) != 2)
    rows = toxicity.score(docs, model)
    return rows.select("doc_id", (crc_fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                       "predicted", "n_passages")


def op5_bilstm_crf(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return pii.detect(docs, pii.train(docs))


def op6_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", "fingerprint", "component_id")


def op7_license_compression(spark, sf_dir):
    return licenses.scan(documents(spark, sf_dir)).select(
        "doc_id", "n_notices", F.array_join(F.transform("notices", lambda x: F.concat_ws(
            ":", x["license"], x["first"].cast("string"), x["end"].cast("string"))), ",").alias("notices"),
        F.array_join(F.flatten(F.col("notices.differences")), ";").alias("differences"))


def op8_spaced_seeds(spark, sf_dir):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.contamination(documents(spark, sf_dir), bench).select(
        "doc_id", "n_items", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"),
        F.round("best_share", 6).alias("best_share"), "contaminated")


def op9_bpe(spark, sf_dir):
    return bpe.digest(documents(spark, sf_dir), tokenizer_path())


def op10_bit_packing(spark, sf_dir):
    folder = scratch_path(spark, "token-blocks")
    bitpack.write(documents(spark, sf_dir), tokenizer_path(), folder)
    return bitpack.checksums(spark, folder)


def op11_source_divergence(spark, sf_dir):
    return divergence.audit(documents(spark, sf_dir))


def op12_spelling_variants(spark, sf_dir):
    return variants.variants(documents(spark, sf_dir))


def op13_secrets(spark, sf_dir):
    return secrets.digest(secrets.scan(documents(spark, sf_dir), tokenizer_path(RANKS)))


QUERIES = {f.__name__: f for f in (
    op1_lm_trie, op2_rlz_dedup, op3_rule_ledger, op4_toxic_segments, op5_bilstm_crf, op6_simhash,
    op7_license_compression, op8_spaced_seeds,
    op9_bpe, op10_bit_packing, op11_source_divergence, op12_spelling_variants, op13_secrets)}

# DuckDB SQL for the queries that SQL expresses in full.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_SHARE = "(1 + (1000000000::HUGEINT * ({c} + 2)) // ({n} + 2 * {v}))"
_DISTANCE = "(({p} - {q}) * ({p} - {q})) // ({p} + {q})"

ORACLE = {
    "op11_source_divergence": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
        kept AS (SELECT lang, term, count(*) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
        l AS (SELECT lang, sum(c) AS n, count(*) AS v FROM kept GROUP BY lang),
        c AS (SELECT t.lang, t.source, t.term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL),
        g AS (SELECT g.lang, g.source, coalesce(s.n, 0) AS n, coalesce(l.v, 0) AS v, coalesce(l.n, 0) AS ln
            FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN l USING (lang)
            LEFT JOIN (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL) s USING (lang, source)),
        p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
                {_SHARE.format(c="coalesce(c.c, 0)", n="g.n", v="g.v")} AS p,
                {_SHARE.format(c="k.c", n="g.ln", v="g.v")} AS q
            FROM g JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        f AS (SELECT a.lang, a.source, b.source AS item, sum({_DISTANCE.format(p="a.p", q="b.p")}) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
        terms AS (SELECT lang, source, 'term' AS part, term AS item, {_DISTANCE.format(p="p", q="q")} AS value
            FROM p WHERE c > 0 AND p > q)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
        WHERE part = 'pair' OR rank <= 10""",
    "op3_rule_ledger": rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
        spots AS (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5),
        grams AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM spots),
        twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
        covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
            SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
        lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)),
                    lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
        m AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
                coalesce(covered.n, 0) AS n_repeat_words
            FROM d JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
        f AS (SELECT *,
                CASE WHEN n_words < 10 THEN 1 ELSE 0 END
              + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
              + CASE WHEN 10 * n_symbols > 2 * n_words AND n_symbols >= 5 THEN 4 ELSE 0 END
              + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
              + CASE WHEN n_words > 0 AND word_chars < 2 * n_words THEN 16 ELSE 0 END
              + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END AS failed FROM m)
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
            CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
            CAST(n_repeat_words AS BIGINT) AS n_repeat_words, (failed & 3) <> 0 AS base_failed,
            failed = 0 AS kept, CAST(failed AS BIGINT) AS failed FROM f""",
    # Every alignment of a document and an item on any common token.
    "op8_spaced_seeds": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(
                coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(
                coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark WHERE item_id IS NOT NULL),
        dt AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
        bt AS (SELECT item_id, len(w) AS n, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM b),
        m AS (SELECT r, item_id, n, p - j AS shift, j FROM dt JOIN bt USING (x)),
        e AS (SELECT r, item_id, shift FROM m GROUP BY r, item_id, shift, n
            HAVING 100 * count(*) >= 80 * least(20, n)),
        c AS (SELECT r, item_id, n, count(*) OVER (PARTITION BY r, item_id, shift ORDER BY j
                RANGE BETWEEN CURRENT ROW AND 19 FOLLOWING) AS c FROM m JOIN e USING (r, item_id, shift)),
        f AS (SELECT r, item_id, max(c) / least(20, n) AS share FROM c GROUP BY r, item_id, n
            HAVING 100 * max(c) >= 80 * least(20, n)),
        g AS (SELECT r, count(*) AS k, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items,
                max(share) AS share FROM f GROUP BY r)
        SELECT doc_id, CAST(coalesce(k, 0) AS BIGINT) AS n_items, coalesce(items, '') AS items,
            round(CAST(coalesce(share, 0) AS DOUBLE), 6) AS best_share, k IS NOT NULL AS contaminated
        FROM d LEFT JOIN g USING (r)""",
    "op2_rlz_dedup": rf"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        spots AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
        wins AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS g FROM spots),
        twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM wins) WHERE n > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM twice),
        words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
        kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n
            FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
            sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)""",
}
