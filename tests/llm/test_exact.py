"""Operators with exact results against brute force, on edge cases and on a
small driver table."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from racelake.llm import bitpack, bpe, decontam, lm_trie, rlz, rules, simhash
from racelake.llm.common import crc_fold
from racelake.llm.queries import QUERIES, tokenizer_path
from racelake.session import scratch_path

from llm_helpers import by_row, ordered

WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
SF = "/root/testdata/sf0.001"


def low(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


@pytest.fixture(scope="module", params=["edge", "table"])
def case(request, spark, rows, docs):
    if request.param == "edge":
        return rows, docs
    d = spark.read.parquet(f"{SF}/documents.parquet")
    return [tuple(r) for r in d.select("doc_id", "text").collect()], d


def test_lm_base_and_counts(case):
    rows, docs = case
    trained = crc_fold(docs["doc_id"], 7) != 2
    model = lm_trie.train(docs, trained)
    got = by_row(lm_trie.score(docs, model, trained), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    fold = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7
    c = collections.Counter(w for i, t in rows if fold(i) != 2 for w in [*WORDS(low(t or "")), "\n"])
    n = sum(c.values())
    bottom = math.log10(n + len(c) + 1)
    want = ordered((i, fold(i) == 2, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10(c[x] + 1) - bottom for x in w))
                   for i, t in rows for w in [[*WORDS(low(t or "")), "\n"]])
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert sorted(g[5] for g in got) == pytest.approx(sorted(w[5] for w in want))
    assert all(g[6] < 0 and math.isfinite(g[6]) for g in got)


def test_lm_score_is_the_smoothed_bigram(spark):
    rows = [(0, "a b a b c"), (1, "a b c c"), (2, "a x"), (3, "b a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    on = F.col("doc_id") < 2
    model = lm_trie.train(docs, on)
    got = dict(by_row(lm_trie.score(docs, model, on), "score"))
    uni, pair, ctx = (collections.Counter() for _ in range(3))
    for i, t in rows[:2]:
        for u, w in itertools.pairwise(["<", *t.split(), ">"]):
            uni[w] += 1
            pair[u, w] += 1
            ctx[u] += 1
    n, m = sum(uni.values()), lm_trie.MASS
    e = min(0.5, max(1, sum(v == 1 for v in uni.values())) / n)
    for i, t in rows:
        s = 0.0
        for u, w in itertools.pairwise(["<", *t.split(), ">"]):
            p = (1 - e) * uni[w] / n if uni[w] else e
            s += math.log10((pair[u, w] + m * p) / (ctx[u] + m))
        assert got[i] == pytest.approx(s, abs=0.01)


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, top in ((0, 1), (1, 2 ** 63), (500, 90), (3000, 2 ** 64 - 1)):
        v = np.unique(rng.integers(0, top, n, dtype=np.uint64))
        ef = lm_trie.EliasFano(lm_trie.EliasFano.encode(v))
        assert (ef.get(np.arange(len(v))) == v).all()
        q = np.concatenate([v, rng.integers(0, top, 200, dtype=np.uint64)])
        assert (ef.successor(q) == np.searchsorted(v, q)).all()
        assert (ef.find(v) == np.arange(len(v))).all()


def test_substring_dedup(case):
    rows, docs = case
    words = [WORDS(t or "") for _, t in rows]
    times = collections.Counter(tuple(w[i:i + 35]) for w in words for i in range(len(w) - 34))
    want = []
    for (i, _), w in zip(rows, words):
        keep = [True] * len(w)
        for k in range(len(w) - 34):
            if times[tuple(w[k:k + 35])] > 1:
                keep[k:k + 35] = [False] * 35
        left = [x for x, y in zip(w, keep) if y]
        want.append((i, len(w), len(w) - len(left), hashlib.sha256(" ".join(left).encode()).hexdigest()))
    assert by_row(rlz.digest(rlz.remove_duplicates(docs)), "n_words", "n_removed", "kept_sha256") == ordered(want)


def test_substring_dedup_in_many_blocks(docs, monkeypatch):
    want = by_row(rlz.remove_duplicates(docs), "n_removed")
    monkeypatch.setattr(rlz, "BLOCK_TEXT_BYTES", 2000)
    assert by_row(rlz.remove_duplicates(docs), "n_removed") == want


def test_greedy_parse_against_the_index():
    """Every factor is the longest match of its place with any other place,
    and the parse goes on right behind it; passages end all matches."""
    rng = np.random.default_rng(4)
    for trial in range(300):
        size = rng.integers(1, 12 if trial % 2 else 60, rng.integers(1, 7))
        head = np.cumsum(size) - size
        letters = rlz._letters(np.zeros(size.sum(), np.uint64), rng.integers(0, rng.integers(1, 9), size.sum(), dtype=np.uint64))
        parts = [letters[a:a + n].tolist() for a, n in zip(head, size)]
        want = []
        for p, part in enumerate(parts):
            at = 0
            while at < len(part):
                best = 0
                for q, other in enumerate(parts):
                    for o in range(len(other)):
                        if (p, at) != (q, o):
                            n = 0
                            while at + n < len(part) and o + n < len(other) and part[at + n] == other[o + n]:
                                n += 1
                            best = max(best, n)
                if best:
                    want.append((head[p] + at, best))
                at += best or 1
        begin, count = rlz._factorise(letters, head, size)
        assert list(zip(begin, count)) == want


def test_substring_dedup_comes_from_the_parse(spark, monkeypatch):
    """A text assembled from the ends of two others: the factor that begins in
    one and the windows across the seam are told apart, and without matches
    nothing is removed."""
    w = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(w[:100])), (2, " ".join(w[100:])), (3, " ".join(w[60:140])), (4, " ".join(["so"] * 3000))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_removed, r.kept_text) for r in rlz.remove_duplicates(docs).collect()}
    assert got == {1: (40, " ".join(w[:60])), 2: (40, " ".join(w[140:])), 3: (80, ""), 4: (3000, "")}
    factors = [np.frombuffer(r.factors, rlz._FACTOR)["words"].tolist()
               for r in rlz.duplicate_factors(docs).filter("doc_id = 4").collect()]
    assert factors == [[2999, 35]]  # overlapping itself, then the last window


def test_substring_dedup_of_long_repetitive_texts(spark):
    phrase = [f"p{i}" for i in range(7)]
    rows = [(1, " ".join((phrase * 30_000)[:200_000])), (2, " ".join(f"u{i}" for i in range(200_000)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in rlz.remove_duplicates(docs).collect()}
    assert got == {1: (200_000, 200_000), 2: (200_000, 0)}


def test_rules(case):
    rows, docs = case
    want = []
    for i, t in rows:
        t = t or ""
        w = WORDS(t)
        grams = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        covered = {p for k in range(len(w) - 4) if grams[tuple(w[k:k + 5])] > 1 for p in range(k, k + 5)}
        lines = [x for x in t.split("\n") if WORDS(x)]
        want.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
                     len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w)))
    got = rules.apply_policy(rules.ledger(docs))
    assert by_row(got, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == ordered(want)
    assert got.filter("base_failed AND kept").count() == 0
    table = {r.rule: r for r in rules.ablation(got).collect()}
    failed = [r.failed for r in got.collect()]
    for name, (bit, _) in rules.RULES.items():
        assert table[name].n_failed == sum(bool(f & bit) for f in failed)
        assert table[name].n_only == sum(f == bit for f in failed)


def test_simhash(case):
    import xxhash

    rows, docs = case
    fps = []
    for _, t in rows:
        w = WORDS(low(t or ""))
        s = [" ".join(w[k:k + 4]) for k in range(len(w) - 3)] if len(w) > 3 else [" ".join(w)][:len(w)]
        h = np.array([xxhash.xxh64_intdigest(x.encode(), 42) for x in s], np.uint64)
        fps.append(sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h)))
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 4 and group[a] != group[b]:
            x, y = group[a], group[b]
            group = [x if g == y else g for g in group]
    least = {g: min((rows[k][0] for k in range(len(rows)) if group[k] == g and rows[k][0] is not None), default=None)
             for g in set(group)}
    want = ordered((i, format(f, "016x"), least[g]) for (i, _), f, g in zip(rows, fps, group))
    assert by_row(simhash.near_duplicates(docs), "fingerprint", "component_id") == want


def test_group_index_links_all_within_distance():
    rng = np.random.default_rng(1)
    f = [int(c) for c in rng.integers(0, 2 ** 63, 12, dtype=np.uint64)]
    f += [f[k % 12] ^ sum(1 << int(b) for b in rng.integers(0, 64, 3)) for k in range(800)]
    f = np.unique(np.array(f, np.uint64))
    near = np.bitwise_count(f[:, None] ^ f) <= 4
    want = simhash._joined(np.arange(len(f)), *np.nonzero(near))
    got = simhash.GroupIndex(f).components(4)
    assert len(set(zip(want.tolist(), got.tolist()))) == len(set(want.tolist())) == len(set(got.tolist()))


def test_large_simhash_groups_are_split(spark):
    """A family of near copies that share most ranges: no group of more than
    the bound, and every two fingerprints within four bits still meet."""
    rng = np.random.default_rng(3)
    flips = np.uint64(1) << rng.integers(0, 64, (1500, 3)).astype(np.uint64)
    fps = np.unique(np.append(np.bitwise_xor.reduce(flips, axis=1) ^ np.uint64(0xDEADBEEF12345678),
                              rng.integers(0, 1 << 63, 300).astype(np.uint64)))
    table = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint")
    masks, bound = simhash._choices(4, 2), 100
    whole, _ = simhash.groups(table, masks, len(fps))
    assert whole.groupBy("key").count().agg(F.max("count")).first()[0] > 3 * bound
    rows, total = simhash.groups(table, masks, len(fps), bound)
    rows = rows.toPandas()
    assert len(rows) == total and rows.groupby("key").size().max() <= 1.4 * bound
    node = np.searchsorted(fps, rows["fp"].to_numpy().view(np.uint64))
    met = np.zeros((len(fps), len(fps)), bool)
    for at in rows.groupby("key").indices.values():
        met[np.ix_(node[at], node[at])] = True
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    assert near.sum() > 10 * len(fps) and (met | ~near).all()
    label = lambda e: simhash._joined(
        np.arange(len(fps)), *(np.searchsorted(fps, np.array([r[k] for r in e], np.int64).view(np.uint64)) for k in "ab"))
    assert (label(simhash.links(table, group_rows=bound).collect()) == simhash._joined(np.arange(len(fps)), *np.nonzero(near))).all()


def test_masks_survive_substitutions():
    """Any floor(n / 5) substitutions in 7 to 20 words leave a seed intact."""
    ones = [[k for k, c in enumerate(m) if c == "1"] for m in decontam.MASKS]
    for n in range(7, 21):
        for gone in itertools.combinations(range(n), n // 5):
            assert any(not set(gone) & {p + k for k in o}
                       for o, m in zip(ones, decontam.MASKS) for p in range(n - len(m) + 1)), (n, gone)


def test_short_items_survive_a_substitution(spark):
    """Items of 5 and 6 words with any one word replaced, at the start, within
    and at the end of a document, or cut off by its start or end."""
    items = {n: [f"w{n}x{k}" for k in range(n)] for n in range(1, 8)}
    rows, want = [], []
    for n, item in items.items():
        for c in [item[:k] + ["other"] + item[k + 1:] for k in range(n)] + [item[1:], item[:-1], item]:
            for text in (c, ["a", "b", *c, "d"], [*c, "d"], ["a", *c]):
                want.append((len(rows), [n] if n >= 5 or c == item else []))
                rows.append((len(rows), " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(n, " ".join(x)) for n, x in items.items()], "item_id bigint, text string")
    got = sorted((r.doc_id, r["items"]) for r in decontam.contamination(docs, bench).collect())
    assert [(rows[i][1], x) for i, x in got] == [(rows[i][1], x) for i, x in want]


def test_decontamination(spark, docs, rows):
    item = PASSAGE_WORDS = [f"word{i}" for i in range(5, 40)]
    changed = ["zzz" if k % 6 == 3 else w for k, w in enumerate(PASSAGE_WORDS)]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "plain TEXT of"), (3, None), (None, "a few"), (4, " ".join(changed)),
                                   (5, "quite another item that no document holds at all")], "item_id bigint, text string")
    got = by_row(decontam.contamination(docs, bench), F.array_join(F.col("items").cast("array<string>"), ","), "contaminated")
    want = ordered((i, x, bool(x)) for i, t in rows
                   for x in ["1,4" if t and "word20" in t else "2" if t and "plain text of" in low(t) else ""])
    assert got == want


def test_bpe_tasks_keep_no_words():
    """What a task has learnt is dropped at its end, also when it is not read
    to the end; its texts are taken in small steps."""
    texts = ["some words " * 9, "", "other words, é"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(texts)], ["doc_id", "text"])
    enc = bpe.encoder(tokenizer_path())
    want = enc.encode(texts)
    got = [x for ids, rows, _ in bpe._encoded(iter([batch.slice(1, 0), batch.slice(2), batch]), tokenizer_path())
           for x in rows]
    assert got == want[2:] + want
    assert not enc.known and not enc.older
    half = bpe._encoded(iter([batch, batch]), tokenizer_path())
    next(half)
    assert enc.known
    half.close()
    assert not enc.known and not enc.older


def test_bpe_and_blocks(spark, case):
    from tokenizers import Tokenizer

    rows, docs = case
    library = Tokenizer.from_file(tokenizer_path())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    ids = [library.encode(t or "", add_special_tokens=False).ids for _, t in rows]
    want = ordered((i, len(x), sha(",".join(map(str, x))), sha(library.decode(x, skip_special_tokens=False)))
                   for (i, _), x in zip(rows, ids))
    assert by_row(bpe.digest(docs, tokenizer_path()), "n_tokens", "ids_sha256", "decoded_sha256") == want
    back = bpe.decode(bpe.encode(docs, tokenizer_path()), tokenizer_path())
    assert by_row(back, "text") == ordered((i, t or "") for i, t in rows)

    folder = scratch_path(spark, "t-blocks")
    bitpack.write(docs, tokenizer_path(), folder, ids_per_part=20_000)
    got = sorted(bitpack.checksums(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == list(itertools.accumulate([r.n_tokens for r in got], initial=0))[:-1]
    crc = lambda x: zlib.crc32(np.array([*x, 0], "<u4").tobytes())
    assert ordered((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == ordered(
        (i, len(x) + 1, crc(x)) for (i, _), x in zip(rows, ids))
    some = next(r for r in got if r.n_tokens > 5)
    assert len(bitpack.read_ids(spark, folder, some.start + 1, some.start + 4)) == 3


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31])
def test_pack_round_trip(bits):
    x = np.random.default_rng(bits).integers(0, 2 ** bits, 1001).astype(np.uint32)
    raw = bitpack.pack(x, bits)
    assert len(raw) == -(-1001 * bits // 8)
    assert (bitpack.unpack(raw, 1001, bits) == x).all() and (bitpack.unpack(raw, 200, bits, 700) == x[700:900]).all()


def test_every_number_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES) == list(range(1, 14))


def test_repetitive_text_against_items_that_hold_its_phrase(spark):
    """A text of 1 MB that aligns with 20 items everywhere: rows stay small
    (this ran out of a 4 GB heap when each held the document)."""
    phrase = "one two three four five six seven"
    items = [(i, f"{phrase} " * (1 + i % 4) + " ".join(f"t{i}w{k}" for k in range(i % 7))) for i in range(20)]
    text = f"{phrase} " * 30_000
    docs = spark.createDataFrame([(1, text), (2, text), (2, text), (3, phrase), (4, "nothing of it"), (None, text)],
                                 "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = by_row(decontam.contamination(docs, bench), "items", "best_share")

    def share(item, doc):
        a, b = item.split(), doc.split()
        width = min(20, len(a))
        best = 0
        for shift in range(-len(a), len(b)):
            same = [0 <= shift + j < len(b) and b[shift + j] == w for j, w in enumerate(a)]
            best = max(best, max(sum(same[k:k + width]) for k in range(len(a) - width + 1)))
        return best / width

    def row(doc):
        shares = {i: share(t, doc) for i, t in items}
        found = {i: s for i, s in shares.items() if s >= 0.8}
        return sorted(found), max(found.values(), default=0.0)
    long = row(f"{phrase} " * 12)  # every alignment of the long text occurs in this one
    want = [(1, *long), (2, *long), (2, *long), (3, *row(phrase)), (4, [], 0.0), (None, *long)]
    assert got == ordered(want)


def test_trie_tasks_give_back_what_they_freed(monkeypatch):
    """A worker outlives its task: each of the trie's steps ends by returning
    memory, also when a task is left early or fails."""
    returned = []
    monkeypatch.setattr(lm_trie, "give_back", lambda: returned.append(1))
    batch = pa.RecordBatch.from_pydict({"text": ["a b a", ""], "train": [True, True]})
    counts = lm_trie._freed(lm_trie._train_counts)(iter([batch, batch]))
    next(counts)
    assert not returned
    counts.close()
    assert len(returned) == 1

    def broken(rows):
        raise ValueError

    rows = pd.DataFrame({"shard": [0]})
    with pytest.raises(ValueError):
        lm_trie._freed_group(broken)(rows)
    assert lm_trie._freed_cogroup(lambda a, b: a)(rows, rows) is rows
    assert len(returned) == 3
