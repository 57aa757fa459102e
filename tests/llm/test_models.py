"""Learnt and fuzzy operators, empty tables, and the pipeline."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from racelake.llm import bitpack, bpe, decontam, licenses, lm_trie, pii, rlz, rules, simhash, toxicity
from racelake.llm.common import crc_fold
from racelake.llm.queries import tokenizer_path
from racelake.session import scratch_path

from llm_helpers import by_row, ordered

SF = "/root/testdata/sf0.001"


def test_segments_are_all_maximal():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 14)
        score = [rng.choice([-toxicity.DRIFT] * 2 + [1.0, 0.3, -2.0]) for _ in range(n)]
        hits = [i for i, s in enumerate(score) if s != -toxicity.DRIFT]
        got = toxicity.segments(np.array(hits, int), np.array([score[i] for i in hits]))

        def split(lo, hi):  # the definition: best segment, then left and right of it
            best = max(((round(sum(score[a:b]), 9), -(b - a), -a, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=None)
            if best is None or best[0] <= 0:
                return []
            return split(lo, best[3]) + [(best[3], best[4], best[0])] + split(best[4], hi)
        assert sum(s for *_, s in got) == pytest.approx(sum(s for *_, s in split(0, n)))
        assert max((s for *_, s in got), default=0) == pytest.approx(max((s for *_, s in split(0, n)), default=0))


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels, lambda i: crc_fold(i, 4) != 2)
    held = toxicity.score(docs, model).join(labels, "doc_id").filter(crc_fold(F.col("doc_id"), 4) == 2)
    r = held.agg(*[F.count_if(F.expr(x)) for x in (
        "toxic = 1 AND predicted = 1", "toxic = 1", "toxic = 0 AND predicted = 1", "toxic = 0")]).first()
    assert r[0] >= 0.85 * r[1] and r[2] <= 0.03 * r[3]


def test_toxicity_edge_cases(spark, docs, rows):
    labels = spark.createDataFrame([(1, 1), (5, 0), (5, 0), (7, None), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels, lambda i: F.lit(True))
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    none = toxicity.train(docs, labels.filter("false"), lambda i: F.lit(True))
    assert toxicity.score(docs, none).count() == len(rows)


def brute_spans(t):
    out = []
    for kind, p in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                              r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, t):
            d = [int(c) for c in m[0] if c.isdigit()]
            luhn = sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(d))) % 10 == 0
            if (kind == 0 or kind == 1 and all(int(x) < 256 for x in m[0].split("."))
                    or kind == 2 and 13 <= len(d) <= 19 and luhn or kind == 3 and 9 <= len(d) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


def test_base_patterns_equal_plain_regexes():
    rng = random.Random(3)
    for _ in range(30_000):
        t = "".join(rng.choice("ab.@_%+-0123456789 ()é") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == brute_spans(t), t
    assert pii.base_spans("a" * 200_000 + "@b") == []


def test_gradient():
    net = pii.Network.initial()
    rng = np.random.default_rng(0)
    w, y = rng.integers(0, pii.N_CLASSES, (3, pii.WINDOW)), rng.integers(0, pii.N_TAGS, (3, pii.WINDOW))
    _, g = net.loss_and_gradient(w, y)
    for k, v in net.p.items():
        at, old = tuple(np.array(v.shape) // 2), v[tuple(np.array(v.shape) // 2)]
        loss = []
        for e in (0.01, -0.01):
            v[at] = old + e
            loss.append(net.loss_and_gradient(w, y)[0])
        v[at] = old
        assert (loss[0] - loss[1]) / 0.02 == pytest.approx(float(g[k][at]), abs=2e-3)


class WordsWithoutSpace:
    """In place of the network: tags every run of other characters than
    spaces as an address, as far as its window shows it."""

    def decode(self, windows):
        word = (windows != 4) & (windows != 0)
        first = word & ~np.pad(word, ((0, 0), (1, 0)), constant_values=True)[:, :-1]
        return np.where(first, 1, np.where(word, 2, 0)), np.ones(windows.shape)


def test_spans_are_read_beyond_the_cells_of_their_marks():
    for before, after in itertools.product((1, 20, 30, 70, 200), (2, 30, 70, 200)):
        for lead in range(0, 60, 7):
            text = "x" * lead + " " + "a" * before + "@" + "b" * after + " " + "c" * 50
            at = lead + 1
            assert pii.base_spans(text) == []
            assert pii.find_spans([text, "", text], WordsWithoutSpace()) == [
                [(0, at, at + before + 1 + after)], [], [(0, at, at + before + 1 + after)]], (lead, before, after)


@pytest.fixture(scope="module")
def network(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return pii.train(docs.filter("doc_id % 2 = 0"))


# Notations that training does not plant.
UNSEEN = {"notations": {"email": ("n [at] h dot t", "n [at] h [dot]t", "n@h [dot] t"),
                        "phone": ("(999) 999 9999", "999-999 9999", "99-9999-9999", "999 9999 999")},
          "card_marks": (": ", " / ", ".. "), "ip_marks": ("(dot)", " [.] ", ". ")}


@pytest.mark.parametrize("kinds", [{}, UNSEEN])
def test_network_finds_what_the_patterns_cannot_see(spark, network, kinds):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    r, texts, planted = random.Random(5), [], []
    for (t,) in docs.filter("doc_id % 4 = 1 AND length(trim(text)) > 0").orderBy("doc_id").select("text").collect():
        new, spans, _, _ = pii.plant(t, r, **kinds)
        base = pii.base_spans(new)
        texts.append(new)
        planted.append({s for s in spans if s not in base})
    wanted = sum(map(len, planted))
    for net, least in ((None, 0), (network, 0.9)):
        new = [set(f) - set(pii.base_spans(t)) for t, f in zip(texts, pii.find_spans(texts, net))]
        found, other = sum(len(f & p) for f, p in zip(new, planted)), sum(len(f - p) for f, p in zip(new, planted))
        print(f"{found} of {wanted} planted spans, {other} others")
        assert wanted > 1000 and found >= least * wanted and other <= 0.02 * wanted and (net or not found)


def test_planted_spans_are_where_they_are_said_to_be():
    r = random.Random(1)
    for text in ("", " ", "one", "some plain words in a row", "LONG " * 5000):
        for _ in range(200):
            new, spans, lo, hi = pii.plant(text, r)
            assert all(lo <= s < e <= hi and pii._plausible(k, new[s:e]) or new[s:e].count("@") for k, s, e in spans)
            left = new[:lo] + new[hi:]
            assert re.sub(r"[\s.,)]", "", left) == re.sub(r"[\s.,)]", "", text)


def test_network_finds_spans_it_has_not_seen(spark, network):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    net = network
    found = wanted = added = 0
    for (t,) in docs.filter("doc_id % 2 = 1 AND text RLIKE '[0-9@]'").select("text").collect():
        base = pii.base_spans(t)
        s = pii.window_starts(t)
        tags, _ = net.decode(pii._cut(pii.classes(t), s))
        own = slice(pii.STRIDE // 2, pii.STRIDE // 2 + pii.STRIDE)
        place = (s[:, None] + np.arange(pii.WINDOW)[own]).ravel()
        got = np.zeros(len(t) + pii.WINDOW, int)
        got[place[place >= 0]] = tags[:, own].ravel()[place >= 0]
        for kind, a, b in base:
            wanted += 1
            found += bool((got[a:b] == pii.tags_of(len(t), [(kind, a, b)])[a:b]).all())
        added += len(pii.find_spans([t], net)[0]) - len(base)
    assert wanted > 200 and found >= 0.9 * wanted and added <= 0.05 * wanted


def test_pii_rows_and_redaction(docs, rows):
    net = pii.train(docs)
    got = by_row(pii.detect(docs, net), "n_email", "n_phone", "base_sha256")
    assert len(got) == len(rows)
    mail = next(t for i, t in rows if i == 12)
    base = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in brute_spans(mail))
    row = pii.detect(docs, None).filter("doc_id = 12").first()
    assert row.spans == base and (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 1)
    out = {r.doc_id: r for r in pii.redact(docs, None).collect()}
    assert out[12].text == "mail me: [EMAIL] or [CARD], [PHONE] at 10.0.0.300 or [IP]" and out[2].text is None and out[12].th == "x"


def test_licenses(spark):
    t = licenses.TEMPLATES
    rows = [(1, "Foo bar.\n" + t["Apache-2.0"] + "\nbaz"), (2, t["GPL-3.0"].replace("work", "code").upper()), (3, None), (4, ""),
            (5, "a license to drive the public version of things, generally apache"), (6, "x " * 30_000 + t["MIT-text"]),
            (7, t["CC-BY-NC-4.0"] + " " + t["all-rights-reserved"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.notices for r in licenses.scan(docs).collect()}
    assert {i: [n.license for n in x] for i, x in got.items()} == {
        1: ["Apache-2.0"], 2: ["GPL-3.0"], 3: [], 4: [], 5: [], 6: ["MIT-text"], 7: ["CC-BY-NC-4.0", "all-rights-reserved"]}
    assert got[2][0].differences == ["replace:work>code"] and got[1][0].differences == []


def test_full_texts_and_their_kin():
    """Licenses that differ in a clause or a few words are told apart."""
    s = licenses.Scanner()
    assert len(s.names) >= 15 and max(map(len, s.words)) > 200
    for name, text in licenses.TEMPLATES.items():
        x, = s.scan("foo bar baz " * 20 + text.upper() + " qux quux" * 20)
        assert (x["license"], x["share"], x["differences"]) == (name, 1.0, [])


def test_ranking_by_compression_decides(monkeypatch):
    """Two confirmed wordings overlap: the one that saves more bytes takes the
    place, though the other one is longer."""
    s = licenses.Scanner({
        "long": "on it zz extraordinarily unmistakable circumstances notwithstanding yy of us in an",
        "tight": "unconditionally extraordinarily unmistakable circumstances notwithstanding indemnification of"})
    text = "on it unconditionally extraordinarily unmistakable circumstances notwithstanding indemnification of us in an"
    assert [x["license"] for x in s.scan(text)] == ["tight"]
    monkeypatch.setattr(s, "saved", lambda part, k: 0)
    assert [x["license"] for x in s.scan(text)] == ["long"]


def test_license_scan_edge_cases(spark):
    """NULL ids, repeated rows, ties and extra columns named like the result."""
    t = licenses.TEMPLATES["MIT"]
    rows = [(None, t, "a", 1), (None, t, "a", 1), (2, None, None, None), (3, " \n ", "x", 2), (4, f"{t} {t}", "y", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, notices string, n_notices int")
    got = sorted(((r.doc_id or 0, r.n_notices) for r in licenses.scan(docs).collect()))
    assert got == [(0, 1), (0, 1), (2, 0), (3, 0), (4, 2)]


def test_no_license_notice_without_a_telling_word():
    s = licenses.Scanner()
    for words in s.words:
        rest = [w for w in words if w not in s.telling]
        assert len(rest) < s.share * len(words)


@pytest.mark.parametrize("gap", [0, 1, 6, 10, 40, 60])
@pytest.mark.parametrize("filler", ["word", "license"])
def test_repeated_notices(gap, filler):
    s = licenses.Scanner()
    for name, t in licenses.TEMPLATES.items():
        n = len(licenses.words(t))
        if n > 100 and gap not in (0, 40):
            continue
        got = s.scan(f" {' '.join([filler] * gap)} ".join([t] * 4))
        assert [(x["license"], x["first"], x["end"]) for x in got] == [
            (name, i * (n + gap), i * (n + gap) + n) for i in range(4)], (name, gap)


def test_notice_beside_a_longer_partial_run():
    s = licenses.Scanner()
    want = licenses.words(licenses.TEMPLATES["GPL-3.0-or-later"])
    # No run over 8 words; the version, which tells it from its kin, stays.
    real = [f"new{i}" if i % 9 == 3 else w for i, w in enumerate(want)]
    for text in (want[:12] + ["and"] * 3 + real, real + ["and"] * 3 + want[:12]):
        got = s.scan(" ".join(text))
        assert [(x["license"], len(x["differences"])) for x in got] == [("GPL-3.0-or-later", 5)]


def test_notice_that_saves_no_bytes():
    """An exact notice whose template makes its block 11 bytes longer."""
    before = ("geau enerach von tzst ökeitß und für unglichen enieschä chsch ung einachen ung enst erzuer er ungstber ä der er "
              "einbeheit dieeinerlich enach die ber des enbebersch in der und auf lichüpf enchschheit chtzß enen enstzulich ch "
              "erßü tzkeit die schein ieie").split()
    after = ("geung diechiekeitst enbeeinsch schver verü von ßkeit ieie die geeinungte enenachß der enungst chüte erenü enchpf "
             "einein chauver im schberer der enchtzbe schpf und entz erchie üheiter enkeitverä ö des auö enung von fürchschverzu "
             "keitungzu enung pf erauein mit engeein enheit einachie").split()
    s = licenses.Scanner()
    mit = licenses.words(licenses.TEMPLATES["MIT"])
    block = " ".join([*before, *mit, *after]).encode()
    k = s.names.index("MIT")
    assert len(s.compress[k].compress(block)) >= len(s.plain.compress(block))  # holds for zstandard's level 3
    got = s.scan(block.decode())
    assert [(x["license"], x["first"], x["share"]) for x in got] == [("MIT", len(before), 1.0)]


def test_license_places_are_all_places():
    """Against trying every set of places of short templates."""
    s = licenses.Scanner({"a": "p q r s t", "b": "p q p r p s q t u v", "c": "x y z"})
    rng = random.Random(1)

    def common(a, b):
        r = [0] * (len(b) + 1)
        for x in a:
            r = list(itertools.accumulate(range(len(b)), lambda last, j: r[j] + 1 if x == b[j] else max(r[j + 1], last), initial=0))
        return r[-1]
    for _ in range(200):
        k = rng.randrange(3)
        want, text = s.words[k], []
        for _ in range(rng.randint(1, 4)):
            y = list(want)
            for _ in range(rng.randint(0, 3)):
                i = rng.randrange(len(y) + 1)
                y[i:i + rng.randint(0, 1)] = [rng.choice([*want, "n"])] * rng.randint(0, 1)
            text += y + ["n"] * rng.randint(0, 2)
        best = [(0, 0, 0)]
        for e in range(1, len(text) + 1):
            sizes = ((f, common(want, text[f:e])) for f in range(e) if {text[f], text[e - 1]} <= set(want))
            best.append(max([best[-1], *((best[f][0] + 1, best[f][1] + n, best[f][2] - e + f) for f, n in sizes
                                         if n >= s.share * max(len(want), e - f))]))
        got = s.places(text, k)
        assert all(x[1] <= y[0] for x, y in zip(got, got[1:]))
        found = [common(want, text[f:e]) for f, e in got]
        assert (len(got), sum(found), sum(f - e for f, e in got)) == best[-1], (text, want, got)
        assert [s.compare(text[f:e], k)[0] * len(want) for f, e in got] == pytest.approx(found)


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    on = F.lit(True)
    folder = scratch_path(spark, "t-none")
    bitpack.write(empty, tokenizer_path(), folder)
    for df in (lm_trie.score(empty, lm_trie.train(empty, on), on), rlz.remove_duplicates(empty),
               rules.apply_policy(rules.ledger(empty)), pii.detect(empty, pii.train(empty)), simhash.near_duplicates(empty),
               toxicity.score(empty, toxicity.train(empty, labels, lambda i: on)), licenses.scan(empty),
               decontam.contamination(empty, bench), bpe.digest(empty, tokenizer_path()), bitpack.checksums(spark, folder)):
        assert df.count() == 0


def test_pipeline_stages_take_effect(spark, docs):
    import corpus_pipeline as P

    stages = dict(P.STAGES)
    kept = stages["quality_rules"](spark, docs, SF)
    assert kept.columns == docs.columns
    want = rules.apply_policy(rules.ledger(docs)).filter("kept").count()
    assert kept.count() == want
    one = stages["simhash_near_dedup"](spark, docs, SF)
    assert one.columns == docs.columns
    assert one.count() == simhash.near_duplicates(docs).select("group_fp").distinct().count()
    clean = stages["benchmark_decontamination"](spark, docs, SF)
    assert clean.count() == docs.count() and clean.columns == docs.columns
    assert stages["pii"](spark, docs, SF).columns == docs.columns


def test_pipeline_over_a_table(spark):
    import corpus_pipeline as P

    out = P.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r.doc_id for r in out.collect()}
    kept = rules.apply_policy(rules.ledger(docs)).filter("kept").select("doc_id")
    one = {r[0] for r in simhash.near_duplicates(docs.join(kept, "doc_id")).select("component_id").distinct().collect()}
    bad = {r.doc_id for r in decontam.contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).filter("contaminated").collect()}
    assert ids == one - bad and out.count() == len(ids)
