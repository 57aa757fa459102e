"""Toxic passages: maximum-scoring segments over token log-odds.

Every token has a score: the log-odds of its appearing in toxic rather than
other documents, under Dirichlet (beta) priors. The prior of a word is the
posterior of its stem (its first six, five, four bytes), the prior of a stem
the class rate, so an unseen word of a toxic stem scores like the stem.
Tokens that say nothing have the same small negative score. All maximal
scoring segments of a document are found in one linear scan (Ruzzo and
Tompa, 1999); a segment's significance follows the extreme-value law of
maximal segments (Karlin and Altschul, 1990), and the document's score is a
logistic function of its best segment's significance.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelake.llm.common import doc_steps, id_and_text, mix, stored, text_chunks

# The labelled rows learnt from, at most (those of least id hash); one half
# gives the token scores, the other calibrates them.
SAMPLE_ROWS = 20_000
MIN_DOCS = 3
PRIOR = 5.0  # strength of a prior, in documents
CAUTION = 2.0  # standard deviations a positive log-odds is lowered by
DRIFT = 0.25
STEMS = (6, 5, 4)
THRESHOLD = 0.3
MAX_E = 0.05  # passages are reported up to this expected number by chance

_R = np.uint64(0xC2B2AE3D27D4EB4F)


def _tables():
    value = mix(np.arange(1, 257, dtype=np.uint64))
    value[65:91] = value[97:123]
    ascii_ = np.arange(128)
    letters = ((ascii_ | 32) >= 97) & ((ascii_ | 32) <= 122)
    value[:128][~letters] = 0
    return value


_VALUES = _tables()


def _features(data: np.ndarray, bounds: np.ndarray):
    """Per token (letter run, A-Z lower-cased): its document and a column of
    hashes per feature: whole word, then the stems (0: word too short)."""
    values = _VALUES[data]
    black = values != 0
    first = black.copy()
    first[1:] &= ~black[:-1]
    edge = bounds[:-1][bounds[:-1] < len(data)]
    first[edge] = black[edge]
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, np.empty((1 + len(STEMS), 0), np.uint64)
    last = black.copy()
    last[:-1] &= ~black[1:]
    inner = edge[edge > 0] - 1
    last[inner] = black[inner]
    ends = np.flatnonzero(last) + 1
    doc = np.searchsorted(bounds, starts, "right") - 1
    rel = np.zeros(len(data), np.int64)  # place in the word
    rel[starts[0]:] = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values + rel.astype(np.uint64) * _R) * black)])
    out = [mix(sums[ends] - sums[starts])]
    for k in STEMS:
        long = ends - starts >= k
        out.append(np.where(long, mix((sums[np.where(long, starts + k, starts)] - sums[starts]) ^ np.uint64(k)), np.uint64(0)))
    return doc, np.stack(out)


def _feature_counts(batches):
    """(feature, level, parent, toxic documents, other documents) per chunk."""
    for batch, data, bounds in text_chunks(batches, 1 << 20):
        doc, f = _features(data, bounds)
        toxic = batch.column("toxic").to_numpy()
        for level in range(len(f)):
            some = f[level] != 0
            d, h = doc[some], f[level][some]
            parent = np.zeros(len(h), np.uint64)
            for up in range(len(f) - 1, level, -1):  # the longest stem it has
                parent = np.where(f[up][some] != 0, f[up][some], parent)
            order = np.lexsort((d, h))
            d, h, parent = d[order], h[order], parent[order]
            new = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])) if len(h) else np.zeros(0, bool)
            d, h, parent = d[new], h[new], parent[new]
            u, at = np.unique(h, return_index=True)
            if not len(u):
                continue
            y = toxic[d].astype(np.int64)
            y1 = np.add.reduceat(y, at)
            n = np.diff(np.append(at, len(h)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(u.view(np.int64)), pa.array(np.full(len(u), level, np.int32)),
                 pa.array(parent[at].view(np.int64)), pa.array(y1), pa.array(n - y1)],
                ["f", "level", "parent", "y1", "y0"])


def token_scores(rows: list, positives: int, negatives: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted features with a positive score and their scores, from rows
    (f, level, parent, y1, y0). A log-odds is lowered by CAUTION
    standard deviations, so that rare tokens have to earn their score."""
    rate = (positives + 0.5) / (positives + negatives + 1)
    base = np.log(rate / (1 - rate))
    mean = {}
    found = {}
    for f, _, parent, y1, y0 in sorted(rows, key=lambda r: -r[1]):  # stems first
        prior = mean.get(parent, rate)
        a, b = y1 + PRIOR * prior, y0 + PRIOR * (1 - prior)
        mean[f] = a / (a + b)
        spread = np.sqrt(1 / (y1 + PRIOR * rate) + 1 / (y0 + PRIOR * (1 - rate)))
        score = np.log(a / b) - base - CAUTION * spread
        if score > 0:
            found[f] = score
        elif parent in found:
            found[f] = -DRIFT  # a harmless word of a toxic stem
    keys = np.array(list(found), np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array(list(found.values()), np.float64)[order]


def segments(at: np.ndarray, score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, end, score) of a document
    whose tokens score -DRIFT, but for those at the places ``at``.

    The Ruzzo-Tompa scan over the scored tokens, gaps taken in one step:
    time linear in their number."""
    out: list[list] = []  # first, end, prefix sum before, prefix sum after
    total, last = 0.0, -1
    for i, s in zip(at.tolist(), score.tolist()):
        total -= DRIFT * (i - last - 1)
        last = i
        if s <= 0:
            total += s
            continue
        new = [i, i + 1, total, total + s]
        total += s
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= new[2]:
                j -= 1
            if j < 0 or out[j][3] >= new[3]:
                out.append(new)
                break
            new = [out[j][0], new[1], out[j][2], new[3]]
            del out[j:]
    return [(a, b, r - x) for a, b, x, r in out]


def _hits(keys: np.ndarray, scores: np.ndarray, data, bounds):
    """Per document: number of tokens; places and scores of scored tokens."""
    doc, f = _features(data, bounds)
    n = np.bincount(doc, minlength=len(bounds) - 1)
    value = np.full(len(doc), np.nan)
    if len(keys):
        for level in range(len(f) - 1, -1, -1):  # the most specific wins
            i = np.minimum(np.searchsorted(keys, f[level]), len(keys) - 1)
            ok = keys[i] == f[level]
            value[ok] = scores[i[ok]]
    hit = np.flatnonzero(~np.isnan(value))
    cut = np.searchsorted(doc[hit], np.arange(len(n) + 1))
    first = np.cumsum(n) - n
    return [(int(n[d]), hit[cut[d]:cut[d + 1]] - first[d], value[hit[cut[d]:cut[d + 1]]]) for d in range(len(n))]


@dataclass
class Model:
    keys: np.ndarray
    scores: np.ndarray
    rate: float  # decay of the extreme-value law
    scale: float  # its K
    bias: float
    slope: float

    def e_value(self, n: int, score: float) -> float:
        """Expected segments of this score or more in n harmless tokens."""
        return float(self.scale * max(n, 1) * np.exp(-self.rate * score))

    def evidence(self, n: int, best: float) -> float:
        """-log10 of the best segment's p-value under the null, up to 12."""
        if best <= 0:
            return 0.0
        p = -np.expm1(-self.e_value(n, best))
        return float(min(12.0, -np.log10(max(p, 1e-12))))

    def score(self, n: int, best: float) -> float:
        return float(1 / (1 + np.exp(-(self.bias + self.slope * self.evidence(n, best)))))


def _calibrate(keys, scores, rows) -> Model:
    """``rows``: (label, tokens, best segment, positive token scores)."""
    null = [r for r in rows if r[0] == 0]
    tokens = sum(r[1] for r in null) + 1
    gains = np.concatenate([np.asarray(r[3], float) for r in null] or [np.empty(0)])
    # One more hit of the least positive score keeps the law proper when the
    # sample holds none.
    gains = np.append(gains, max(gains.min() if len(gains) else 1.0, 0.5))
    lo, hi = 1e-3, 50.0
    for _ in range(60):  # sum p e^(rate s) = 1
        mid = (lo + hi) / 2
        value = ((tokens - len(gains)) * np.exp(-mid * DRIFT) + np.exp(np.minimum(mid * gains, 700)).sum()) / tokens
        lo, hi = (mid, hi) if value < 1 else (lo, mid)
    rate = lo
    # K from the mean over the null documents of exceedances (method of moments).
    best = np.array([r[2] for r in null if r[1] > 0] or [0.0])
    size = np.array([r[1] for r in null if r[1] > 0] or [1])
    scale = max(1e-9, float(np.sum(best > 0) + 0.5) / float(np.sum(size * np.exp(-rate * gains.min()))))
    model = Model(keys, scores, rate, scale, 0.0, 1.0)
    x = np.array([model.evidence(r[1], r[2]) for r in rows])
    y = np.array([r[0] for r in rows], float)
    # Ridge logistic regression on one feature, by Newton steps.
    w = np.zeros(2)
    a = np.stack([np.ones(len(x)), x])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(w @ a, -30, 30)))
        g = a @ (p - y) + np.array([0.01, 0.01]) * w
        h = (a * (p * (1 - p))) @ a.T + np.eye(2) * 0.01
        w -= np.linalg.solve(h, g)
    model.bias, model.slope = float(w[0]), float(max(w[1], 0.0))
    return model


def train(docs: DataFrame, labels: DataFrame, allowed, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns from at most ``sample_rows`` labelled rows where the boolean
    column expression ``allowed(id column)`` holds: those of least id hash,
    copies of a text once. A repeated label row counts once, a document with
    any label 1 is toxic, NULL labels are ignored."""
    known = labels.select(labels[id_col].cast("bigint").alias("doc_id"), labels[label_col].cast("int").alias("toxic"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & allowed(F.col("doc_id")))
    known = (known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    d = id_and_text(docs, id_col, text_col)
    sample = stored(d.join(F.broadcast(known), "doc_id")  # at most sample_rows rows of two numbers
                    .withColumn("th", F.xxhash64("text")).dropDuplicates(["th"])
                    .withColumn("half", F.pmod(F.xxhash64("th"), F.lit(2))), "toxic-sample")
    fit, rest = sample.filter("half = 0"), sample.filter("half = 1")
    keys, scores = _learn(fit)

    def scan(batches):
        for batch, data, bounds in text_chunks(batches, 1 << 20):
            found = _hits(keys, scores, data, bounds)
            best = [max((s[2] for s in segments(at, sc)), default=0.0) for _, at, sc in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array([x[0] for x in found], pa.int64()), pa.array(best, pa.float64()),
                 pa.array([x[2][x[2] > 0] for x in found], pa.list_(pa.float64()))], ["toxic", "n", "best", "gains"])
    half = rest.select("text", "toxic").mapInArrow(scan, "toxic int, n bigint, best double, gains array<double>").collect()
    model = _calibrate(keys, scores, [(int(r[0] != 0), r[1], r[2], r[3] or []) for r in half])
    model.keys, model.scores = _learn(sample)  # with the law of unseen texts, the scores of all
    return model


def _learn(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Token scores of a labelled sample. Features that more toxic documents
    hold than chance would have are counted anew by distinct contexts (the
    words before and after), so that near copies of one toxic document and
    passages shared by several count once."""
    n0, n1 = sample.agg(F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") != 0)).first()
    rate = (n1 + 0.5) / (n0 + n1 + 1)
    rows = (sample.select("text", "toxic").mapInArrow(_feature_counts, "f bigint, level int, parent bigint, y1 bigint, y0 bigint")
            .groupBy("f").agg(F.min("level").alias("level"), F.min("parent").alias("parent"),
                              F.sum("y1").alias("y1"), F.sum("y0").alias("y0"))
            # Only features some toxic documents have can score; bounded by the sample.
            .filter((F.col("y1") + F.col("y0") >= MIN_DOCS) & (F.col("y1") > 0)).collect())
    likely = {r["f"] for r in rows if r["y1"] > 1.5 * rate * (r["y1"] + r["y0"])}
    rows = {r["f"]: r for r in rows if r["f"] in likely or r["parent"] in likely}
    wanted = np.sort(np.array(list(rows), np.int64).view(np.uint64))
    counts = (sample.select("text", "toxic").mapInArrow(_contexts(wanted), "f bigint, ctx bigint, toxic int")
              .groupBy("f", "ctx").agg(F.max("toxic").alias("toxic"))
              .groupBy("f").agg(F.sum("toxic").alias("y1"), F.count(F.lit(1)).alias("n")).collect())
    return token_scores([(r["f"], rows[r["f"]]["level"], rows[r["f"]]["parent"], r["y1"], r["n"] - r["y1"])
                         for r in counts], n1, n0)


def _contexts(wanted: np.ndarray):
    """Distinct (feature, context, toxic) of the wanted features per chunk."""
    def run(batches):
        for batch, data, bounds in text_chunks(batches, 1 << 20):
            if not len(wanted):
                return
            doc, f = _features(data, bounds)
            word = np.concatenate([np.zeros(1, np.uint64), f[0], np.zeros(1, np.uint64)])
            ctx = mix(word[:-2] * _R + word[2:])
            toxic = (batch.column("toxic").to_numpy() != 0).astype(np.uint64)[doc]
            for level in range(len(f)):
                i = np.minimum(np.searchsorted(wanted, f[level]), len(wanted) - 1)
                at = np.flatnonzero(wanted[i] == f[level])
                t = np.unique(np.stack([f[level][at], ctx[at], toxic[at]], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(t[:, 0]).view(np.int64)), pa.array(np.ascontiguousarray(t[:, 1]).view(np.int64)),
                     pa.array(t[:, 2].astype(np.int32))], ["f", "ctx", "toxic"])
    return run


SCHEMA = ("doc_id bigint, score double, predicted int, n_passages bigint, "
          "passages array<struct<first: bigint, end: bigint, score: double, e_value: double>>")


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, max_e: float = MAX_E,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``score`` (0 to 1), ``predicted``,
    ``n_passages`` and ``passages`` (token ranges of the maximal segments
    expected by chance at most ``max_e`` times in a text of this length).

    NULL, blank and unscored texts get the score of no evidence. No shuffle;
    the model is a few thousand numbers."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for b in batches:
            for batch, data, bounds in text_chunks([b]):
                rows = []
                for lo, hi in doc_steps(bounds, 1 << 20):
                    part = data[bounds[lo]:bounds[hi]]
                    for n, at, sc in _hits(m.keys, m.scores, part, bounds[lo:hi + 1] - bounds[lo]):
                        seg = segments(at, sc) if len(at) else []
                        p = m.score(n, max((s[2] for s in seg), default=0.0))
                        good = [{"first": a, "end": e, "score": s, "e_value": m.e_value(n, s)}
                                for a, e, s in seg if m.e_value(n, s) <= max_e]
                        rows.append((p, int(p >= threshold), len(good), good))
                p, y, k, good = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(p, pa.float64()), pa.array(y, pa.int32()), pa.array(k, pa.int64()),
                     pa.array(good, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()),
                                                        ("score", pa.float64()), ("e_value", pa.float64())])))],
                    ["doc_id", "score", "predicted", "n_passages", "passages"])
    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
