"""Helpers shared by the operators: shared folders, chunks, word hashes."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.session import scratch_path

# The white space that separates words in every contract: space and \t\n\v\f\r.
WORD = r"[^\x20\x09-\x0D]+"

# Bytes of text whose words are hashed in one numpy step, and bytes of text
# whose results are gathered before rows are emitted.
STEP_BYTES = 1 << 20
CHUNK_BYTES = 4 << 20

_M64 = (1 << 64) - 1
_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 1 << 64)


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written below the shared checkpoint folder and read back: cuts
    the lineage at files every executor can reach."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package's sources to the executors, once per application,
    as ``spark-submit --py-files`` would: tasks import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    top = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="racelake-src-")  # on the driver; Spark serves the file from there
    target = f"{folder}/racelake_src.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(target)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``doc_id`` (bigint) and ``text`` (NULL becomes '')."""
    ship_package(docs.sparkSession)
    return docs.select(docs[id_col].cast("bigint").alias("doc_id"),
                       F.coalesce(docs[text_col], F.lit("")).alias("text"))


def crc_fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds``; a NULL id counts as ''."""
    return (F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def text_bytes(docs: DataFrame) -> int:
    """Total bytes of text (one cheap pass; reads the text column only)."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


# --- words as 64-bit hashes ---------------------------------------------

def _byte_table(lower: bool) -> np.ndarray:
    """A random 64-bit value per byte; white space is 0."""
    t = mix(np.arange(1, 257, dtype=np.uint64))
    if lower:
        t[65:91] = t[97:123]
    t[[32, 9, 10, 11, 12, 13]] = 0
    return t


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, elementwise."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_TABLES: dict[bool, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """R^i and R^-i modulo 2^64 for i < n (kept for the worker's life up to
    one step's length)."""
    if len(_POWERS[0]) >= n:
        return _POWERS[0][:n], _POWERS[1][:n]
    out = []
    for r in (_R, _R_INV):
        p = np.full(n, r, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    if n <= 2 * STEP_BYTES:
        _POWERS[:] = out
    return out[0], out[1]


def _step_words(data: np.ndarray, bounds: np.ndarray, lower: bool):
    table = _TABLES.get(lower)
    if table is None:
        table = _TABLES.setdefault(lower, _byte_table(lower))
    values = table[data]
    black = values != 0
    first = black.copy()
    first[1:] &= ~black[:-1]
    edge = bounds[:-1][bounds[:-1] < len(data)]
    first[edge] = black[edge]
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    up, down = powers(len(data))
    sums = np.add.reduceat(values * up, starts) * down[starts]
    return starts, mix(sums)


def word_hashes(data: np.ndarray, bounds: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (uint64) of all words in the documents ``data[bounds[i]:bounds[i+1]]``
    (UTF-8 bytes) and each document's number of words.

    A word's hash is a polynomial over random byte values modulo 2^64, then
    mixed; equal words have equal hashes in every task. Works in steps of
    whole documents so that temporaries stay small."""
    hashes, counts = [], np.zeros(len(bounds) - 1, np.int64)
    for lo, hi in doc_steps(bounds, STEP_BYTES):
        part, base = data[bounds[lo]:bounds[hi]], bounds[lo]
        local = bounds[lo:hi + 1] - base
        starts, h = _step_words(part, local, lower)
        hashes.append(h)
        counts[lo:hi] = np.diff(np.searchsorted(starts, local))
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), counts


def doc_steps(bounds: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Runs of whole documents of about ``size`` bytes (one document at least)."""
    lo, n = 0, len(bounds) - 1
    while lo < n:
        hi = int(np.searchsorted(bounds, bounds[lo] + size, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def text_chunks(batches, size: int = CHUNK_BYTES):
    """(batch slice, UTF-8 bytes, bounds) for runs of whole documents of at
    most about ``size`` bytes within each Arrow batch; column ``text``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(batch.schema.get_field_index("text"))
        data, bounds = utf8(text)
        for lo, hi in doc_steps(bounds, size):
            yield (batch.slice(lo, hi - lo), data[bounds[lo]:bounds[hi]],
                   bounds[lo:hi + 1] - bounds[lo])


def utf8(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string array (no NULLs) and the rows' bounds."""
    wide = pa.types.is_large_string(text.type)
    _, offsets, data = text.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[
        text.offset:text.offset + len(text) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def give_back() -> None:
    """Returns memory that the worker has freed to the system; called where a
    task ends that held much of it."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; other C libraries have none
        if trim is not None:
            trim(0)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated aranges: starts[i], starts[i]+1, ... counts[i] of each."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
