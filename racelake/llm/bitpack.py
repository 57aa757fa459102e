"""Token ids in fixed-width bit-packed blocks.

File format (a Parquet folder of blocks, ordered by ``first``): each row is
one block of up to BLOCK_IDS consecutive ids of the whole id stream, ``bits``
wide each (the least width that holds the vocabulary), little-endian bit
order, padded to a whole byte at the block's end only. ``first`` is the
position of the block's first id in the stream, so any id range is found by
the block offsets alone and unpacked with numpy; ``starts`` are the positions
at which the documents in the block begin (of the first, perhaps before it).
A second folder, ``index``,
holds each document's start and length in the stream.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.llm.bpe import pretokens, text_groups
from racelake.llm.common import id_and_text, stored

BLOCK_IDS = 1 << 16
END_ID = 0
CACHE_WORDS = 500_000
ENCODED_SCHEMA = "doc_id bigint, n_tokens bigint, ids binary"
BLOCK_SCHEMA = "part int, first bigint, n_ids int, bits int, starts array<bigint>, payload binary"


def width(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids (below 2^bits) as consecutive ``bits``-wide little-endian fields."""
    ids = np.ascontiguousarray(ids, "<u4")
    if not len(ids):
        return b""
    if bits == 16:  # whole fields: the same bytes, without the bit matrix
        return ids.astype("<u2").tobytes()
    wide = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(wide.reshape(-1), bitorder="little").tobytes()


def unpack(payload, n: int, bits: int, first: int = 0) -> np.ndarray:
    """Ids ``first`` to ``first + n`` of a packed block (uint32)."""
    if bits == 16:
        return np.frombuffer(payload, "<u2", n, 2 * first).astype(np.uint32)
    at = (first + np.arange(n, dtype=np.int64)) * bits
    raw = np.frombuffer(bytes(payload) + b"\0" * 8, np.uint8)
    words = raw[(at >> 3)[:, None] + np.arange(8)].view("<u8")[:, 0]
    return ((words >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


class _Known(dict):
    """Ids (little-endian 32-bit) of pre-tokens, asked of the tokenizers
    library's model when first seen."""

    def __init__(self, library):
        from racelake.llm.bpe import byte_symbols

        super().__init__()
        self.model = library.model
        self.letters = {b: c for c, b in byte_symbols().items()}

    def __missing__(self, word: str) -> bytes:
        spelt = word.encode().decode("latin-1").translate(self.letters)
        self[word] = ids = array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()
        return ids


class LibraryEncoder:
    """Whole texts to ids through the tokenizers library: its model encodes
    each distinct pre-token once (a pre-token's ids do not depend on its
    neighbours), texts then look their pre-tokens up. At most CACHE_WORDS
    are kept."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.special = {text: array("I", [i]).tobytes() for text, i in added.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        self.known = _Known(self.library)

    def encode(self, text: str) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        get = self.known.__getitem__
        if not any(s in text for s in self.special):
            return np.frombuffer(b"".join(map(get, pretokens(text))), "<u4")
        parts = [self.special[p] if p in self.special else b"".join(map(get, pretokens(p)))
                 for p in self.cut.split(text)]
        return np.frombuffer(b"".join(parts), "<u4")


_ENCODERS: dict[str, LibraryEncoder] = {}


def _encoder(path: str) -> LibraryEncoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = LibraryEncoder(path)
    return _ENCODERS[path]


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (packed) per document, END_ID appended."""
    bits = width(vocabulary_size(path))

    def run(batches):
        enc = _encoder(path)
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in text_groups(texts):
                ids = [np.append(enc.encode(t), np.uint32(END_ID)) for t in texts[lo:hi]]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([pack(x, bits) for x in ids], pa.binary())],
                    ["doc_id", "n_tokens", "ids"])
    return id_and_text(docs, id_col, text_col).mapInArrow(run, ENCODED_SCHEMA)


def write(docs: DataFrame, path: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
          ids_per_part: int = 16 << 20) -> None:
    """Encodes ``docs`` and writes ``folder/blocks`` and ``folder/index`` in
    ascending doc_id order (NULL ids first; equal ids by their packed ids).

    Texts are encoded once and stay where they are; packed ids are shuffled
    once, by ranges of (doc_id, hash of the ids). The ranges' bounds are
    quantiles of doc_id; an id that spans several ranges is dealt over them by
    its hash. The driver sees the bounds and one id count per range."""
    bits = width(vocabulary_size(path))
    encoded = stored(encode(docs, path, id_col, text_col).select(
        "*", F.xxhash64("ids").alias("h"), F.coalesce("doc_id", F.lit(-1 << 63)).alias("k")), "packed", "zstd")
    total = encoded.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(1, -(-total // ids_per_part))
    cuts = encoded.agg(F.percentile_approx("k", [i / parts for i in range(1, parts)], 10_000)).first()[0] if parts > 1 else []
    bounds = np.array(cuts or [], np.int64)

    def place(batches):
        for b in batches:
            k, h = b.column("k").to_numpy(), b.column("h").to_numpy()
            lo, hi = np.searchsorted(bounds, k, "left"), np.searchsorted(bounds, k, "right")
            part = lo + ((h / 2.0 ** 64 + 0.5) * (hi - lo + 1)).astype(np.int64).clip(0, hi - lo)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *b.columns], ["part", *b.schema.names])

    def ranged(columns):
        schema = "part int, " + ", ".join(f"{c} {dict(encoded.dtypes)[c]}" for c in columns)
        return encoded.select(*columns).mapInArrow(place, schema)

    small = ["doc_id", "n_tokens", "h", "k"]
    base, at = {}, 0
    for part, n in sorted(ranged(small).groupBy("part").agg(F.sum("n_tokens")).collect()):  # a row per range
        base[part], at = at, at + n
    placed = lambda columns: ranged(columns).repartition(parts, "part").sortWithinPartitions(
        "part", F.col("doc_id").asc_nulls_first(), "h")

    def index(batches):
        at, now = 0, None
        for b in batches:
            part = b.column("part").to_numpy()
            n = b.column("n_tokens").to_numpy()
            start = np.empty(len(n), np.int64)
            for p, lo, hi in _runs(part):
                if p != now:
                    now, at = p, base[p]
                ends = at + np.cumsum(n[lo:hi])
                start[lo:hi] = ends - n[lo:hi]
                at = int(ends[-1])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(start), b.column("n_tokens")],
                                             ["doc_id", "start", "n_tokens"])

    def blocks(batches):
        now, first, held, size, starts, at = None, 0, [], 0, [], 0

        def cut(last):
            nonlocal first, held, size, starts
            ids = np.concatenate(held) if held else np.empty(0, np.uint32)
            full = len(ids) if last else len(ids) - len(ids) % BLOCK_IDS
            rows, begin = [], np.array(starts, np.int64)
            for i in range(0, full, BLOCK_IDS):
                x = ids[i:min(i + BLOCK_IDS, full)]
                lo = np.searchsorted(begin, first, "right") - 1
                hi = np.searchsorted(begin, first + len(x), "left")
                rows.append((int(now), first, len(x), bits, begin[lo:hi], pack(x, bits)))
                first += len(x)
            held, size = ([ids[full:]] if full < len(ids) else []), len(ids) - full
            starts = starts[max(0, int(np.searchsorted(begin, first, "right")) - 1):]
            return rows

        for b in batches:
            part = b.column("part").to_numpy()
            n, ids = b.column("n_tokens").to_numpy(), b.column("ids")
            for i in range(b.num_rows):
                if part[i] != now:
                    if now is not None and held:
                        yield _blocks(cut(True))
                    now = part[i]
                    first = at = base[int(now)]
                    starts = []
                held.append(unpack(ids[i].as_buffer(), int(n[i]), bits))
                starts.append(at)
                at += int(n[i])
                size += int(n[i])
                if size >= 16 * BLOCK_IDS:
                    yield _blocks(cut(False))
        if held:
            yield _blocks(cut(True))

    placed([*small, "ids"]).select("part", "n_tokens", "ids").mapInArrow(blocks, BLOCK_SCHEMA) \
        .write.option("compression", "zstd").parquet(f"{folder}/blocks")
    placed(small).select("part", "doc_id", "n_tokens").mapInArrow(
        index, "doc_id bigint, start bigint, n_tokens bigint").write.parquet(f"{folder}/index")


def _runs(x: np.ndarray):
    if not len(x):
        return
    edges = np.flatnonzero(np.diff(x)) + 1
    for lo, hi in zip([0, *edges], [*edges, len(x)]):
        yield int(x[lo]), int(lo), int(hi)


def _blocks(rows) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int32(), pa.int32(),
                                               pa.list_(pa.int64()), pa.binary()))],
        ["part", "first", "n_ids", "bits", "starts", "payload"])


def read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("doc_id bigint, start bigint, n_tokens bigint").parquet(f"{folder}/index")


def read_ids(spark: SparkSession, folder: str, lo: int, hi: int) -> np.ndarray:
    """Ids ``lo`` to ``hi`` of the stream (random access: the offsets prune
    the blocks, only the fields asked for are unpacked)."""
    rows = read_blocks(spark, folder).filter(
        (F.col("first") < hi) & (F.col("first") + F.col("n_ids") > lo)).orderBy("first").collect()
    out = [unpack(r["payload"], min(hi - r["first"], r["n_ids"]) - max(lo - r["first"], 0), r["bits"],
                  max(lo - r["first"], 0)) for r in rows]
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """Reads the files back: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``
    (of the ids as little-endian unsigned 32-bit integers).

    Blocks are unpacked where they are read, and only one crc32 per piece of
    a document (its part of a block) moves; pieces are combined in order and
    meet the index by the document's start."""
    def run(batches):
        for t in batches:
            rows = []
            for first, n, bits, starts, payload in zip(*(t.column(c) for c in ("first", "n_ids", "bits", "starts", "payload"))):
                lo = first.as_py()
                ids = unpack(payload.as_buffer(), n.as_py(), bits.as_py()).astype("<u4")
                begin = starts.values.to_numpy()
                edges = np.append(np.maximum(begin, lo), lo + len(ids)) - lo
                rows += [(int(b), int(x) + lo, int(y - x), zlib.crc32(ids[x:y].data))
                         for b, x, y in zip(begin, edges, edges[1:])]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)], ["start", "at", "n", "crc"])

    pieces = read_blocks(spark, folder).mapInArrow(run, "start bigint, at bigint, n bigint, crc bigint")
    whole = pieces.groupBy("start").agg(F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("p"))
    whole = read_index(spark, folder).join(whole, "start").select("doc_id", "start", "n_tokens", "p")

    def joined(batches):
        for t in batches:
            crc = [_combine([(p["n"], p["crc"]) for p in ps]) for ps in t.column("p").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [t.column("doc_id"), t.column("start"), t.column("n_tokens"), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])
    return whole.mapInArrow(joined, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _combine(pieces: list[tuple[int, int]]) -> int:
    """crc32 of a concatenation from the (number of ids, crc32) of its pieces:
    appending m zero bytes is a linear map of the register, applied by
    repeated squaring."""
    crc = pieces[0][1]
    for n, c in pieces[1:]:
        crc = _shift(crc, 4 * n) ^ c
    return crc


def _times(matrix: list[int], x: int) -> int:
    out, i = 0, 0
    while x:
        if x & 1:
            out ^= matrix[i]
        x >>= 1
        i += 1
    return out


def _shift(crc: int, n_bytes: int) -> int:
    # One zero bit, as a matrix over the reflected polynomial of crc32.
    step = [0xEDB88320] + [1 << i for i in range(31)]
    n = 8 * n_bytes
    while n:
        if n & 1:
            crc = _times(step, crc)
        step = [_times(step, m) for m in step]
        n >>= 1
    return crc
