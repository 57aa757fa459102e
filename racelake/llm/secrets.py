"""Secrets in texts: fixed patterns, and a token-efficiency test.

A vocabulary learnt from ordinary text covers ordinary strings with few
tokens; random strings fall apart into tokens of one or two characters.
Strings of SHORTEST or more key characters that mix letters with digits, or
change case often, are therefore encoded with a tiktoken vocabulary, and
those of fewer than LIMIT characters a token are reported as ``random``,
after known digests (MD5, SHA) and identifiers (UUIDs) are set aside.
"""

from __future__ import annotations

import base64
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelake.llm.common import id_and_text

KINDS = ("assign", "access", "hex", "random")
# Fixed patterns; the checks on what they match are in _base.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")  # maximal runs, the shorter of which fail anyway
MIN_VALUE, MIN_ACCESS = 6, 20
_KEYS = ("passw", "secret", "token", "api")  # one of them is in every assignment

SHORTEST = 16   # characters of a string that is tested
LIMIT = 2.0     # characters a token; random strings lie below
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
# Set aside: digests by their length in hexadecimal digits, subresource
# digests, UUIDs.
KNOWN = re.compile(
    r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}"
    r"|sha(?:256|384|512)-[A-Za-z0-9+/]+={0,2}"
    r"|[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12})")
_CASE = re.compile("[a-z][A-Z]")
# Candidates hold no white space: letters, digits and the rest are cut apart
# as the vocabulary's own pattern does.
PIECES = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+"
STEP = 1 << 16  # longer candidates are encoded in pieces of that many characters


class Scanner:
    """Finds spans with one vocabulary (tiktoken's rank file)."""

    def __init__(self, path: str, shortest: int = SHORTEST, limit: float = LIMIT):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("secrets", pat_str=PIECES, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary
        self.shortest, self.limit = shortest, limit

    def efficiency(self, text: str) -> float:
        """Characters a token."""
        return len(text) / sum(len(self.encode(text[i:i + STEP])) for i in range(0, len(text), STEP))

    def _random(self, text: str, taken: list[tuple[int, int, int]]):
        for m in CANDIDATE.finditer(text):
            s = m.group()
            if len(s) < self.shortest:
                continue
            digits = sum(c.isdigit() for c in s)
            letters = sum(c.isalpha() for c in s)
            if letters < 2 or (digits < 2 and len(_CASE.findall(s)) < 3) or KNOWN.fullmatch(s):
                continue
            if any(a < m.end() and m.start() < b for a, _, b in taken):
                continue
            if self.efficiency(s) < self.limit:
                yield m.start(), 3, m.end()

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind's number, end) in order; code points, end exclusive.
        A random string that touches a span of a fixed pattern is part of
        it and not reported again."""
        found = list(_base(text))
        found += list(self._random(text, found))
        return sorted(found)


def _base(text: str):
    low = text.lower()
    if any(k in low for k in _KEYS):
        for m in ASSIGN.finditer(text):
            if len(m.group(2)) >= MIN_VALUE:
                yield m.start(), 0, m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= MIN_ACCESS:
                yield m.start(), 1, m.end()
    for m in HEX.finditer(text):
        yield m.start(), 2, m.end()


_SCANNERS: dict[tuple, Scanner] = {}


def _scanner(*key) -> Scanner:
    """The worker's scanner (vocabulary read once per worker)."""
    if key not in _SCANNERS:
        _SCANNERS[key] = Scanner(*key)
    return _SCANNERS[key]


SPANS = "array<struct<kind:string,start:int,end:int>>"


def scan(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
         shortest: int = SHORTEST, limit: float = LIMIT) -> DataFrame:
    """One row per document: ``doc_id``, ``text``, ``spans`` (array of
    ``kind``, ``start``, ``end`` by start, then kind as in KINDS).

    NULL texts become '' and have no spans, as have empty and blank ones;
    texts of any length are read whole, one at a time; repeated rows give
    equal rows; an empty table gives none; other columns are not read.
    No shuffle: a task that is run again gives the same rows. ``path`` is a
    tiktoken rank file, present on every executor."""
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches):
        scanner = _scanner(path, shortest, limit)
        for b in batches:
            found = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scanner.spans(t.as_py())]
                     for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(item))],
                                             ["doc_id", "text", "spans"])
    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"doc_id bigint, text string, spans {SPANS}")


def listed(spans: Column, kinds=KINDS) -> Column:
    """Spans of those kinds as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(F.filter(spans, lambda x: x["kind"].isin(*kinds)), lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Per document of ``scan``: numbers of spans by kind, the digest of the
    fixed patterns' spans, and all spans as text."""
    def n(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *map(n, KINDS), F.sha2(listed(F.col("spans"), KINDS[:3]), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def redact(found: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` with every span of ``scan`` replaced by its kind
    in brackets (of overlapping spans, what is not yet replaced)."""
    def step(done, s):
        a = F.greatest(done["at"], s["start"])
        cut = F.concat(done["out"], F.substring(F.col("text"), done["at"] + 1, F.greatest(a - done["at"], F.lit(0))),
                       F.when(s["end"] > done["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise(""))
        return F.struct(cut.alias("out"), F.greatest(done["at"], s["end"]).alias("at"))
    parts = F.aggregate("spans", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step)
    return found.withColumn("p", parts).select("doc_id", F.concat(
        F.col("p.out"), F.substring(F.col("text"), F.col("p.at") + 1, F.length("text"))).alias("text"))
