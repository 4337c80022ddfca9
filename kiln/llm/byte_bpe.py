"""Byte-level BPE: overlapping-chunk encoding and raw-byte decoding.

Encoding works on chunks so that one long text does not hold up one task:

1. *Cut.* A text is cut into chunks of ``chunk_chars`` characters that each
   run ``overlap`` characters into the next one.
2. *Pre-tokenise.* Every chunk, on whatever task it lands, finds the
   pre-token boundaries inside it. A boundary used here is a space before a
   visible character: the pattern never matches across it, whatever stands
   before, so it is a boundary of the whole text too.
3. *Stitch.* Neighbouring chunks are joined at the first boundary both have
   found in their overlap. Where the overlap holds none (one long unbroken
   run), the two chunks are merged and the search goes on to the next one,
   so the result never depends on the cut.
4. *Encode.* The pieces between boundaries are encoded by the ranks, each
   match of the pattern separately. Equal pieces are encoded once per worker.

Texts that fit into one chunk are encoded where they are read. Null counts as
empty and gives no ids; repeated rows give one result each; an empty table
gives an empty result. Special-token strings in a text are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
import re
import struct
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_CHARS = 16384
OVERLAP = 1024
#: Pieces in each of the two generations that a worker remembers (a cache, not
#: a limit).
CACHE_PIECES = 200_000
#: Rows that a worker turns into one output frame.
FRAME_ROWS = 500
#: Pre-tokens of more bytes than this are merged with a heap.
LONG_PIECE = 400

#: A space before a visible character: always a pre-token boundary.
BOUNDARY = re.compile(r" (?=\S)")
UNSAFE = re.compile(r" (?:\s|$)")
#: The first unit of a text has no space before it.
FIRST = "\x00first:"


def _default(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def encoder(ranks_path: str | None = None) -> "Encoder":
    return Encoder(ranks_path or _default("byte_bpe_50k.tiktoken"))


class Encoder:
    """Ranks of one vocabulary with a cache of encoded pieces.

    The ids of a piece are kept as little-endian 32-bit bytes, so the ids of a
    text are one concatenation.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranks = ranks
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.core = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})
        self.cache = _Cache(self)

    def piece_ids(self, piece: str) -> bytes:
        """Ids of a piece (any text), each match of the pattern separately."""
        if len(piece) <= LONG_PIECE:
            ids = self.core.encode_ordinary(piece)
            return struct.pack(f"<{len(ids)}I", *ids)
        out: list[int] = []
        for token in self.pattern.findall(piece):
            if len(token) <= LONG_PIECE:
                out += self.core.encode_ordinary(token)
            else:
                out += self.merge(token.encode())
        return struct.pack(f"<{len(out)}I", *out)

    def merge(self, raw: bytes) -> list[int]:
        """Lowest-rank-first merging of one long pre-token, in n log n."""
        ranks, n = self.ranks, len(raw)
        end = list(range(1, n + 1)) + [n]      # end[i]: end of the part that starts at i
        prev = list(range(-1, n))
        alive = [True] * n + [False]
        heap = []

        def offer(i):
            j = end[i]
            if j < n:
                r = ranks.get(raw[i:end[j]])
                if r is not None:
                    heapq.heappush(heap, (r, i, end[j]))

        for i in range(n):
            offer(i)
        while heap:
            r, i, stop = heapq.heappop(heap)
            j = end[i]
            if not alive[i] or j >= n or end[j] != stop:
                continue
            alive[j] = False
            end[i] = stop
            if stop < n:
                prev[stop] = i
            offer(i)
            if prev[i] >= 0:
                offer(prev[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[raw[i:end[i]]])
            i = end[i]
        return out

    def units(self, text: str) -> list[str]:
        """The text cut at its boundaries, boundary spaces left out."""
        return BOUNDARY.split(text) if UNSAFE.search(text) else text.split(" ")

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian 32-bit bytes."""
        if not text:
            return b""
        units = self.units(text)
        return self.cache.first(units[0]) + b"".join(map(self.cache.__getitem__, units[1:]))


class _Cache(dict):
    """Unit without its boundary space -> ids of space + unit. When full, it
    becomes the old generation; units seen again come back from there."""

    def __init__(self, owner: Encoder):
        super().__init__()
        self.owner = owner
        self.old: dict[str, bytes] = {}

    def __missing__(self, unit: str) -> bytes:
        ids = self.old.get(unit)
        if ids is None:
            ids = self.owner.piece_ids(" " + unit)
            if len(unit) > 64:
                return ids
        if len(self) >= CACHE_PIECES:
            self.old = dict(self)
            self.clear()
        self[unit] = ids
        return ids

    def first(self, unit: str) -> bytes:
        return self.owner.piece_ids(unit) if unit else b""


@lru_cache(maxsize=4)
def token_bytes(ranks_path: str | None = None) -> list[bytes]:
    """Raw bytes of every id."""
    with open(ranks_path or _default("byte_bpe_50k.tiktoken"), "rb") as f:
        pairs = [(int(b), base64.b64decode(a)) for a, b in map(bytes.split, f)]
    out = [b""] * (max(i for i, _ in pairs) + 1)
    for i, raw in pairs:
        out[i] = raw
    return out


def _frames(pdf: pd.DataFrame):
    for i in range(0, len(pdf), FRAME_ROWS):
        yield pdf.iloc[i:i + FRAME_ROWS]


def _bounds(text: str, at: int) -> np.ndarray:
    """Boundaries of a chunk that starts at ``at``, as offsets in the text."""
    return np.array([m.start() + at for m in BOUNDARY.finditer(text)], np.int64)


def stitched(chunks):
    """Pieces of one text from its chunks ``(start, text, bounds)`` in order.

    Yields each piece with its boundary space, but for the very first.
    """
    cur, base, marks = "", 0, np.zeros(0, np.int64)
    for start, text, bounds in chunks:
        end = base + len(cur)
        if cur:
            shared = np.intersect1d(marks[marks >= start], bounds[bounds < end])
            if len(shared):
                cut = int(shared[0])
                yield from _cut(cur, base, marks[marks < cut], cut)
                cur, base = text[cut - start:], cut
                marks = bounds[bounds > cut]
            else:
                cur += text[max(0, end - start):]
                marks = np.union1d(marks, bounds)
        else:
            cur, base, marks = text, start, bounds
            marks = marks[marks > base]
    yield from _cut(cur, base, marks, base + len(cur))


def _cut(text: str, base: int, marks: np.ndarray, stop: int):
    edges = [0, *(marks - base).tolist(), stop - base]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield text[a:b]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None,
           chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: the id column, ``n_tokens`` and ``ids`` (binary,
    little-endian unsigned 32-bit)."""
    if not 0 < overlap < chunk_chars:
        raise ValueError("the overlap must be positive and shorter than a chunk")
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = dict(src.dtypes)["id"]
    schema = f"id {kind}, n_tokens long, ids binary"
    fits = F.length("text") <= chunk_chars

    def here(batches):
        enc = encoder(ranks_path)
        for pdf in (part for batch in batches for part in _frames(batch)):
            ids = [enc.encode(t) for t in pdf["text"]]
            yield pd.DataFrame({"id": pdf["id"], "n_tokens": [len(x) // 4 for x in ids], "ids": ids})

    def cut(batches):
        for pdf in batches:
            for row, i, text in zip(pdf["row"], pdf["id"], pdf["text"]):
                starts = list(range(0, len(text), chunk_chars))
                for k in range(0, len(starts), 64):
                    part = starts[k:k + 64]
                    yield pd.DataFrame({"row": row, "id": i, "start": part,
                                        "chunk": [text[s:s + chunk_chars + overlap] for s in part]})

    def pretokenise(batches):
        for pdf in batches:
            pdf["bounds"] = [(_bounds(c, 0).astype("<u4")).tobytes() for c in pdf["chunk"]]
            yield pdf

    def stitch(batches):
        enc = encoder(ranks_path)

        def rows():
            for pdf in batches:
                for r in zip(pdf["row"], pdf["id"], pdf["start"], pdf["chunk"], pdf["bounds"]):
                    yield r

        from itertools import groupby
        for _, group in groupby(rows(), key=lambda r: r[0]):
            ident = []

            def chunks(group=group, ident=ident):
                for _, i, start, chunk, bounds in group:
                    ident[:] = [i]
                    yield int(start), chunk, np.frombuffer(bounds, "<u4").astype(np.int64) + int(start)

            out = []
            for k, piece in enumerate(stitched(chunks())):
                out.append(enc.cache[piece[1:]] if k else enc.cache.first(piece))
            ids = b"".join(out)
            yield pd.DataFrame({"id": [ident[0]], "n_tokens": [len(ids) // 4], "ids": [ids]})

    short = src.filter(fits).mapInPandas(here, schema)
    chunks = (src.filter(~fits).withColumn("row", F.monotonically_increasing_id())
              .mapInPandas(cut, f"row long, id {kind}, start long, chunk string"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = chunks.repartition(n, "row", "start").mapInPandas(
        pretokenise, f"row long, id {kind}, start long, chunk string, bounds binary")
    long = marked.repartition(n, "row").sortWithinPartitions("row", "start").mapInPandas(stitch, schema)
    return short.unionByName(long).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ids_col: str = "ids", ranks_path: str | None = None) -> DataFrame:
    """The rows of ``encoded`` with ``decoded``: the raw bytes of the ids, one
    after another. They need not be valid UTF-8."""
    kinds = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes)

    def run(batches):
        raw = token_bytes(ranks_path).__getitem__
        for pdf in (part for batch in batches for part in _frames(batch)):
            yield pdf.assign(decoded=[b"".join(map(raw, np.frombuffer(x or b"", "<u4").tolist())) for x in pdf[ids_col]])

    return encoded.mapInPandas(run, f"{kinds}, decoded binary")
