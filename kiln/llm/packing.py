"""Bounded-space online packing of token sequences into fixed windows.

Every partition keeps at most ``open_windows`` windows open. A document's ids
(followed by one end id) are first cut into full windows; the rest goes into
the open window where it leaves the least space (best fit). When none has
room and no more may be opened, the fullest one is emitted: if its gap is at
least ``min_cut`` ids the document is cut to fill it, else the gap stays as
padding. The windows still open at a partition's end are the leftovers;
leftovers of ``merge_partitions`` neighbouring partitions are packed again by
the same rule, and what is left of that is run together and cut into windows,
the last one into lengths that are powers of two, which need no padding.

Ids are those of the ``tokenizers`` library in its default setting without
special tokens added: a string that ``byte_bpe_50k.json`` lists as an added
token is one id wherever it stands in a text, and the text around it is encoded
part by part. An own ranks file comes without added tokens.

State per task is ``open_windows`` windows, whatever the input. Null text
counts as empty (one end id); repeated rows are packed each; an empty table
gives an empty result. ``doc_id`` may be null.
"""

from __future__ import annotations

import bisect
import json
import re
from functools import lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.byte_bpe import _default, encoder
from kiln.session import scratch_path

WINDOW = 1024
END_ID = 0
OPEN_WINDOWS = 32
MIN_CUT = 16
MERGE_PARTITIONS = 4
#: Sequence ids are (task, counter); a task makes fewer sequences than this.
TASK_STEP = 1 << 36
MERGED = 1 << 60
#: Pieces are handed to Spark in frames of this many rows.
ROWS_OUT = 2000

PIECE = "start long, length long, doc_tokens long, sequence_id long, offset long, open boolean, ids binary"


@lru_cache(maxsize=1)
def added_tokens() -> dict[str, bytes]:
    """Added tokens of the vocabulary with their ids (little-endian)."""
    with open(_default("byte_bpe_50k.json"), encoding="utf-8") as f:
        listed = json.load(f)["added_tokens"]
    odd = [t["content"] for t in listed if t["single_word"] or t["lstrip"] or t["rstrip"]]
    if odd:
        raise ValueError(f"added tokens that match by their surroundings: {odd}")
    return {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in listed}


def text_encoder(ranks_path: str | None = None):
    """A function from a text to its ids, added tokens included."""
    enc = encoder(ranks_path)
    special = {} if ranks_path else added_tokens()
    if not special:
        return enc.encode
    # the longest of those that start at one place
    cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(special, key=len, reverse=True)) + ")")

    def encode(text):
        parts = cut.split(text) if text else [text]
        if len(parts) == 1:
            return enc.encode(text)
        return b"".join(special[p] if k % 2 else enc.encode(p) for k, p in enumerate(parts))

    return encode


class Packer:
    """Packs pieces ``(doc, start, doc_tokens, ids)``; full or emitted windows
    go to ``done`` as lists of pieces."""

    def __init__(self, window=WINDOW, open_windows=OPEN_WINDOWS, min_cut=MIN_CUT):
        self.window, self.most, self.min_cut = window, open_windows, min_cut
        self.gaps: list[tuple[int, int]] = []       # (free ids, key of the open window), sorted
        self.held: dict[int, list] = {}
        self.next = 0
        self.done: list[list] = []

    def _put(self, key, piece, gap):
        self.held[key].append(piece)
        left = gap - len(piece[3]) // 4
        if left:
            bisect.insort(self.gaps, (left, key))
        else:
            self.done.append(self.held.pop(key))

    def add(self, doc, start, doc_tokens, ids: bytes):
        """One document's ids from ``start`` on."""
        while ids:
            n = len(ids) // 4
            if n >= self.window:
                cut = self.window * 4
                self.done.append([(doc, start, doc_tokens, ids[:cut])])
                ids, start = ids[cut:], start + self.window
                continue
            at = bisect.bisect_left(self.gaps, (n, -1))
            if at < len(self.gaps):
                gap, key = self.gaps.pop(at)
            elif len(self.held) < self.most:
                self.next += 1
                gap, key = self.window, self.next
                self.held[key] = []
            else:
                gap, key = self.gaps.pop(0)
                if gap < self.min_cut:
                    self.done.append(self.held.pop(key))
                    continue
                self._put(key, (doc, start, doc_tokens, ids[:gap * 4]), gap)
                ids, start = ids[gap * 4:], start + gap
                continue
            self._put(key, (doc, start, doc_tokens, ids), gap)
            return

    def leftovers(self) -> list[list]:
        """The open windows, fullest first."""
        return [self.held[k] for _, k in self.gaps]


def run_together(windows: list[list], window: int = WINDOW) -> list[list]:
    """Cut the pieces of some windows into full windows and, at the end,
    windows whose lengths are powers of two: no padding at all."""
    pieces = [p for w in windows for p in w]
    total = sum(len(p[3]) // 4 for p in pieces)
    sizes = [window] * (total // window)
    rest = total % window
    sizes += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    out, it = [], iter(pieces)
    piece = next(it, None)
    for size in sizes:
        now = []
        while size:
            doc, start, total_doc, ids = piece
            take = min(size, len(ids) // 4)
            now.append((doc, start, total_doc, ids[:take * 4]))
            size -= take
            piece = (doc, start + take, total_doc, ids[take * 4:]) if take * 4 < len(ids) else next(it, None)
        out.append(now)
    return out


def _frames(windows, first_id, is_open, id_col):
    """Rows of windows, in frames of a bounded number of rows."""
    rows, seq = [], first_id
    for w in windows:
        offset = 0
        for doc, start, doc_tokens, ids in w:
            n = len(ids) // 4
            rows.append((doc, start, n, doc_tokens, seq, offset, is_open, ids))
            offset += n
        seq += 1
        if len(rows) >= ROWS_OUT:
            yield seq, _frame(rows, id_col)
            rows = []
    if rows:
        yield seq, _frame(rows, id_col)


def _frame(rows, id_col):
    return pd.DataFrame(rows, columns=[id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "open", "ids"])


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         open_windows: int = OPEN_WINDOWS, min_cut: int = MIN_CUT, merge_partitions: int = MERGE_PARTITIONS,
         ranks_path: str | None = None) -> DataFrame:
    """One row per piece: the id column, ``start``, ``length``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and ``ids`` (binary,
    little-endian unsigned 32-bit).

    The packed pieces are written once to the shared folder, so that a lost
    executor cannot lead to two different packings of one partition.
    """
    if window < 1 or open_windows < 1:
        raise ValueError("window and open_windows must be positive")
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(src.dtypes)["id"]
    schema = f"id {kind}, {PIECE}"
    end = np.array([END_ID], "<u4").tobytes()

    def online(batches):
        encode = text_encoder(ranks_path)
        packer = Packer(window, open_windows, min_cut)
        seq = TaskContext.get().partitionId() * TASK_STEP
        for pdf in batches:
            for i, text in zip(pdf["id"], pdf["text"]):
                ids = encode(text) + end
                packer.add(i, 0, len(ids) // 4, ids)
                if len(packer.done) >= 512:
                    for seq, frame in _frames(packer.done, seq, False, "id"):
                        yield frame
                    packer.done = []
        for seq, frame in _frames(packer.done, seq, False, "id"):
            yield frame
        for seq, frame in _frames(packer.leftovers(), seq, True, "id"):
            yield frame

    def merge(batches):
        def rows():
            for pdf in batches:
                yield from zip(pdf["bucket"], pdf["id"], pdf["start"], pdf["doc_tokens"], pdf["ids"])

        for bucket, group in groupby(rows(), key=lambda r: r[0]):
            packer = Packer(window, open_windows, 1)
            for _, i, start, doc_tokens, ids in group:
                packer.add(i, int(start), int(doc_tokens), ids)
            last = packer.done + run_together(packer.leftovers(), window)
            for _, frame in _frames(last, MERGED + int(bucket) * TASK_STEP, False, "id"):
                yield frame

    path = scratch_path(spark, "packed")
    src.mapInPandas(online, schema).write.partitionBy("open").parquet(path)
    packed = spark.read.schema(schema).parquet(path)
    bucket = F.expr(f"sequence_id div {TASK_STEP * merge_partitions}")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = (packed.filter("open").withColumn("bucket", bucket).repartition(n, "bucket")
              .sortWithinPartitions("bucket", "sequence_id", "offset").mapInPandas(merge, schema))
    return packed.filter("not open").unionByName(merged).drop("open").withColumnRenamed("id", id_col)
