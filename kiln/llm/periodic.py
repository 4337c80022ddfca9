"""Periodic runs of words, by tiles scaled to the period.

A *run* is a stretch of words with smallest period ``q`` and at least
``max(LEAST, TIMES * q)`` words that no neighbouring word extends.

1. *Octaves.* Periods ``P <= q < 2P`` (``P`` a power of two) form an octave. Its
   boundaries are the words whose number is a multiple of ``P``. A run holds a
   boundary within its first ``P`` words, so the ``2P`` words after it occur
   again ``q`` words later. Rolling hashes of ``2P`` words compare each boundary
   with the ``P`` places where that can be; boundaries without an equal hash
   begin no run and are passed over.
2. *Tiles.* The others are exploded into rows (document, octave, tile): the word
   numbers of ``CORE`` boundaries with ``P`` words to the left and ``8P`` to the
   right, so neighbouring tiles overlap. Tiles are spread over all tasks, those
   of one document too.
3. *Boundary Z-functions.* For each boundary of a tile, the Z-function of the
   words after it gives how far every period holds to the right and which
   periods are multiples of a smaller one; that of the words before it,
   backwards, how far it holds to the left. This is exact on the words; it uses
   nothing outside the tile.
4. *Stitching.* Fragments are shuffled by (document, period). Two that overlap
   in at least ``q`` words are parts of one run; a run's fragments follow each
   other at most ``P`` apart and overlap by more, so their union is the run.
5. *Collapse.* A word is dropped if a run contains it after its first ``q`` words.

Documents that explode into no tile have no run and never leave their scan task;
the others travel with their text once. A document's runs meet in one task, as
their list is one value of the result: there are fewer than words.

Null text counts as empty (no words, no runs). Very long texts become many
tiles. Equal texts and repeated rows are solved each; an empty table gives an
empty result. Input columns travel in the struct ``doc``, so no name can clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.components import _written
from kiln.llm.words import WORD_BASE, Words, mix, slices, text_buffer, text_of, with_doc

LEAST = 6
TIMES = 4
#: Boundaries and least words of a tile's core.
CORE = 8
CORE_WORDS = 256
#: Words of tiles that a task holds before it sends them on.
HELD = 2_000_000

RUNS = "array<struct<start:bigint,period:bigint,length:bigint>>"


def least_length(q):
    return np.maximum(LEAST, TIMES * q)


def numbered(w: Words) -> np.ndarray:
    """The words as numbers: equal if and only if their bytes are equal."""
    ink = w.data[~w.space]
    edges = np.concatenate(([0], np.cumsum(w.ends - w.starts))).astype(np.int64)
    flat = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(w.starts), [None, pa.py_buffer(edges),
                                                                              pa.py_buffer(np.ascontiguousarray(ink))])
    return flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int32)


def joined(w: Words) -> tuple[bytes, np.ndarray]:
    """The words of each text joined by one space, and their offsets."""
    last = np.zeros(len(w.starts), bool)
    last[w.first[1:][w.n_words > 0] - 1] = True
    gaps = w.ends[~last]
    keep, data = ~w.space, w.data.copy()
    keep[gaps], data[gaps] = True, 0x20
    edges = np.concatenate(([0], np.cumsum(keep)))[w.offs]
    return data[keep].tobytes(), edges


def boundaries(ids: np.ndarray, first: np.ndarray):
    """Yields ``(P, boundaries)`` for every octave: numbers (in the whole array)
    of the boundaries whose next ``2P`` words occur again a period later."""
    size = np.diff(first)
    index = np.flatnonzero(np.repeat(size >= LEAST, size))
    rel = (np.arange(len(ids)) - np.repeat(first[:-1], size))[index]
    left = np.repeat(size, size)[index]                     # words of the text
    h, p, shift = mix(ids[index].astype(np.uint64) + np.uint64(1)), 1, 0
    while len(h):
        power = np.uint64(pow(int(WORD_BASE), p, 1 << 64))
        pair = h * power
        pair[:-p] += h[p:]                                  # hash of 2P words
        at = np.flatnonzero((rel >= p) & (rel + 2 * p <= left))
        r = rel[at]
        b = at - r + (((r >> shift) - 1) << shift)
        hit = np.unique(b[pair[at] == pair[b]])
        if len(hit):
            yield p, index[hit]
        p, shift = 2 * p, shift + 1
        keep = left >= TIMES * p
        h, index, rel, left = pair[keep], index[keep], rel[keep], left[keep]


def z_function(s: list, m: int) -> list[int]:
    """For each ``i < m`` how many elements of ``s[i:]`` equal those of ``s``."""
    n = len(s)
    z, lo, hi = [0] * min(m, n), 0, 0
    for i in range(1, len(z)):
        k = min(hi - i, z[i - lo]) if i < hi else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > hi:
            lo, hi = i, i + k
    return z


def solve(ids: list, p: int, marks: list[int]) -> list[tuple[int, int, int]]:
    """Fragments ``(period, start, stop)`` of one tile's boundaries ``marks``."""
    found = []
    for b in marks:
        right = ids[b:b + 8 * p]
        z = z_function(right, 2 * p)
        good = [q for q in range(p, len(z)) if z[q] >= max(LEAST, TIMES * q) - q - p + 1]
        if not good:
            continue
        # the smallest period of the first 3P words: longer ones are its multiples where it goes on
        root = next((d for d in range(1, p) if z[d] + d >= 3 * p), 0)
        good = [q for q in good if not (root and q % root == 0 and z[root] + root >= 3 * q)]
        if not good:
            continue
        back = ids[max(0, b - p):b][::-1]
        behind = ids[max(0, b - p):b + 2 * p][::-1]         # place of b + q - 1 backwards: len - (b + q - lo)
        zb = z_function([*back, -1, *behind], len(back) + 1 + len(behind))
        for q in good:
            place = len(back) + 1 + len(behind) - (len(back) + q)
            found.append((q, b - min(zb[place], len(back)), b + q + z[q]))
    return merged(found)


def merged(fragments: list) -> list[tuple[int, int, int]]:
    out: list[tuple[int, int, int]] = []
    for q, s, e in sorted(fragments):
        if out and out[-1][0] == q and s <= out[-1][2] - q:
            out[-1] = (q, out[-1][1], max(out[-1][2], e))
        else:
            out.append((q, s, e))
    return out


class Prepared:
    """Word numbers and marked boundaries of a few texts."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.words = Words(data, offs, hashes=False)
        self.ids, self.first = numbered(self.words), self.words.first
        self.octaves = list(boundaries(self.ids, self.first))
        self.tiled = np.zeros(len(offs) - 1, bool)
        for _, at in self.octaves:
            self.tiled[self.words.doc[at]] = True

    def tiles(self):
        """``(text, P, first word, word numbers, marks)`` of every tile."""
        doc, first = self.words.doc, self.first
        for p, at in self.octaves:
            core = max(CORE * p, CORE_WORDS)
            d = doc[at]
            which = (at - first[d]) // core
            heads = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (which[1:] != which[:-1]))))
            for i, j in zip(heads, [*heads[1:], len(at)]):
                t = int(d[i])
                a, z = int(first[t]), int(first[t + 1])
                lo = max(a, a + int(which[i]) * core - p)
                hi = min(z, a + (int(which[i]) + 1) * core + 8 * p)
                yield t, p, lo - a, self.ids[lo:hi], at[i:j] - lo


def _prepared(batch: pa.RecordBatch, text_col: str):
    data, offs = text_buffer(text_of(batch, text_col))
    for i, j in slices(offs):
        yield i, Prepared(data, offs[i:j + 1])


def _strings(w: Words, chosen: np.ndarray) -> pa.Array:
    data, edges = joined(w)
    return pa.array([data[edges[k]:edges[k + 1]].decode() for k in chosen], pa.string())


def find(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Rows ``(doc, n_words, runs, text)``: the input columns (or those in
    ``carry``), the number of words, the runs by start, then period, and the
    words that stay, joined by one space."""
    src = with_doc(docs, text_col, carry)
    kind = dict(src.dtypes)["doc"]

    def plain(batches):
        none = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "period", "length")]))
        for batch in batches:
            for i, part in _prepared(batch, text_col):
                rest = np.flatnonzero(~part.tiled)
                if len(rest):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc").take(pa.array(rest + i)), pa.array(part.words.n_words[rest].astype(np.int64)),
                         pa.array([[]] * len(rest), none), _strings(part.words, rest)],
                        ["doc", "n_words", "runs", "text"])

    def explode(batches):
        # rows of texts (doc, n_words, text) and of tiles (p, at, ids, marks), linked by a number of the text
        row = TaskContext.get().partitionId() << 33
        names = ["row", "doc", "n_words", "text", "p", "at", "ids", "marks"]
        for batch in batches:
            doc = batch.column("doc")
            for i, part in _prepared(batch, text_col):
                chosen = np.flatnonzero(part.tiled)
                if not len(chosen):
                    continue
                number = np.full(len(part.tiled), -1, np.int64)
                number[chosen] = row + np.arange(len(chosen))
                row += len(chosen)
                n = len(chosen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number[chosen]), doc.take(pa.array(chosen + i)),
                     pa.array(part.words.n_words[chosen].astype(np.int64)), _strings(part.words, chosen),
                     pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int32())),
                     pa.nulls(n, pa.list_(pa.int32()))], names)

                def flush(rows, number=number, doc=doc):
                    def lists(k):
                        edges = np.concatenate(([0], np.cumsum([len(r[k]) for r in rows]))).astype(np.int32)
                        return pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate([r[k] for r in rows]), pa.int32()))
                    m = len(rows)
                    return pa.RecordBatch.from_arrays(
                        [pa.array([int(number[r[0]]) for r in rows], pa.int64()), pa.nulls(m, doc.type), pa.nulls(m, pa.int64()),
                         pa.nulls(m, pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                         pa.array([r[2] for r in rows], pa.int64()), lists(3), lists(4)], names)

                rows, held = [], 0
                for tile in part.tiles():
                    rows.append(tile)
                    held += len(tile[3])
                    if held > HELD:
                        yield flush(rows)
                        rows, held = [], 0
                if rows:
                    yield flush(rows)

    table = _written(src.mapInArrow(explode, f"row long, doc {kind}, n_words long, text string, p long, at long, "
                                             "ids array<int>, marks array<int>"), "period-tiles")

    def solved(batches):
        for batch in batches:
            out = []
            for row, p, at, ids, marks in zip(*(batch.column(k) for k in ("row", "p", "at", "ids", "marks"))):
                row, at = row.as_py(), at.as_py()
                out += [(row, q, at + s, at + e) for q, s, e in solve(ids.values.to_pylist(), p.as_py(), marks.values.to_pylist())]
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["row", "q", "s", "e"])

    tiles = table.filter("p is not null").select("row", "p", "at", "ids", "marks")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fragments = tiles.repartition(n, "row", "p", "at").mapInArrow(solved, "row long, q long, s long, e long")
    # the reach of earlier fragments tells where another run of the same period begins
    order = Window.partitionBy("row", "q").orderBy("s", "e")
    reach = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = fragments.withColumn("new", (F.coalesce(reach, F.lit(-1)) - F.col("q") < F.col("s")).cast("int"))
    runs = (begins.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("row", "q", "run").agg(F.min("s").alias("s"), F.max("e").alias("e"))
            .filter(F.expr(f"e - s >= greatest({LEAST}, {TIMES} * q)")))
    listed = runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        F.col("s").alias("start"), F.col("q").alias("period"), (F.col("e") - F.col("s")).alias("length")))).alias("runs"))
    texts = table.filter("p is null").select("row", "doc", "n_words", "text").join(listed, "row", "left")

    def collapse(batches):
        for batch in batches:
            kept = []
            for text, n, runs in zip(batch.column("text"), batch.column("n_words"), batch.column("runs")):
                kept.append(collapsed(text.as_py(), n.as_py(), runs.as_py()) if runs.is_valid and len(runs) else text.as_py())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("n_words"), batch.column("runs"),
                                              pa.array(kept, pa.string())], ["doc", "n_words", "runs", "text"])

    rest = texts.select("doc", "n_words", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"), "text").mapInArrow(
        collapse, f"doc {kind}, n_words long, runs {RUNS}, text string")
    return src.mapInArrow(plain, f"doc {kind}, n_words long, runs {RUNS}, text string").unionByName(rest)


def collapsed(text: str, n: int, runs: list[dict]) -> str:
    """The words of ``text`` that no run contains after its first period."""
    cover = np.zeros(n + 1, np.int64)
    for r in runs:
        cover[r["start"] + r["period"]] += 1
        cover[r["start"] + r["length"]] -= 1
    drop = np.cumsum(cover[:n]) > 0
    return " ".join(w for w, d in zip(text.split(" "), drop.tolist()) if not d)
