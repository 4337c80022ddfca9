"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are made in numpy from the 64-bit hashes of word shingles. Equal
fingerprints form one class, so copies are compared once. Classes are dealt
into tiles by the population count of the fingerprint, each count into as
many tiles as its class count needs. Two tiles meet only if their counts
differ by at most the radius; inside, all pairs are compared by exclusive-or
and bit count in numpy, again skipping rows whose half-word counts are too
far apart. A tile pair returns a spanning forest of its links, not all pairs,
so a dense group costs rows in proportion to its members; components of the
forests are the components of all links.

The search is exact: no link within the radius is missed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.components import _written, components
from kiln.llm.words import slices, text_buffer, text_of, with_doc

SHINGLE = 3
RADIUS = 3
SEED = 42
BITS = 64
#: Classes in a tile, about.
TILE = 16384
#: Rows of one tile compared with the other tile at once.
ROWS = 128


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the shingle hashes."""
    if not words:
        return 0
    line = b" ".join(words)
    k = min(shingle, len(words))
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends[k - 1:])], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 65536):
        part = np.unpackbits(h[i:i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE,
                 carry: list[str] | None = None) -> DataFrame:
    """Rows ``(doc, fp)``: ``doc`` a struct of the input columns (or those in
    ``carry``), ``fp`` the fingerprint as a signed long. A text without words
    (or null) has fingerprint 0."""
    src = with_doc(docs, text_col, carry)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offs = text_buffer(text_of(batch, text_col))
            out = []
            for i, j in slices(offs):
                raw = data[offs[i]:offs[j]].tobytes().lower()
                edges = (offs[i:j + 1] - offs[i]).tolist()
                out += [fingerprint(raw[a:b].split(), shingle) for a, b in zip(edges, edges[1:])]
            fp = pa.array(np.array(out, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), fp], ["doc", "fp"])

    return src.mapInArrow(run, f"doc {dict(src.dtypes)['doc']}, fp long")


class Forest:
    """Vectorised union-find: the root of a set is its smallest member."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while True:
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                return
            lo, hi = np.minimum(ra[apart], rb[apart]), np.maximum(ra[apart], rb[apart])
            np.minimum.at(root, hi, lo)
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root = up
            self.root = root


def _half(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x >> np.uint64(32)).astype(np.int16)


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between two tiles of distinct
    fingerprints (``b=None``: within ``a``), as pairs of fingerprints."""
    a = a[np.argsort(_half(a), kind="stable")]
    other = a if b is None else b[np.argsort(_half(b), kind="stable")]
    both = a if b is None else np.concatenate([a, other])
    shift = 0 if b is None else len(a)
    ha, hb = _half(a), _half(other)
    forest = Forest(len(both))
    for i in range(0, len(a), ROWS):
        rows = a[i:i + ROWS]
        lo = int(np.searchsorted(hb, ha[i] - radius))
        hi = int(np.searchsorted(hb, ha[min(i + ROWS, len(a)) - 1] + radius, "right"))
        if b is None:
            lo = max(lo, i)
        if lo >= hi:
            continue
        near = np.bitwise_count(rows[:, None] ^ other[None, lo:hi]) <= radius
        r, c = np.nonzero(near)
        if len(r):
            forest.link(r + i, c + lo + shift)
    child = np.flatnonzero(forest.root != np.arange(len(both)))
    return both[child], both[forest.root[child]]


def class_links(classes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links ``(u, v)`` that span the components of the distinct fingerprints
    ``classes(fp)`` at ``radius`` differing bits."""
    count = F.bit_count("fp").cast("int")
    sizes = {r["c"]: r["n"] for r in classes.groupBy(count.alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()}
    tiles = {c: -(-n // tile) for c, n in sizes.items()}           # at most 65 entries
    per_count = F.array(*[F.lit(tiles.get(c, 0)) for c in range(BITS + 1)])
    dealt = (classes.select("fp", count.alias("c"))
             .withColumn("s", F.pmod(F.xxhash64("fp"), F.element_at(per_count, F.col("c") + 1)).cast("int"))
             .groupBy("c", "s").agg(F.collect_list("fp").alias("fps")))   # about `tile` values

    def meet(df: DataFrame, later: bool) -> DataFrame:
        """Every tile with the tiles (count d, number t) it meets, each pair
        of tiles in one fixed order."""
        near = (df.withColumn("d", F.explode(F.sequence(F.greatest(F.col("c") - radius, F.lit(0)),
                                                        F.least(F.col("c") + radius, F.lit(BITS)))))
                .withColumn("n", F.element_at(per_count, F.col("d") + 1)).filter("n > 0")
                .withColumn("t", F.explode(F.sequence(F.lit(0), F.col("n") - 1))))
        order = F.struct("d", "t") >= F.struct("c", "s")
        return near.filter(order) if later else near.filter(F.struct("d", "t") <= F.struct("c", "s"))

    left = meet(dealt, True).select("c", "s", "d", "t", F.col("fps").alias("x"))
    right = meet(dealt, False).select(F.col("d").alias("c"), F.col("t").alias("s"), F.col("c").alias("d"),
                                      F.col("s").alias("t"), F.col("fps").alias("y"))

    def compare(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                a = np.asarray(batch.column("x")[k].values).astype(np.int64).view(np.uint64)
                b = None
                if not batch.column("same")[k].as_py():
                    b = np.asarray(batch.column("y")[k].values).astype(np.int64).view(np.uint64)
                u, v = tile_links(a, b, radius)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    same = (F.col("c") == F.col("d")) & (F.col("s") == F.col("t"))
    pairs = left.hint("merge").join(right, ["c", "s", "d", "t"]).select("x", "y", same.alias("same"))
    return pairs.mapInArrow(compare, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, carry: list[str] | None = None) -> DataFrame:
    """Rows ``(doc, fp, component_id, representative)``; ``component_id`` is
    the smallest id reachable over links of at most ``radius`` differing bits
    (null only if no document of the component has an id), and one row of each
    component, with that id, is its representative.

    Repeated rows fall into one component; an empty table gives an empty
    result.
    """
    if not 0 <= radius < BITS:
        raise ValueError("radius must lie between 0 and 63")
    ids = carry if carry is None or id_col in carry else [*carry, id_col]
    marked = _written(fingerprints(docs, text_col, shingle, ids).withColumn("row", F.monotonically_increasing_id()),
                      "fingerprints")
    doc_id = F.col("doc").getField(id_col)
    first = F.min(F.struct(doc_id.isNull().alias("none"), doc_id.alias("id"), "row")).alias("first")
    classes = _written(marked.groupBy("fp").agg(first), "classes")
    roots = components(class_links(classes.select("fp"), radius))
    labelled = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first")
    least = labelled.groupBy("root").agg(F.min("first").alias("first"))
    named = labelled.select("fp", "root").join(least, "root").select("fp", "first")
    return marked.join(named, "fp").select("doc", "fp", F.col("first.id").alias("component_id"),
                                           (F.col("row") == F.col("first.row")).alias("representative"))
