"""Embedding near-duplicates by iterative quantisation and multi-index Hamming
tables, with an exact rerank.

1. *Rotation.* On a bounded sample (``SAMPLE`` usable vectors with the smallest
   id hashes) a projection on principal directions is rotated, step by step,
   until its signs lose least: balanced binary codes of up to 64 bits. Every
   vector of that length is coded by that one matrix. The Hamming radius is measured on the
   same sample: it covers ``RECALL`` of pairs made at the threshold.
2. *Tables.* A code is cut into substrings, one hash table each. Two codes that
   differ in at most ``radius`` bits agree in some substring up to a small
   number of bits, so probing each table with that many flipped bits finds
   every code pair within the radius, exactly. The number of substrings
   follows the number of codes (a cost estimate); it never changes results.
   Equal codes are one entry, and a pair is taken from the first table only.
3. *Rerank.* The vectors of two near codes (or of one) meet in blocks of at most
   ``BLOCK`` a side and are compared by cosine in double precision. A block
   pair returns, per vector, how many vectors it links and its root in the
   block's spanning forest, never the pairs.

Identical vectors are one entry with a multiplicity. Vectors link only under
one label that is not null and with one length: each length has a rotation and
codes of its own (a table has as many lengths as it mixes encoders; they are
taken one after another). Null or zero vectors and vectors with a null or
non-finite component link with nothing. Repeated rows count as vectors of their own;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.components import _written, components
from kiln.llm.simhash import Forest

COSINE = 0.93
SAMPLE = 4096
BITS = 64
ITERATIONS = 30
BLOCK = 1024
#: Standard deviations above the mean distance, at the threshold, that the
#: Hamming radius covers at least.
SLACK = 1.5
#: Share of the pairs at the threshold that the Hamming radius covers, and the
#: least number of such pairs it is measured on.
RECALL = 0.95
PROBES = 4096


def fit_rotation(sample: np.ndarray, bits: int = BITS, iterations: int = ITERATIONS) -> tuple[np.ndarray, np.ndarray]:
    """Centre and matrix of the codes of unit vectors."""
    centre = sample.mean(0)
    x = sample - centre
    _, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, ::-1][:, :min(bits, x.shape[1])]
    z = x @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(1).normal(size=(z.shape[1],) * 2))
    for _ in range(iterations):
        signs = np.where(z @ turn > 0, 1.0, -1.0)
        u, _, vt = np.linalg.svd(signs.T @ z)
        turn = (u @ vt).T
    return centre, axes @ turn


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, safe for very large and small components."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def partners(x: np.ndarray, cosine: float, rng: np.random.Generator, own: bool) -> np.ndarray:
    """For each unit vector another one at exactly ``cosine``: off in any
    direction, or (``own``) in a direction in which vectors of ``x`` differ."""
    if own:
        way = x[rng.permutation(len(x))] - x[rng.permutation(len(x))]
    else:
        way = rng.normal(size=x.shape)
    way = way - (way * x).sum(1, keepdims=True) * x
    size = np.linalg.norm(way, axis=1, keepdims=True)
    ok = size[:, 0] > 1e-9                     # equal vectors and single components have no direction
    out = x.copy()
    out[ok] = cosine * x[ok] + math.sqrt(max(0.0, 1 - cosine * cosine)) * way[ok] / size[ok]
    return out


def hamming_radius(sample: np.ndarray, bits: int, cosine: float, recall: float = RECALL) -> int:
    """Bits that codes of vectors at the threshold differ in, with some slack.

    At least what the angle of the threshold gives. Codes are signs of centred
    vectors, whose angle is larger when the vectors have a common mean, so the
    radius is also measured: half of the sample is coded by the rotation of
    the other half (its own would fit it too well), against partners made at
    the threshold, and ``recall`` of these pairs are covered."""
    width = min(bits, sample.shape[1])
    p = math.acos(max(-1.0, min(1.0, cosine))) / math.pi
    radius = min(width, math.ceil(width * p + SLACK * math.sqrt(width * p * (1 - p))))
    if len(sample) < 2:
        return radius
    centre, turn = fit_rotation(sample[::2], bits)
    rng = np.random.default_rng(2)
    x = np.resize(sample[1::2], (max(len(sample) // 2, PROBES), sample.shape[1]))
    code = (x - centre) @ turn > 0
    for own in (False, True):
        y = partners(x, cosine, rng, own)
        moved = np.abs(y - x).max(1) > 0
        if moved.any():
            differ = (((y - centre) @ turn > 0) != code).sum(1)[moved]
            radius = max(radius, int(np.quantile(differ, recall, method="higher")))
    return radius


def tables(bits: int, radius: int, codes: int) -> list[tuple[int, int, list[int]]]:
    """``(mask, flips, probes)`` of each table: the bits of its substring, how
    many of them may differ, and the bit patterns to flip."""
    def layout(m):
        edges = [round(i * bits / m) for i in range(m + 1)]
        each, more = divmod(radius, m)
        return [(a, b, each if t <= more else each - 1) for t, (a, b) in enumerate(zip(edges, edges[1:]))]

    def cost(m):
        return sum(sum(math.comb(b - a, k) for k in range(r + 1)) * (1 + codes / 2 ** (b - a))
                   for a, b, r in layout(m) if r >= 0)

    best = min(range(1, min(bits, radius + 1) + 1), key=cost)
    out = []
    for a, b, r in layout(best):
        if r >= 0:
            flips = [sum(1 << i for i in some) for k in range(min(r, b - a) + 1) for some in combinations(range(a, b), k)]
            out.append((((1 << b) - (1 << a)), r, flips))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _usable(v: Column) -> Column:
    big = F.lit(float("inf"))
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))
    return F.coalesce(v.isNotNull() & sound & F.exists(v, lambda x: x != 0), F.lit(False))


def code_pairs(codes: DataFrame, bits: int, radius: int) -> DataFrame:
    """Pairs ``(label, a, b)``, a < b, of distinct ``codes(label, code)`` that
    differ in at most ``radius`` bits."""
    most = codes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    made = tables(bits, radius, most)
    masks = [F.lit(_signed(mask)) for mask, _, _ in made]
    stored = F.array(*[F.struct(F.lit(t).alias("t"), F.col("code").bitwiseAND(m).alias("key")) for t, m in enumerate(masks)])
    flips = F.array(*[F.struct(F.lit(t).alias("t"), masks[t].alias("mask"), F.lit(_signed(f)).alias("flip"))
                      for t, (_, _, all_flips) in enumerate(made) for f in all_flips])
    left = codes.select("label", F.col("code").alias("a"), F.explode(flips).alias("p")).select(
        "label", "a", F.col("p.t").alias("t"), F.col("a").bitwiseXOR(F.col("p.flip")).bitwiseAND(F.col("p.mask")).alias("key"))
    right = codes.select("label", F.col("code").alias("b"), F.explode(stored).alias("s")).select(
        "label", "b", F.col("s.t").alias("t"), F.col("s.key").alias("key"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    first = F.lit(True)
    for t, (m, (_, r, _)) in enumerate(zip(masks, made)):
        first = first & ((F.col("t") <= t) | (F.bit_count(differ.bitwiseAND(m)) > r))
    # Spark takes an exploded table for as small as its source: never broadcast it
    return (left.hint("merge").join(right, ["label", "t", "key"]).filter((F.col("a") < F.col("b")) & (F.bit_count(differ) <= radius) & first)
            .select("label", "a", "b"))


def block_links(x, y, wx, wy, cosine):
    """Linked weights of each side, and the forest's roots over both (x before
    y); ``y`` None compares ``x`` with itself."""
    near = x @ (x if y is None else y).T >= cosine
    if y is None:
        np.fill_diagonal(near, False)
        add = near @ wx
    else:
        add = np.concatenate([near @ wy, near.T @ wx])
    r, c = np.nonzero(near)
    forest = Forest(len(add))
    if len(r):
        forest.link(r, c + (0 if y is None else len(x)))
    return add, forest.root


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    cosine: float = COSINE, sample: int = SAMPLE, bits: int = BITS, radius: int | None = None) -> DataFrame:
    """Rows ``(id, n_links, component_id, kept)``, one per input row: other
    vectors linked directly, the smallest id reachable, and whether that is
    its own id."""
    src = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
    src = src.withColumn("ok", _usable(F.col("v")) & F.col("label").isNotNull())
    rows = _written(src.withColumn("d", F.when(F.col("ok"), F.size("v")))
                    .withColumn("k1", F.when(F.col("ok"), F.xxhash64("label", "v")))
                    .withColumn("k2", F.when(F.col("ok"), F.xxhash64(F.lit(7), "v", "label"))), "vectors")
    # one row per length: a table has as many as it mixes encoders
    sizes = rows.filter("ok").groupBy("d").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").orderBy("d").collect()
    named = [_linked(rows.filter(F.col("ok") & (F.col("d") == r["d"])), r["d"], cosine, sample, bits, radius) for r in sizes]
    out = rows.select("id", "k1", "k2", "d")
    if named:
        all_named = _written(reduce(lambda a, b: a.unionByName(b), named), "classes")
        known = _written(out.join(all_named, ["d", "k1", "k2"], "left").select("id", "d", "n_links", "root"), "named")
        least = known.filter("root is not null").groupBy("d", "root").agg(F.min("id").alias("least"))
        out = known.join(least, ["d", "root"], "left")
    else:
        out = out.withColumns({"n_links": F.lit(0), "least": F.col("id")})
    component = F.coalesce("least", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _linked(rows: DataFrame, d: int, cosine: float, sample: int, bits: int, radius: int | None) -> DataFrame:
    """``(d, k1, k2, n_links, root)`` of the different vectors (by two hashes of
    label and vector) of one length; ``root`` names the component."""
    chosen = rows.select("v", F.xxhash64(F.col("id").cast("string")).alias("h"), "k1").orderBy("h", "k1").limit(sample)
    learned = unit(np.array([r["v"] for r in chosen.select("v").collect()], float))
    centre, turn = fit_rotation(learned, bits)
    width = turn.shape[1]
    radius = hamming_radius(learned, bits, cosine) if radius is None else radius
    weights = 1 << np.arange(width, dtype=np.uint64)

    def code(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(float)
            on = (unit(flat.reshape(-1, d)) - centre) @ turn > 0
            codes = pa.array((on * weights).sum(1, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, codes], [*batch.schema.names, "code"])

    classes = (rows.groupBy("k1", "k2")
               .agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count(F.lit(1)).alias("w"))
               .withColumn("cid", F.monotonically_increasing_id()))
    kinds = ", ".join(f"{n} {t}" for n, t in classes.dtypes)
    classes = _written(classes.mapInArrow(code, f"{kinds}, code long"), "codes")
    cells = _written(classes.groupBy("label", "code").agg(F.count(F.lit(1)).alias("n")), "cells")

    pairs = code_pairs(cells.select("label", "code"), width, radius)
    own = cells.filter("n > 1").select("label", F.col("code").alias("a"), F.col("code").alias("b"))
    spread = F.ceil(F.col("n") / F.lit(BLOCK)).cast("long")
    blocks = _written(classes.join(cells, ["label", "code"]).withColumn("c", F.pmod(F.xxhash64("cid"), spread))
                      .groupBy("label", "code", "c").agg(F.collect_list(F.struct("cid", "w", "v")).alias("all"))
                      .select("label", "code", "c", F.col("all.cid").alias("ids"), F.col("all.w").alias("w"),
                              F.flatten("all.v").alias("flat")), "blocks")
    one = blocks.select("label", F.col("code").alias("a"), F.col("c").alias("ca"), F.col("ids").alias("xi"),
                        F.col("w").alias("xw"), F.col("flat").alias("xv"))
    two = blocks.select("label", F.col("code").alias("b"), F.col("c").alias("cb"), F.col("ids").alias("yi"),
                        F.col("w").alias("yw"), F.col("flat").alias("yv"))
    met = (pairs.unionByName(own).join(one, ["label", "a"]).join(two, ["label", "b"])
           .filter((F.col("a") < F.col("b")) | (F.col("ca") <= F.col("cb")))
           .select("xi", "xw", "xv", "yi", "yw", "yv", ((F.col("a") == F.col("b")) & (F.col("ca") == F.col("cb"))).alias("same")))

    def rerank(batches):
        for batch in batches:
            col = {n: batch.column(n) for n in batch.schema.names}

            def side(k, s):
                ids, w, flat = (col[s + p][k].values.to_numpy(zero_copy_only=False) for p in "iwv")
                return ids, w.astype(float), unit(flat.astype(float).reshape(-1, d))

            for k in range(batch.num_rows):
                xi, xw, x = side(k, "x")
                yi, yw, y = (xi, xw, None) if col["same"][k].as_py() else side(k, "y")
                add, root = block_links(x, y, xw, yw, cosine)
                ids = xi if y is None else np.concatenate([xi, yi])
                hit = np.flatnonzero(add)
                if len(hit):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[hit]), pa.array(add[hit].astype(np.int64)), pa.array(ids[root[hit]])],
                        ["cid", "add", "root"])

    linked = _written(met.mapInArrow(rerank, "cid long, add long, root long"), "linked")
    count = linked.groupBy("cid").agg(F.sum("add").alias("add"))
    roots = components(linked.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    named = (classes.select("k1", "k2", "cid", "w").join(count, "cid", "left")
             .join(roots, F.col("cid") == F.col("node"), "left")
             .select("k1", "k2", (F.col("w") - 1 + F.coalesce("add", F.lit(0))).alias("n_links"),
                     F.coalesce("root", "cid").alias("root")))
    return named.withColumn("d", F.lit(d))
