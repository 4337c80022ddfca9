"""Removal of word sequences that occur twice: prefix-partitioned suffix trees.

A suffix is a word position from which at least ``window`` words of its text
remain; two texts (or two places of one) share a passage of ``window`` words
exactly where two suffixes share a path of that depth in the suffix tree of
the corpus. The tree is built in parts that fit into memory:

1. *Prefixes.* Every suffix is signed by the least hash among the
   ``GRAM``-word grams of its first ``window`` words. Equal prefixes have equal
   signatures, and neighbouring suffixes mostly share one, so a run of suffixes
   travels as one stretch of words. A signature that only one run has is a
   leaf at that depth: no repeat can pass through it, and it is dropped here.
2. *Variable length.* A signature with at most ``GROUP_RUNS`` runs is a group
   by itself. Where more runs share it, the prefix is lengthened to the whole
   window: its suffixes are dealt one by one by the hash of their ``window``
   words, and equal ones melt into one before they are sent.
3. *Subtrees.* Each task sorts the suffixes of its groups by prefix doubling
   over word numbers (exact words, no hashes) down to depth ``window``. A node
   there with two leaves or more is a deep internal node: its leaves are the
   starts of repeats, and neighbouring starts make up the maximal repeat.
4. *Removal.* The word ranges under deep nodes go back to their documents.

Equal runs met in one task count as repeats at once and only one is sent on,
so a passage that a third of all documents share is never gathered. Nothing is
capped: every suffix of every text is in some group.

Null text counts as empty, repeated rows are documents of their own (so their
passages repeat), texts shorter than the window lose nothing, an empty table
gives an empty result.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.components import _written
from kiln.llm.words import Words, mix, rolling, slices, sliding_min, text_buffer, whole

WINDOW = 35
#: Words of the grams that sign a suffix (fewer if the window is shorter).
GRAM = 8
#: Runs of one signature that are held as one group; more lengthen the prefix.
GROUP_RUNS = 512
#: Words of whole groups that are sorted together in a task.
TREE_WORDS = 400_000

RUN = "k1 long, k2 long, start int, n int, sig long, weight int"
SENT = "sig long, sub long, words binary, n int, weight int, k1 long, k2 long, start int, stop int"


def _runs(k1, k2, data, offs, window, gram) -> pa.RecordBatch | None:
    """Runs of neighbouring suffixes with one signature in a few texts."""
    w = Words(data, offs)
    grams = mix(rolling(w.hash, gram))
    span = window - gram + 1
    sig = sliding_min(grams, span)
    if not len(sig):
        return None
    ok = whole(w.first, len(sig), window)
    fresh = ok.copy()
    text = w.doc[:len(sig)]
    fresh[1:] &= ~ok[:-1] | (sig[1:] != sig[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(fresh)
    if not len(begin):
        return None
    # a run ends at the next beginning or at its text's last suffix
    last = w.first[w.doc[begin] + 1] - window + 1
    length = np.minimum(np.append(begin[1:], len(sig)), last) - begin
    parts = -(-length // span)              # a longer run repeats its signature: count each part
    head = np.repeat(begin, parts)
    step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    start = head + step * span
    n = np.minimum(np.repeat(length, parts) - step * span, span)
    ordered = np.sort(grams[whole(w.first, len(grams), gram)])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    signature = sig[start]
    # a run may hold equal suffixes only if its signing gram occurs twice here
    weight = 1 + (np.isin(signature, twice) if len(twice) else np.zeros(len(start), bool))
    doc = w.doc[start]
    return pa.RecordBatch.from_arrays(
        [pa.array(k1[doc]), pa.array(k2[doc]), pa.array((start - w.first[doc]).astype(np.int32)),
         pa.array(n.astype(np.int32)), pa.array(signature.view(np.int64)), pa.array(weight.astype(np.int32))],
        ["k1", "k2", "start", "n", "sig", "weight"])


def deep_leaves(group: np.ndarray, words: np.ndarray, leaf: np.ndarray, weight: np.ndarray, depth: int) -> np.ndarray:
    """Which suffixes lie under a node of the given depth that has two leaves.

    ``words`` are word numbers of all stretches in a row, ``group`` the group
    of each position, ``leaf`` the positions of the suffixes, ``weight`` how
    many places each stands for. The order of prefixes of 1, 2, 4, ... words
    gives the nodes of those depths; two overlapping ones give depth ``depth``.
    """
    _, rank = np.unique(group * (int(words.max()) + 1) + words, return_inverse=True)
    size = 1
    while size < depth:
        step = min(size, depth - size)
        ahead = np.zeros_like(rank)
        ahead[:-step] = rank[step:]
        _, rank = np.unique(rank * (int(rank.max()) + 1) + ahead, return_inverse=True)
        size += step
    node = rank[leaf]
    return np.bincount(node, weights=weight)[node] >= 2


def _subtrees(rows: list, window: int) -> pd.DataFrame:
    """Word ranges under deep internal nodes of whole groups of runs."""
    numbers: dict[bytes, int] = {}
    words, group, leaf, weight, owner = [], [], [], [], []
    g, last, at = -1, None, 0
    for i, (sig, sub, text, n, times, *_rest) in enumerate(rows):
        if (sig, sub) != last:
            g, last = g + 1, (sig, sub)
        own = [numbers.setdefault(x, len(numbers)) for x in text.split(b" ")]
        words += own
        group += [g] * len(own)
        leaf += range(at, at + n)
        weight += [times] * n
        owner += [i] * n
        at += len(own)
    leaf, owner = np.array(leaf), np.array(owner)
    deep = deep_leaves(np.array(group), np.array(words), leaf, np.array(weight), window)
    out = []
    hit = np.flatnonzero(deep)
    if len(hit):
        cut = np.flatnonzero((np.diff(owner[hit]) != 0) | (np.diff(leaf[hit]) != 1)) + 1
        head, tail = np.concatenate(([0], cut)), np.concatenate((cut, [len(hit)])) - 1
        base = np.searchsorted(owner, owner[hit[head]])
        for o, a, b in zip(owner[hit[head]].tolist(), (hit[head] - base).tolist(), (hit[tail] - base).tolist()):
            _, _, _, _, _, k1, k2, start = rows[o]
            out.append((k1, k2, start + a, start + b + window))
    return pd.DataFrame(out, columns=["k1", "k2", "start", "stop"]).astype(
        {"k1": "int64", "k2": "int64", "start": "int32", "stop": "int32"})


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group_runs: int = GROUP_RUNS) -> DataFrame:
    """Word ranges ``(k1, k2, start, stop)`` of ``docs(k1, k2, text)`` that
    windows with a second start cover; ``k1, k2`` name a document."""
    spark = docs.sparkSession
    gram = min(gram, window)

    def runs(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
            data, offs = text_buffer(batch.column("text"))
            for i, j in slices(offs):
                found = _runs(k1[i:j], k2[i:j], data, offs[i:j + 1], window, gram)
                if found is not None:
                    yield found

    all_runs = _written(docs.select("k1", "k2", "text").mapInArrow(runs, RUN), "runs")
    shared = _written(all_runs.groupBy("sig").agg(F.sum("weight").alias("times")).filter("times >= 2"), "signatures")
    inner = all_runs.join(shared, "sig")
    per_doc = inner.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "n", "sig", "times")).alias("runs"))

    def send(batches):
        for batch in batches:
            sent: dict = {}
            done: dict = {}
            for k1, k2, text, mine in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "text", "runs"))):
                words = text.encode().split()
                for r in mine:
                    start, n, sig = r["start"], r["n"], r["sig"]
                    if r["times"] <= group_runs:
                        parts = [(start, n, 0)]
                    else:
                        parts = [(start + i, 1, None) for i in range(n)]
                    for at, size, sub in parts:
                        own = b" ".join(words[at:at + size + window - 1])
                        if sub is None:
                            sub = xxhash.xxh3_64_intdigest(own) - (1 << 63)
                        key = (sig, sub, own)
                        first = sent.get(key)
                        if first is None:
                            sent[key] = [size, 1, k1, k2, at]
                            continue
                        if first[1] == 1:
                            first[1] = 2
                            done.setdefault((first[2], first[3]), []).append((first[4], first[4] + size + window - 1))
                        done.setdefault((k1, k2), []).append((at, at + size + window - 1))
            # known repeats travel under their document's key, so that no passage gathers them
            out = [(k1, a, None, 0, 0, k1, k2, a, b) for (k1, k2), ranges in done.items() for a, b in _merged(ranges)]
            out += [(sig, sub, own, size, times, k1, k2, at, 0)
                    for (sig, sub, own), (size, times, k1, k2, at) in sent.items()]
            for i in range(0, len(out), 5000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i:i + 5000]), sent_types)],
                                                 sent_names)

    def trees(batches):
        def rows():
            for pdf in batches:
                known = pdf["words"].isna()
                if known.any():
                    ready.append(pdf.loc[known, ["k1", "k2", "start", "stop"]])
                rest = pdf[~known]
                yield from zip(rest["sig"], rest["sub"], rest["words"], rest["n"], rest["weight"], rest["k1"], rest["k2"],
                               rest["start"])

        ready: list[pd.DataFrame] = []
        held, size = [], 0
        for _, own in groupby(rows(), key=lambda r: (r[0], r[1])):
            own = list(own)
            if len(own) == 1 and own[0][3] == 1 and own[0][4] == 1:
                continue                                     # a single leaf
            held += own
            size += sum(r[2].count(b" ") + 1 for r in own)
            if size >= TREE_WORDS:
                yield _subtrees(held, window)
                held, size = [], 0
            while ready:
                yield ready.pop()
        if held:
            yield _subtrees(held, window)
        while ready:
            yield ready.pop()

    sent_names = ["sig", "sub", "words", "n", "weight", "k1", "k2", "start", "stop"]
    sent_types = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # all columns of docs go in, as in the join that ends the removal, so that both read one exchange
    texts = docs.join(per_doc, ["k1", "k2"])
    return (texts.mapInArrow(send, SENT).repartition(parts, "sig", "sub").sortWithinPartitions("sig", "sub")
            .mapInPandas(trees, "k1 long, k2 long, start int, stop int"))


def _kept(text: str, ranges) -> tuple[str, int, int]:
    """The text without the words of the ranges, its words, and those gone."""
    raw = text.encode()
    if ranges is None or len(ranges) == 0:
        return text, len(raw.split()), 0
    w = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), hashes=False)
    n, removed, at, parts = len(w.starts), 0, 0, []
    for a, b in [*_merged([(r["start"], r["stop"]) for r in ranges]), (n, n)]:
        if a > at:
            parts.append(raw[w.starts[at]:w.ends[a - 1]])
        removed += b - a
        at = b
    return b" ".join(parts).decode(), n, removed


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   carry: list[str] | None = None) -> DataFrame:
    """Rows ``(doc, text, n_words, n_removed)``: ``doc`` a struct of the input
    columns but the text (or those in ``carry``), ``text`` without the words
    that a repeated window covers (null: empty). Stretches between removed passages keep their white space
    and are joined by one space; a text that loses nothing stays as it is."""
    if window < 1:
        raise ValueError("the window must hold a word at least")
    cols = [F.col(f"`{c}`") for c in (carry if carry is not None else [c for c in docs.columns if c != text_col])]
    cols = cols or [F.lit(None).cast("boolean").alias("none")]
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = docs.select(F.struct(*cols).alias("doc"), text.alias("text"),
                        F.xxhash64(text, F.col(id_col).cast("string")).alias("k1"),
                        F.xxhash64(F.lit(7), F.col(id_col).cast("string"), text).alias("k2"))
    named = named.select("doc", "text", "k1", "k2")
    found = repeats(named, window).groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    kind = dict(named.dtypes)["doc"]

    def finish(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [_kept(t, r) for t, r in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist())]
            kept, n, removed = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array(removed, pa.int64())],
                ["doc", "text", "n_words", "n_removed"])

    return (named.join(found, ["k1", "k2"], "left").select("doc", "text", "ranges")
            .mapInArrow(finish, f"doc {kind}, text string, n_words long, n_removed long"))
