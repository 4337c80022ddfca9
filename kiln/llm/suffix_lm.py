"""Language-model scoring with a probabilistic suffix tree over words.

A text is its lower-cased words and one end. The probability of the next
symbol depends on the longest *retained* suffix of the words before it, up to
the text's beginning (the end of another text) or ``depth`` words:

1. *Base.* The root of the tree is the distribution of single symbols.
2. *Contexts* grow by one word a level. One of ``d`` words is a candidate if it
   has ``least`` training positions, an absolute number: nodes and edges grow
   with the corpus, and a phrase counts alike in a small and in a large one.
3. *Smoothing.* ``P(x | s) = (n(s x) + prior * P(x | suffix)) / (n(s) + prior)``,
   where the suffix is the longest retained one.
4. *Divergence test.* A context is retained if its distribution tells its
   training symbols better than its suffix's by more than ``divergence`` nats in
   all; the test reads the suffix's log-probabilities in steps of 1/64 nat and
   sums in steps of 2^-20 nat, so that no order of the sums decides. Every context
   is tested, unless ``assured`` names positions from which it is not.
5. *Scoring.* Each symbol has the probability of its longest retained suffix.

No task and no driver holds the tree. Texts are cut into *chunks* of whole texts
(``slices``: 2 MB or one text), written once as numbers. A level is one exchange:
each chunk sends its distinct pairs (context, next symbol) with their training
counts and the suffix's log-probability to the bucket of the context, packed;
the bucket sums and numbers the pairs, tests the contexts, and answers in the
order asked. The number of a pair names the context of one word more, and its
count is that context's total, so a chunk knows before it asks which contexts
are too rare, and which are so frequent (``dealt``) that their pairs are dealt by
the next symbol over buckets in proportion; their parts of the test are summed
per context before the verdict, so it is that of one bucket. A chunk's state is told anew from its answers, so a lost task needs
nothing but tables of the shared folder; these are bucketed by chunk and meet
without another shuffle. Words are told apart by 64-bit hashes, contexts by
their numbers. The driver sees two sums and the dealt contexts that failed the
test (at most one in ``dealt`` tokens a level).

Null text counts as empty, a null id as the empty string (training). Repeated
rows count and are scored each; an empty table gives an empty result; without
training texts every word has probability one. Other columns are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kiln.llm.components import _written
from kiln.llm.words import Words, mix, slices, text_buffer
from kiln.session import scratch_path

DEPTH = 3
LEAST = 2
PRIOR = 100.0
DIVERGENCE = 8.0
#: Positions from which the pairs of a context are dealt by the next symbol (memory of a task; no result depends on it).
DEALT = 200_000
#: Bytes of texts in a chunk (or one text): its arrays, sorted and gathered at every level, stay near a core's cache.
CHUNK_BYTES = 2 << 20
#: Tokens per bucket of an exchange (memory of a task; there are more buckets in a larger corpus).
BUCKET_TOKENS = 1_000_000
#: Steps a nat in which the divergence test reads the suffix's log-probability.
STEPS = 64.0
#: Steps a nat in which the test's sums are exact.
FINE = float(1 << 20)
#: Spark's setting that removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Stands for the end among the word hashes.
END = np.uint64(0x656E64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def pack(*columns: np.ndarray) -> bytes:
    """Columns of unsigned 64-bit values by byte planes, compressed together."""
    widths, planes = [], []
    for values in columns:
        v = np.ascontiguousarray(values, "<u8")
        widths.append(max(1, (int(v.max()).bit_length() + 7) // 8) if len(v) else 1)
        planes.append(v.view(np.uint8).reshape(-1, 8)[:, :widths[-1]].T.tobytes())
    return bytes(widths) + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack_columns(data, n: int) -> list[np.ndarray]:
    if data is None:                                               # a chunk that had nothing to ask
        return [np.zeros(0, np.uint64)] * n
    data = memoryview(data)
    widths, planes = data[:n], np.frombuffer(zstandard.ZstdDecompressor().decompress(data[n:]), np.uint8)
    rows, at, columns = len(planes) // sum(widths), 0, []
    for width in widths:
        out = np.zeros((rows, 8), np.uint8)
        out[:, :width] = planes[at:at + width * rows].reshape(width, rows).T
        columns.append(out.reshape(-1).view("<u8"))
        at += width * rows
    return columns


def unpack(data) -> np.ndarray:
    return unpack_columns(data, 1)[0]


def steps_of(values: np.ndarray) -> np.ndarray:
    """Differences of ascending values."""
    return np.diff(values.astype(np.uint64), prepend=np.uint64(0))


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending values by their differences."""
    return pack(steps_of(values))


def unpack_sorted(data) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def heads(*keys: np.ndarray) -> np.ndarray:
    """Where a new key begins among rows sorted by all ``keys``."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def order_of(*keys: np.ndarray) -> np.ndarray:
    """Order of rows by keys that are not negative, equal ones as they come.
    Keys and places are sorted as one number where these fit into 64 bits, if
    need be by the ranks of the widest keys."""
    own = len(keys[0]).bit_length()
    keys = [k.astype(np.uint64, copy=False) for k in keys]
    bits = [int(k.max()).bit_length() if len(k) else 0 for k in keys]
    for i in sorted(range(len(keys)), key=lambda i: -bits[i]):
        if len(keys) > 1 and sum(bits) + own > 64 and bits[i] > own:
            o = order_of(keys[i])
            keys[i], bits[i] = distinct(o, heads(keys[i][o]))[1].astype(np.uint64), own
    if sum(bits) + own > 64:
        return np.lexsort(keys[::-1])
    one = keys[0]
    for k, b in zip(keys[1:], bits[1:]):
        one = (one << np.uint64(b)) | k
    one = (one << np.uint64(own)) | np.arange(len(one), dtype=np.uint64)
    one.sort()
    return (one & np.uint64((1 << own) - 1)).astype(np.int64)


def by_pair(a: np.ndarray, b: np.ndarray):
    """``(order, where a new pair begins)`` of unsigned pairs in their order."""
    order = order_of(a, b)
    return order, heads(a[order], b[order])


def before(values: np.ndarray, k: int) -> np.ndarray:
    """The value ``k`` places before each, zero where there is none."""
    out = np.zeros_like(values)
    out[k:] = values[:len(values) - k]
    return out


def distinct(order: np.ndarray, head: np.ndarray):
    """A place of each distinct key, and the number of the key at each place."""
    number = np.empty(len(order), np.int64)
    number[order] = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(order))))
    return order[head], number


def chunks(docs: DataFrame) -> DataFrame:
    """Rows ``(chunk, ids, held, sizes, words, ranks, codes, tokens, train)``:
    whole texts as ranks of the chunk's distinct word hashes by their number
    there, so that most are small; 0 is the end."""
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offs = text_buffer(batch.column("text"))
            for i, j in slices(offs, CHUNK_BYTES):
                own = offs[i:j + 1]
                w = Words(LOWER[data[own[0]:own[-1]]], own - own[0])
                coded = pa.array(w.hash).dictionary_encode()
                words, code = coded.dictionary.to_numpy(), coded.indices.to_numpy()
                n = np.bincount(code, minlength=len(words))
                order = np.argsort(words)
                rank = np.empty(len(words), np.int64)
                rank[order[np.argsort(-n[order], kind="stable")]] = np.arange(1, len(words) + 1)
                codes = np.zeros(len(w.hash) + j - i, np.int64)    # one end after each text
                codes[np.arange(len(w.hash)) + w.doc] = rank[code]
                words, rank = words[order], rank[order]
                held = np.asarray(batch.column("held_out").slice(i, j - i).to_pylist(), bool)
                sizes = w.n_words + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), batch.column("id").slice(i, j - i)),
                     pa.array([held.tobytes()], pa.binary()), pa.array([pack(sizes)], pa.binary()),
                     pa.array([pack_sorted(words)], pa.binary()), pa.array([pack(rank)], pa.binary()),
                     pa.array([pack(codes)], pa.binary()), pa.array([len(codes)]), pa.array([int(sizes[~held].sum())])],
                    ["chunk", "ids", "held", "sizes", "words", "ranks", "codes", "tokens", "train"])
                number += 1

    kind = dict(docs.dtypes)["id"]
    return docs.mapInArrow(run, f"chunk long, ids array<{kind}>, held binary, sizes binary, words binary, ranks binary, "
                                "codes binary, tokens long, train long")


class Chunk:
    """The state of a chunk after the answers of some levels. Its positions are
    sorted once by the symbol there and those before it, so the distinct pairs
    of every level are stretches of that ``order``; ``share`` is the number of
    symbols that a position has in common with the one sorted before it.
    ``told``, in that order, is the probability of each symbol; ``live`` are the
    places of positions whose context of ``level`` words is a candidate, ``last``
    by position that context's row in ``ctx`` and ``total``, its number and positions."""

    def __init__(self, row: dict, least: int, prior: float, assured: float, dealt: int):
        self.least, self.prior, self.assured, self.dealt = least, prior, assured, dealt
        hashes, rank = unpack_sorted(row["words"]), unpack(row["ranks"]).astype(np.int64)
        self.words = np.full(len(hashes) + 1, END)
        self.words[rank] = hashes
        self.codes = unpack(row["codes"]).astype(np.int64)
        self.sizes = unpack(row["sizes"]).astype(np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.held = np.frombuffer(row["held"], bool)
        self.train = np.repeat(~self.held, self.sizes)

    def start(self, answer: np.ndarray, ids: np.ndarray, z: float, symbols: int) -> None:
        """Take the counts and numbers of the words; sort by ``symbols`` symbols."""
        back = order_of(self.asked(self.words))
        n, self.word_id = np.empty(len(back), np.int64), np.empty(len(back), np.int64)
        n[back], self.word_id[back] = answer >> 1, ids - 1
        self.n, self.root = n, (n + 0.5) / z
        last = before(self.codes, 1)
        last[self.first] = 0                                       # a text begins after another's end
        self.last, self.ctx, self.total = last.astype(np.int32), self.word_id, n
        # words without training count are one; texts run on into the one before, but no such context is a candidate
        symbol = np.where(self.word_id >= 0, np.arange(len(n)), len(n))[self.codes].astype(np.uint64)
        rank, length, self.order = symbol, 1, order_of(symbol) if symbols < 2 else None
        while length < symbols:
            self.order, head = by_pair(rank, before(rank, length))
            length *= 2
            if length < symbols:
                rank = distinct(self.order, head)[1].astype(np.uint64)
        self.share, same = np.zeros(len(symbol), np.uint8), np.ones(len(symbol), bool)
        same[:1] = False
        for k in range(symbols):
            here = before(symbol, k)[self.order]
            same[1:] &= here[1:] == here[:-1]
            self.share += same
        self.told = self.root[self.codes[self.order]]
        self.level, self.live = 1, np.flatnonzero((n >= self.least)[last][self.order])

    def buckets(self, n: int) -> None:
        self.n_buckets = n

    def asked(self, ctx, x=None, total=None) -> np.ndarray:
        """Buckets of words; of contexts, where pairs of one with more than ``dealt``
        positions are dealt by the next symbol over as many as it has such shares."""
        if x is None:
            return (mix(ctx) % np.uint64(self.n_buckets)).astype(np.int64)
        bucket = mix(ctx.astype(np.uint64) + np.uint64(1)) % np.uint64(self.n_buckets)
        wide = np.flatnonzero(total > self.dealt)
        share = mix(x[wide].astype(np.uint64) + np.uint64(3)) % (total[wide] // self.dealt + 1).astype(np.uint64)
        bucket[wide] = (bucket[wide] + share) % np.uint64(self.n_buckets)
        return bucket.astype(np.int64)

    def word_question(self):
        n = np.bincount(self.codes, weights=self.train, minlength=len(self.words)).astype(np.int64)
        bucket, none = self.asked(self.words), np.zeros(len(n), np.int64)
        return order_of(bucket), bucket, none, self.words, n, none

    def pairs(self):
        """Distinct pairs of the candidates: where each begins in ``live``, a position of
        each, its bucket, context, next symbol, the context's positions, and the order of asking."""
        head = np.flatnonzero(self.share[self.live] <= self.level)
        first = self.order[self.live[head]]
        last, x = self.last[first], self.word_id[self.codes[first]] + 1
        ctx, total = self.ctx[last], self.total[last]
        bucket = self.asked(ctx, x, total)
        return head, first, bucket, ctx, x, total, order_of(bucket, ctx)

    def question(self):
        """``(order, bucket, twice the context and whether it is dealt, next, training
        count, log-probability steps)`` of the distinct pairs."""
        head, _, bucket, ctx, x, total, order = self.pairs()
        n = np.add.reduceat(self.train[self.order[self.live]], head, dtype=np.int64) if len(head) else head
        steps = np.rint(-np.log(self.told[self.live[head]]) * STEPS).astype(np.int64)
        return order, bucket, ctx << 1 | (total > self.dealt), x, n, steps

    def advance(self, answer: np.ndarray, ids: np.ndarray, failed: np.ndarray) -> None:
        """Take the answers to ``question`` and go one word deeper; ``failed``
        are the dealt contexts that the test does not retain."""
        head, first, _, ctx, _, total, back = self.pairs()
        n, keep, number = (np.empty(len(back), np.int64) for _ in range(3))
        n[back], keep[back], number[back] = answer >> 1, answer & 1, ids - 1
        wide = np.flatnonzero(total > self.dealt)
        keep[wide] = ~np.isin(ctx[wide], failed)
        told = self.told[self.live[head]]
        told = np.where((keep > 0) | (total > self.assured), (n + self.prior * told) / (total + self.prior), told)
        width = np.diff(np.append(head, len(self.live)))
        self.told[self.live] = np.repeat(told, width)
        # the pair at a position is the context of the next one, unless the text ends with it
        on = (number >= 0) & (self.codes[first] > 0)
        at = self.order[self.live[np.repeat(on, width)]] + 1
        self.ctx, self.total = number[on], n[on]
        self.last[at] = np.repeat(np.arange(len(self.ctx), dtype=np.int32), width[on])
        live = np.zeros(len(self.order), bool)
        live[at] = True
        self.level, self.live = self.level + 1, np.flatnonzero(live[self.order])

    def sums(self) -> list[np.ndarray]:
        """Known symbols and log10 probabilities of each text, by words and by the tree."""
        told = np.empty(len(self.order))
        told[self.order] = np.log10(self.told)
        return [np.add.reduceat(v, self.first) for v in ((self.n > 0).astype(np.int64)[self.codes], np.log10(self.root)[self.codes], told)]


def replayed(batches, failed: list, symbols: int, z: float, n_buckets: int, least: int, prior: float, assured: float, dealt: int):
    """``(row, chunk)`` of each row, with the answers of the levels of ``failed`` taken
    (the pairs of those and of the next one have at most ``symbols`` symbols)."""
    for batch in batches:
        for row in batch.to_pylist():
            c = Chunk(row, least, prior, assured, dealt)
            c.buckets(n_buckets)
            for d, none in enumerate(failed):
                answer, ids = (v.view(np.int64) for v in unpack_columns(row[f"answer{d}"], 2))
                c.start(answer, ids, z, symbols) if d == 0 else c.advance(answer, ids, none)
            yield row, c


MET = ["chunk", "bucket", "answer", "kinds", "part", "total"]


def retained(part: np.ndarray, total: np.ndarray, prior: float, divergence: float) -> np.ndarray:
    """The test of contexts from the sums over their pairs and their positions."""
    return part - np.rint(total * np.log(total + prior) * FINE).astype(np.int64) > round(divergence * FINE)


def met(rows, level: int, last: bool, n_buckets: int, least: int, prior: float, divergence: float):
    """Answer the questions of one bucket: sums, numbers and tests. Frequent
    pairs have small numbers; after the last level none are needed. A dealt
    context has a row of its own (chunk -1 less its number) with its part of
    the test and of its positions."""
    bucket, sizes = rows[0][0], [len(r[3]) for r in rows]
    ctx, x, n, steps = (np.concatenate([r[k] for r in rows]) for k in range(2, 6))
    order, head = by_pair(ctx, x)
    _, pair = distinct(order, head)
    count = np.add.reduceat(n[order], head)
    kept = np.zeros(len(head), np.int64)
    parts = [np.zeros(0, np.int64)] * 3
    if level:
        own = ctx[order][head]
        at = heads(own)
        told = np.exp(-steps[order][head] / STEPS)
        part = np.add.reduceat(np.rint(count * np.log((count + prior * told) / told) * FINE).astype(np.int64), at)
        total = np.add.reduceat(count, at)
        kept = np.repeat(retained(part, total, prior, divergence), np.diff(np.append(at, len(own)))).astype(np.int64)
        wide = (own[at] & np.uint64(1)) > 0
        parts = [-1 - (own[at][wide] >> np.uint64(1)).astype(np.int64), part[wide], total[wide]]
    number = np.zeros(len(head), np.int64)
    often = np.flatnonzero(count >= (least if level else 1))
    if not last:
        number[often[order_of(count.max() - count[often])]] = np.arange(len(often)) * n_buckets + bucket + 1
    answer = (count << 1) | kept
    kinds = int((count > 0).sum())
    edges = np.cumsum([0, *sizes])
    answer, number = answer[pair], number[pair]
    packed = [pack(answer[i:j], number[i:j]) for i, j in zip(edges, edges[1:])]
    none, own = np.zeros(len(rows), np.int64), len(rows) + len(parts[0])
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([[r[1] for r in rows], parts[0]]).astype(np.int64)), pa.array(np.full(own, bucket, np.int32)),
         pa.array(packed + [None] * len(parts[0]), pa.binary()), pa.array(np.eye(1, own, dtype=np.int64)[0] * kinds),
         *(pa.array(np.concatenate([none, p])) for p in parts[1:])], MET)


def groups(batches, key: str):
    """Lists of the rows of each key from rows sorted by it."""
    held = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[-1][key] != row[key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def exchange(asking: DataFrame, level: int, last: bool, n_buckets: int, z: float, least: int, prior: float, divergence: float,
             assured: float, dealt: int, failed: list) -> DataFrame:
    """One level: questions to buckets, answers back, one row per chunk and one per dealt context."""
    def ask(batches):
        for row, c in replayed(batches, failed, level + 1, z, n_buckets, least, prior, assured, dealt):
            order, bucket, *columns = c.question() if level else c.word_question()
            edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            full = np.flatnonzero(np.diff(edges))
            ctx, *rest = (col[order] for col in columns)
            packed = [pack(steps_of(ctx[i:j]), *(col[i:j] for col in rest)) for i, j in zip(edges[full], edges[full + 1])]
            yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(np.full(len(full), row["chunk"])),
                                              pa.array(packed, pa.binary())], ["bucket", "chunk", "asked"])

    def meet(batches):
        for rows in groups(batches, "bucket"):
            own = []
            for r in rows:
                ctx, x, n, steps = unpack_columns(r["asked"], 4)
                own.append((r["bucket"], r["chunk"], np.cumsum(ctx, dtype=np.uint64), x, n.view(np.int64), steps.view(np.int64)))
            yield from met(own, level, last, n_buckets, least, prior, divergence)

    def gather(batches):
        for rows in groups(batches, "chunk"):
            if rows[0]["chunk"] < 0:
                part, total = (np.array([sum(r[k] for r in rows)]) for k in ("part", "total"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows[0]["chunk"]]), pa.nulls(1, pa.binary()), pa.array([0]),
                     pa.array(~retained(part, total, prior, divergence))], ["chunk", f"answer{level}", "kinds", "failed"])
                continue
            columns = zip(*[unpack_columns(r["answer"], 2) for r in rows])
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[0]["chunk"]]), pa.array([pack(*map(np.concatenate, columns))], pa.binary()),
                 pa.array([sum(r["kinds"] for r in rows)]), pa.array([False])], ["chunk", f"answer{level}", "kinds", "failed"])

    parts = int(asking.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (asking.mapInArrow(ask, "bucket int, chunk long, asked binary")
            .repartition(parts, "bucket").sortWithinPartitions("bucket", "chunk")
            .mapInArrow(meet, "chunk long, bucket int, answer binary, kinds long, part long, total long")
            .repartition(parts, "chunk").sortWithinPartitions("chunk", "bucket")
            .mapInArrow(gather, f"chunk long, answer{level} binary, kinds long, failed boolean"))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, least: int = LEAST,
          prior: float = PRIOR, divergence: float = DIVERGENCE, assured: float = np.inf, dealt: int = DEALT) -> DataFrame:
    """Learn from the rows that are not held out and score all: rows ``(id,
    held_out, n_tokens, n_known, train_tokens, base_score, score)``. No context
    is ``assured`` by default."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held_out(F.col(id_col)).alias("held_out"))
    kind, parts = dict(src.dtypes)["id"], int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables, failed, cleanup = [], [], spark.conf.get(CLEANUP, "false")

    def by_chunk(rows: DataFrame) -> DataFrame:
        """Rows written in buckets of their chunk: tables that join without a shuffle."""
        name = f"kiln_lm_{uuid.uuid4().hex}"
        (rows.repartition(parts, "chunk").write.bucketBy(parts, "chunk").sortBy("chunk")
         .option("path", scratch_path(spark, "lm-chunks")).saveAsTable(name))
        tables.append(name)
        return spark.table(name)

    spark.conf.set(CLEANUP, "true")                                # every exchange is read once, by the write it is for
    try:
        state = by_chunk(chunks(src))
        sums = state.agg(F.sum("tokens").alias("tokens"), F.sum("train").alias("train")).first()
        total = sums["train"] or 0
        n_buckets = max(parts, -(-(sums["tokens"] or 0) // BUCKET_TOKENS))
        z = 1.0
        for d in range(depth + 1):
            answers = by_chunk(exchange(state, d, d == depth, n_buckets, z, least, prior, divergence, assured, dealt, list(failed)))
            if d == 0:
                z = total + 0.5 * ((answers.agg(F.sum("kinds")).first()[0] or 0) + 1)
            failed.append(np.array([-1 - r[0] for r in answers.filter("failed").select("chunk").collect()], np.int64)
                          if d else np.zeros(0, np.int64))
            state = state.join(answers.drop("kinds", "failed"), "chunk", "left")

        ids_type = to_arrow_type(src.schema["id"].dataType)

        def run(batches):
            for row, c in replayed(batches, failed, depth + 1, z, n_buckets, least, prior, assured, dealt):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], ids_type), pa.array(c.held), pa.array(c.sizes), *(pa.array(a) for a in c.sums())],
                    ["id", "held_out", "n_tokens", "n_known", "base", "own"])

        scored = _written(state.mapInArrow(run, f"id {kind}, held_out boolean, n_tokens long, n_known long, base double, "
                                                "own double"), "scores")
    finally:
        spark.conf.set(CLEANUP, cleanup)
        for name in tables:                                        # the catalog's entry; the files are the shared folder's
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return scored.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known",
                         F.lit(total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"),
                         F.col("own").alias("score"))
