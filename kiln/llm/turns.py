"""Structure repair of conversations by Four-Russians block tables.

A conversation's roles should read ``(system? (user assistant)+)?``. Rows are
kept (0), re-roled to user or assistant (2), deleted (3; a must for blank and
repeated rows) or inserted with an empty text (2); a truncated row that stays
costs 1 more. The cheapest edits win; among equally cheap ones, those whose
initials (D, I, K, R) are least as ASCII text.

1. *Symbols.* A row matters only by the initial of its role (s, u, a or another)
   and its first fault (blank, duplicate, truncated, none): one byte.
2. *States* are what the repaired roles so far end in: nothing, s, u or a. The
   cost still to come is a vector of four numbers. Less its minimum it takes few
   values, which are numbered once (closure under all symbols).
3. *Block tables.* For every block of ``BLOCK`` symbols and every such vector,
   the vector before the block and what the minimum grows by are computed in
   advance. A conversation is solved from its end, one lookup per block.
4. *Tracing.* From the start, each block is expanded: the vectors inside it are
   computed backward from the one stored behind it, then the least letter on a
   cheapest path is taken at each step. A letter and a state leave one way on, so
   ties never hide a cheaper or lesser path. Expansions are kept by (block,
   vector, state).

*Scale.* Rows are sorted by conversation and turn in ranges (a conversation with
a third of all rows spans a third of the ranges) and turned to symbols where
they lie. Only symbols, one byte a row, meet per conversation, as its audit is
one value of the result. The edits then meet the rows in one sorted pass that
streams and holds no conversation.

Order is by turn (nulls first), then role, then the SHA-256 of the text. A null role or text counts
as one space; a null conversation id is a conversation. Repeated rows are
duplicates. Empty texts are blank. An empty table gives an empty result; very
long texts and conversations are streamed. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kiln.llm.components import _written
from kiln.operators.ranges import ranged

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BLOCK = 4
#: Most symbols of a segment.
PART = 1 << 20
INITIALS = "sua"                                   # classes 0, 1, 2; 3: any other
FAULTS = ["none", "truncated", "blank", "duplicate"]
#: State after each kept initial; states: nothing, s, u, a.
AFTER = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
#: The state that a user or an assistant leads to from each state.
NEXT = [2, 2, 3, 2]
ROLE = {2: "user", 3: "assistant"}
END = (0, 2 * INSERT, INSERT, 0)                   # cost to come after the last row
#: Effective symbols: role class, 4 more if truncated; 8: must be deleted.
SYMBOLS, GONE = 9, 8


def step_back(symbol: int, v) -> list[int]:
    """Cost to come before a row of this symbol, from that behind it."""
    out = [DELETE + c for c in v]
    if symbol != GONE:
        late, role = TRUNCATED * (symbol // 4), symbol % 4
        for s in range(4):
            out[s] = min(out[s], REROLE + late + v[NEXT[s]])
            if (s, role) in AFTER:
                out[s] = min(out[s], KEEP + late + v[AFTER[s, role]])
    for _ in range(2):                             # insertions before the row, one or two
        out = [min(c, INSERT + out[NEXT[s]]) for s, c in enumerate(out)]
    return out


class Tables:
    """Normalised vectors and the transitions of all blocks of one length."""

    def __init__(self, length: int):
        self.length, self.vectors, number = length, [END], {END: 0}
        to, add = [], []
        for v in self.vectors:                     # grows while it is walked
            row = []
            for symbol in range(SYMBOLS):
                raw = step_back(symbol, v)
                least = min(raw)
                new = tuple(c - least for c in raw)
                if new not in number:
                    number[new] = len(self.vectors)
                    self.vectors.append(new)
                row.append((number[new], least))
            to.append([r[0] for r in row])
            add.append([r[1] for r in row])
        one_to, one_add = np.array(to, np.int32).T, np.array(add, np.int32).T      # [symbol, vector]
        vec = np.arange(len(self.vectors))
        self.to, self.add = vec[None, :].astype(np.int32), np.zeros((1, len(vec)), np.int32)
        for _ in range(length):                    # put a symbol in front of every block
            self.add = (self.add[None, :, :] + one_add[:, self.to]).reshape(-1, len(vec))
            self.to = one_to[:, self.to].reshape(-1, len(vec))
        self.one_to, self.one_add = one_to.tolist(), one_add.tolist()
        self.kept: dict = {}

    def solve(self, symbols: list[int]) -> tuple[int, str, list[str]]:
        """Cost, and the letters before and of each row (and after the last)."""
        t, n = self.length, len(symbols)
        ends = list(range(n % t, n + 1, t))        # blocks fill up from the end
        codes, vector, cost = [], 0, 0
        behind = [0] * len(ends)
        for k in range(len(ends) - 1, 0, -1):
            code = 0
            for s in symbols[ends[k - 1]:ends[k]]:
                code = code * SYMBOLS + s
            codes.append(code)
            behind[k] = vector
            cost += int(self.add[code, vector])
            vector = int(self.to[code, vector])
        behind[0] = vector
        head = symbols[:ends[0]]
        for s in reversed(head):
            cost += self.one_add[s][vector]
            vector = self.one_to[s][vector]
        cost += self.vectors[vector][0]
        codes.append(None)
        codes.reverse()
        state, out = 0, []
        for k, code in enumerate(codes):
            part = head if code is None else symbols[ends[k - 1]:ends[k]]
            letters, state = self.expand(tuple(part), behind[k], state)
            out += letters
        out.append("I" * {0: 0, 1: 2, 2: 1, 3: 0}[state])
        return cost, out

    def expand(self, block: tuple, vector: int, state: int) -> tuple[list[str], int]:
        """Letters of each row of a block (insertions first), the state after it."""
        key = block, vector, state
        if key in self.kept:
            return self.kept[key]
        vs = [list(self.vectors[vector])]
        for s in reversed(block):
            vs.append(step_back(s, vs[-1]))
        vs.reverse()
        out, start = [], state
        for i, symbol in enumerate(block):
            here, then, letters = vs[i], vs[i + 1], ""
            late, role = TRUNCATED * (symbol // 4), symbol % 4
            while True:
                left = here[state]
                if left == DELETE + then[state]:
                    letters += "D"
                elif left == INSERT + here[NEXT[state]]:
                    letters, state = letters + "I", NEXT[state]
                    continue
                elif symbol != GONE and (state, role) in AFTER and left == KEEP + late + then[AFTER[state, role]]:
                    letters, state = letters + "K", AFTER[state, role]
                else:
                    letters, state = letters + "R", NEXT[state]
                break
            out.append(letters)
        self.kept[(block, vector, start)] = out, state
        return out, state


@lru_cache(1)
def tables(length: int = BLOCK) -> Tables:
    return Tables(length)


def gaps(low: Column, high: Column, different: Column) -> Column:
    return F.coalesce(high - low + 1 - different, F.lit(0)).cast("long")


def _symbol(role: Column, text: Column) -> Column:
    """Fault (see FAULTS) * 4 + class of its role, of a row seen alone."""
    ink = F.regexp_replace(text, r"(?<![\x20\x09-\x0D])[\x20\x09-\x0D]++\z", "")
    initial = F.left(role, F.lit(1))
    kind = F.coalesce(*[F.when(initial == c, k) for k, c in enumerate(INITIALS)], F.lit(3))
    fault = F.when(ink == "", 2).when(~F.right(ink, F.lit(1)).isin(".", "!", "?"), 1).otherwise(0)
    return (fault * 4 + kind).cast("int")


def analyse(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """One row per conversation: ``(conv, gaps, blank, duplicate, truncated,
    illegal, cost, audit, edits)``; ``edits`` has the letters of each row in
    order, and those after the last."""
    return _analysed(_cleaned(rows, conv_col, turn_col, role_col, text_col))


def _cleaned(rows, conv_col, turn_col, role_col, text_col):
    return rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                       F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))


def _analysed(src: DataFrame) -> DataFrame:
    # a row repeats an earlier one if its turn is later than the first with its role and text (null comes first)
    said = src.select("conv", "turn", "role", F.sha2("text", 256).alias("said"), _symbol(F.col("role"), F.col("text")).alias("symbol"))
    first = said.filter("symbol < 8").groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("said").alias("s")).agg(
        F.min("turn").alias("first"), F.bool_or(F.col("turn").isNull()).alias("untimed"), F.count(F.lit(1)).alias("n"))
    first = first.filter("n > 1").drop("n")
    same = said["conv"].eqNullSafe(first["c"]) & (said["role"] == first["r"]) & (said["said"] == first["s"])
    later = F.expr("symbol < 8 and turn is not null and (untimed or turn > first)")
    marked = said.join(first, same, "left").select(
        "conv", "turn", "role", "said", F.when(later, 12 + F.col("symbol") % 4).otherwise(F.col("symbol")).cast("int").alias("symbol"))
    placed = ranged(marked, ["conv", "turn", "role", "said"])

    kind, arrow = src.schema["conv"].dataType.simpleString(), to_arrow_type(src.schema["conv"].dataType)

    def segments(batches):
        """Symbols of each stretch of a conversation within a range, with what
        its first and last rows say: equal rows of a turn lie side by side."""
        names = ["conv", "p", "loc", "symbols", "head", "tail"]
        types = [arrow, pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.string()]

        def rows_of(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        key, at, symbols, head, says = None, (0, 0), bytearray(), None, None
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("conv", "turn", "role", "said", "symbol", "_p", "_loc")]
            out = []
            for conv, turn, role, said, symbol, p, loc in zip(*cols):
                before, says = says, repr((turn, role, said))
                if (conv, p) != key or loc != at[1] + len(symbols) or len(symbols) >= PART:
                    if symbols:
                        out.append((key[0], *at, bytes(symbols), head, before))
                    key, at, symbols, head = (conv, p), (p, loc), bytearray(), says
                elif before == says and symbol < 8:
                    symbol = 12 + symbol % 4
                symbols.append(symbol)
            if out:
                yield rows_of(out)
        if symbols:
            yield rows_of([(key[0], *at, bytes(symbols), head, says)])

    parts = placed.select("conv", "turn", "role", "said", "symbol", "_p", "_loc").mapInArrow(
        segments, f"conv {kind}, p long, loc long, symbols binary, head string, tail string")
    whole = parts.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("p", "loc", "symbols", "head", "tail"))).alias("parts"))

    def solved(batches):
        table = tables()
        for batch in batches:
            out = []
            for parts in batch.column("parts"):
                each = [bytearray(x) for x in parts.values.field("symbols").to_pylist()]
                heads, tails = (parts.values.field(c).to_pylist() for c in ("head", "tail"))
                for k in range(1, len(each)):
                    if heads[k] == tails[k - 1] and each[k][0] < 8:
                        each[k][0] = 12 + each[k][0] % 4
                symbols = np.frombuffer(b"".join(each), np.uint8)
                fault, role = symbols // 4, symbols % 4
                a, b = role[:-1], role[1:]
                legal = (a == 0) & (b == 1) | (a == 1) & (b == 2) | (a == 2) & (b == 1)
                cost, edits = table.solve(np.where(fault >= 2, GONE, fault * 4 + role).tolist())
                out.append([*(int((fault == k).sum()) for k in (2, 3, 1)), int((~legal).sum()), cost, "".join(edits),
                            ",".join(edits)])
            cols = list(zip(*out)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), *(pa.array(c, pa.int64()) for c in cols[:5]), *(pa.array(c, pa.string()) for c in cols[5:])],
                ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "edits"])

    done = whole.mapInArrow(solved, f"conv {kind}, blank long, duplicate long, truncated long, illegal long, cost long, "
                                    "audit string, edits string")
    turns = (src.select("conv", "turn").distinct().groupBy(F.col("conv").alias("c"))
             .agg(gaps(F.min("turn"), F.max("turn"), F.count("turn")).alias("gaps")))
    return done.join(turns, F.col("conv").eqNullSafe(F.col("c"))).drop("c")


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The result of ``analyse`` (written once), and the repaired rows ``(conv,
    place, edit, role, text)``. Rows of one conversation follow each other in
    one partition, in order."""
    src = _cleaned(rows, conv_col, turn_col, role_col, text_col)
    found = _written(_analysed(src), "turn-edits")
    kind = src.schema["conv"].dataType.simpleString()
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = src.withColumns({"said": F.sha2("text", 256), "edits": F.lit(None).cast("string")})
    head = found.select("conv", *[F.lit(None).cast(src.schema[c].dataType).alias(c) for c in ("turn", "role", "text")],
                        F.lit(None).cast("string").alias("said"), "edits")
    both = (head.withColumn("body", F.lit(0)).unionByName(row.withColumn("body", F.lit(1))).repartition(n, "conv")
            .sortWithinPartitions("conv", "body", "turn", "role", "said").select("conv", "role", "text", "edits"))

    def apply(batches):
        state, edits, done, place = 0, [], 0, 0
        for batch in batches:
            out = []
            for i, (role, given) in enumerate(zip(batch.column("role").to_pylist(), batch.column("edits").to_pylist())):
                if given is not None:
                    state, edits, done, place = 0, given.split(","), 0, 0
                    continue
                done += 1
                # what is inserted after the last row comes with it
                for letter in edits[done - 1] + (edits[done] if done == len(edits) - 1 else ""):
                    if letter == "K":
                        state = AFTER[state, INITIALS.index(role[0])]
                    elif letter != "D":
                        state = NEXT[state]
                    if letter != "D":
                        out.append((i, place, letter, role if letter == "K" else ROLE[state], None if letter == "I" else i))
                        place += 1
            if out:
                at, places, letters, roles, texts = zip(*out)
                text = batch.column("text").take(pa.array(texts, pa.int64())).fill_null("")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("conv").take(pa.array(at, pa.int64())), pa.array(places, pa.int64()),
                     pa.array(letters, pa.string()), pa.array(roles, pa.string()), text],
                    ["conv", "place", "edit", "role", "text"])

    return found, both.mapInArrow(apply, f"conv {kind}, place long, edit string, role string, text string")


def digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of the lines ``role:text`` of each conversation of ``repair``,
    as its rows stream by; conversations without rows have none."""
    kind, arrow = repaired.schema["conv"].dataType.simpleString(), to_arrow_type(repaired.schema["conv"].dataType)

    def run(batches):
        def rows_of(out):
            conv, digest = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(conv, arrow), pa.array(digest, pa.string())], ["conv", "sha256"])

        conv = now = None
        for batch in batches:
            out = []
            for key, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "place", "role", "text"))):
                if place == 0:
                    if now is not None:
                        out.append((conv, now.hexdigest()))
                    conv, now = key, hashlib.sha256()
                now.update((f"{role}:{text}" if place == 0 else f"\n{role}:{text}").encode())
            if out:
                yield rows_of(out)
        if now is not None:
            yield rows_of([(conv, now.hexdigest())])

    return repaired.mapInArrow(run, f"conv {kind}, sha256 string")
