"""Texts with very many spans, edits and repeats: time in proportion."""
import re
import time

import pytest
from pyspark.sql import functions as F

from kiln.llm import chat, folds, pii
from kiln.llm.queries import QUERIES


def base_time(spark, n):
    df = spark.createDataFrame([(1, "1.2.3.4 " * n)], "doc_id long, text string")
    took = []
    for _ in range(2):                               # the first run compiles
        began = time.monotonic()
        based = df.select("text", pii._base(F.col("text")).alias("b"))
        row = based.select(F.size("b").alias("n"), pii.redacted(F.col("text"), F.col("b")).alias("r"), "b").first()
        took.append(time.monotonic() - began)
    assert row["n"] == n and row["r"] == "[IP] " * n
    assert [(s["start"], s["stop"]) for s in row["b"]] == [(8 * i, 8 * i + 7) for i in range(n)]
    return min(took)


def test_base_spans_and_redaction_of_very_many_hits(spark):
    small, large = base_time(spark, 12_000), base_time(spark, 120_000)
    assert large < 30 * small + 2


def test_selected_spans_of_very_many_candidates(spark):
    text = "1.2.3.4 +1 555 010 9999 me (at) x (dot) org "
    rows = [(i, "part 4111111111111112 and 20231231555 in stock", ) for i in range(300)] + [
        (1000 + i, f"mail a{i} (at) b{i} (dot) com or call 555 0{i % 10}0 99{i % 10}9") for i in range(60)]
    df = spark.createDataFrame([*rows, (9999, text * 4000)], "doc_id long, text string")
    out = {r["doc"]["doc_id"]: r for r in pii.find(df).collect()}
    spans = [(s["start"], s["kind"], s["stop"]) for s in out[9999]["spans"]]
    assert spans == sorted(spans) and len(out[9999]["base"]) == 8000
    assert all(a[2] <= b[0] for a, b in zip(spans, spans[1:]))
    mails = [m.span() for m in re.finditer(r"me \(at\) x \(dot\) org", text * 4000)]
    assert [(a, b) for a, k, b in spans if k == 0] == mails


@pytest.mark.parametrize("size", [1, 2, 7, 2048])
def test_redaction_at_the_edges_of_parts(spark, monkeypatch, size):
    monkeypatch.setattr(folds, "PART", size)
    rows = [("𝔘é 1.2.3.4 x", [(3, 1, 10)]), ("abcdef", [(0, 0, 6)]), ("abcdef", [(0, 0, 3), (2, 1, 5)]), ("abcdef", [(0, 0, 2), (2, 1, 4)]),
            ("", []), ("ab\ncd", [(2, 3, 3)]), ("x", [])]
    df = spark.createDataFrame([(t, [{"start": a, "kind": k, "stop": b} for a, k, b in s]) for t, s in rows],
                               f"t string, s {pii.SPAN}")
    got = [r[0] for r in df.select(pii.redacted(F.col("t"), F.col("s"))).collect()]
    assert got == ["𝔘é [IP] x", "[EMAIL]", "[EMAIL]f", "[EMAIL][IP]ef", "", "ab[PHONE]cd", "x"]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 8, 50])
def test_blocked_folds_keep_order(spark, n):
    df = spark.range(1).select(F.expr(f"transform(sequence(1, {n}), x -> int(x))" if n else "array()").cast("array<int>").alias("a"))
    got = df.select(folds.folded(F.col("a"), F.lit(0), lambda at, x: (at + x, at + x), "int").alias("r")).first()["r"]
    sums = [sum(range(1, k + 1)) for k in range(1, n + 1)]
    assert list(got["out"]) == sums and got["at"] == (sums[-1] if sums else 0)


def stream(spark, n):
    """One turn of n deltas after a wrong draft, among others."""
    rows = [("message", "assistant", "wrong")] + [("delta", None, f"x{i} ") for i in range(5)] + [("regenerate", None, None)]
    rows += [("delta", None, f"{i} ") for i in range(n)]
    log = [(1, 0, -1, "message", "user", "go")] + [(1, 1, i, k, r, t) for i, (k, r, t) in enumerate(rows)]
    df = spark.createDataFrame(log, "conv_id int, turn int, seq int, kind string, role string, text string")
    took = []
    for _ in range(2):
        began = time.monotonic()
        row = chat.render(chat.conversations(df)).first()
        took.append(time.monotonic() - began)
    assert [tuple(m) for m in row["messages"]] == [("user", "go"), ("assistant", "".join(f"{i} " for i in range(n)))]
    return min(took)


def test_deltas_fold_in_proportion(spark):
    assert stream(spark, 48_000) < 12 * stream(spark, 6_000) + 2


def test_masks_of_very_many_turns(spark):
    df = spark.range(6000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                  F.concat(F.lit("say <| "), F.col("id").cast("string")).alias("text"))
    out = chat.render(chat.conversations(df, seq_col=None, kind_col=None))
    row = out.select(chat.under_mask(F.col("formatted"), F.col("loss_mask")).alias("loss"), F.size(chat.parsed(F.col("formatted"))).alias("n")).first()
    assert row["n"] == 6000 and row["loss"] == "".join(f"say <| {i}" for i in range(1, 6000, 2))


def test_query_folds_events(spark, tmp_path):
    """The query's log has every kind of event, and folds back to the rows."""
    from kiln.llm import queries
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {c} {t} " * (t * 9)) for c in range(12) for t in range(7)]
    rows += [(50, 1, "user", "twice"), (50, 1, "user", "twice"), (50, 1, "assistant", "𝔘é " * 50), (50, None, None, None), (None, 1, "tool", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    log = queries.event_log(df)
    assert {r[0] for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate"}
    got = {r["conv"]: [tuple(m) for m in r["messages"]] for r in chat.conversations(log.repartition(5)).collect()}
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert got == want
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    plan = QUERIES["op2_chat_format"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
