"""Secrets: rules for known forms plus a token-efficiency test.

*Base rules* find assignments to telling names, access-key ids and long runs of
hex digits. Each pattern is linear in the text; what a rule then refuses (too
short) is dropped and not tried again from another start.

*Token efficiency.* A byte-pair vocabulary learnt from text spends few tokens on
anything like text and many on random characters. Every run of at least
``CANDIDATE`` characters of the base64 and URL alphabets that mixes letter cases
or letters and digits is encoded with a public vocabulary; at most ``RATIO``
characters per token make it a secret. Excluded first are the random-looking
strings that are no secrets: *known digests* (hex of the lengths of MD5 and the
SHA family, ``sha256-`` and similar integrity values) and *identifiers* (UUIDs,
numbers, time stamps, hex colours and addresses of the form ``0x...``, names
whose parts are words). A candidate that meets a base span is not added.

Work is per text, without a shuffle. Null text counts as empty: no spans. Very
long texts take time in proportion; a run of any length is encoded whole.
Repeated rows are judged each; an empty table gives an empty result. Input
columns travel in the struct ``doc``, so no name can clash. Offsets are code
points, end exclusive; spans are ordered by start, then kind as in ``KINDS``.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.byte_bpe import encoder
from kiln.llm.words import text_of, with_doc

KINDS = ["assign", "access", "hex", "random"]
#: Least characters of a candidate and of the base rules' matches.
CANDIDATE = 16
ASSIGNED, ACCESS, HEX = 6, 20, 24
#: Most characters per token of a random string. Random hex has 1.2 to 1.9,
#: random base64 1.2 to 1.7, lower-case words 2 to 6.
RATIO = 2.2

ASSIGN = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
KEY_ID = re.compile(r"AKIA[A-Z0-9]+")
DIGITS = re.compile(r"(?<![0-9a-f])[0-9a-f]{%d,}+" % HEX)
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+={0,2}"
#: Digests and identifiers, matched against the whole candidate.
KNOWN = re.compile("|".join([
    r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})",
    r"(?:[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{56}|[0-9A-F]{64}|[0-9A-F]{96}|[0-9A-F]{128})",
    r"(?:sha(?:1|256|384|512)|md5)-[A-Za-z0-9+/_-]+={0,2}",
    r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
    r"[0-9+/_-]+",
    r"[0-9]{4}-?[0-9]{2}-?[0-9]{2}[T_-][0-9]{2}-?[0-9]{2}-?[0-9]{2}Z?",
    r"0x[0-9A-Fa-f]+",
    r"[A-Za-z]?[a-z]*(?:[+/_-]+[A-Za-z]?[a-z]*)*[0-9]{0,4}",
    r"[A-Z]+(?:[+/_-]+[A-Z]+)*[0-9]{0,4}",
]))


def mixed(s: str) -> bool:
    """Letters and digits, or capitals after small letters twice or more."""
    if any(c.isdigit() for c in s):
        return any(c.isalpha() for c in s)
    return sum(a.islower() and b.isupper() for a, b in zip(s, s[1:])) >= 2


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, stop)`` of the base rules."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGNED]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in KEY_ID.finditer(text) if m.end() - m.start() >= ACCESS]
    out += [(m.start(), 2, m.end()) for m in DIGITS.finditer(text)]
    return sorted(out)


def random_spans(text: str, taken: list[tuple[int, int, int]], run: re.Pattern, ratio: float, encode) -> list:
    """Random strings of ``text`` that meet none of the spans ``taken``."""
    starts, reach, far = [s for s, _, _ in taken], [], 0
    for _, _, stop in taken:
        far = max(far, stop)
        reach.append(far)
    out = []
    for m in run.finditer(text):
        s = m.group()
        if not mixed(s) or KNOWN.fullmatch(s):
            continue
        before = bisect_right(starts, m.end() - 1)
        if before and reach[before - 1] > m.start():
            continue
        if len(s) <= ratio * (len(encode(s)) // 4):
            out.append((m.start(), 3, m.end()))
    return out


def scan(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, candidate: int = CANDIDATE,
         ratio: float = RATIO, ranks_path: str | None = None) -> DataFrame:
    """Rows ``(doc, base, spans)``: the input columns (or those in ``carry``),
    the spans of the base rules, and all spans."""
    src = with_doc(docs, text_col, carry)
    span = "array<struct<start:int,kind:int,stop:int>>"
    arrow = pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "kind", "stop")]))

    def listed(rows):
        return pa.array([[{"start": a, "kind": k, "stop": b} for a, k, b in r] for r in rows], arrow)

    def run(batches):
        enc, runs = encoder(ranks_path).encode, re.compile(RUN % candidate)
        for batch in batches:
            base, spans = [], []
            for value in text_of(batch, text_col):
                text = value.as_py() or ""
                own = base_spans(text)
                base.append(own)
                spans.append(sorted(own + random_spans(text, own, runs, ratio, enc)))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), listed(base), listed(spans)], ["doc", "base", "spans"])

    return src.mapInArrow(run, f"doc {dict(src.dtypes)['doc']}, base {span}, spans {span}")


def labelled(spans: str) -> Column:
    """``kind:start:stop`` of all spans of a column, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["stop"])), ",")
