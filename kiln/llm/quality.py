"""Quality rules: repetition coverage of whole texts, in numpy.

For each text, rolling hashes of several n-gram lengths find the words that
lie in an n-gram occurring twice or more in that text, and the share of the
text's characters they cover; repeated lines are measured the same way. A
text is kept if it passes the base rules (enough words, at most 30 % of its
words in repeated 8-grams) and no coverage exceeds its threshold.

Work is per text, without a shuffle. A null text counts as empty (no words:
it fails); repeated rows are judged each; an empty table gives an empty
result. Input columns travel in one struct ``doc`` and results in one struct
``quality``, so no name can clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kiln.llm.words import Words, mix, rolling, slices, text_buffer, text_of, whole, with_doc

MIN_WORDS = 20
BASE_NGRAM = 8
BASE_PERCENT = 30
#: Largest share of characters in repeated n-grams, by n (ascending).
NGRAM_SHARE = {5: 0.40, 8: 0.30, 12: 0.25}
#: Largest share of characters in lines equal to an earlier line.
LINE_SHARE = 0.30

SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

STATS = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
         ("n_repeat_words", "long"), ("ngram_share", "double"), ("line_share", "double"),
         ("base_failed", "boolean"), ("kept", "boolean")]


def _per_text(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[edges[1:]] - total[edges[:-1]]


def _repeated(w: Words, n: int, texts: np.ndarray):
    """Which words of the chosen texts lie in an n-gram that its text holds
    twice or more. Returns flags over all words."""
    covered = np.zeros(len(w.starts), bool)
    at = np.flatnonzero(texts[w.doc])
    if len(at) < n:
        return covered
    doc = w.doc[at]
    first = np.concatenate(([0], np.cumsum(np.where(texts, w.n_words, 0))))
    gram = rolling(w.hash[at], n)
    ok = whole(first, len(gram), n)
    key = mix(gram + (doc[:len(gram)].astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))
    ordered = np.sort(key[ok])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return covered
    slot = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    hit = (twice[slot] == key) & ok
    total = np.concatenate(([0], np.cumsum(hit)))
    i = np.arange(len(at))
    lo, hi = np.maximum(i - n + 1, 0), np.minimum(i + 1, len(gram))
    covered[at] = total[np.maximum(hi, lo)] - total[lo] > 0
    return covered


def _lines(raw: bytes) -> tuple[int, int, int]:
    """Repeated lines, their characters (code points), and those of all lines
    with a word; characters are counted only where a line is repeated."""
    lines = [x for x in raw.split(b"\n") if x.strip()]
    if len(set(lines)) == len(lines):
        return 0, 0, 0
    lines = [x.decode() for x in lines]
    size = sum(map(len, lines))
    seen: set[str] = set()
    n = chars = 0
    for x in lines:
        if x in seen:
            n += 1
            chars += len(x)
        else:
            seen.add(x)
    return n, chars, size


def measure(data: np.ndarray, offs: np.ndarray, min_words=MIN_WORDS, ngram_share=None, line_share=LINE_SHARE) -> dict:
    """Statistics and verdicts of a few texts."""
    shares = ngram_share or NGRAM_SHARE
    w = Words(data, offs)
    texts = len(offs) - 1
    ink = ((w.data & 0xC0) != 0x80) & ~w.space
    word_chars = _per_text(ink, w.offs)
    n_symbols = _per_text(SYMBOL[w.data], w.offs)
    chars = np.concatenate(([0], np.cumsum(ink, dtype=np.int64)))
    per_word = chars[w.ends] - chars[w.starts]

    worst = np.zeros(texts)
    over = np.zeros(texts, bool)
    repeat_words = np.zeros(texts, np.int64)
    todo = np.ones(texts, bool)             # a repeated longer n-gram holds repeated shorter ones
    for n in sorted({*shares, BASE_NGRAM}):
        covered = _repeated(w, n, todo)
        counts = _per_text(covered, w.first)
        if n == BASE_NGRAM:
            repeat_words = counts
        if n in shares:
            share = _per_text(per_word * covered, w.first) / np.maximum(word_chars, 1)
            worst = np.maximum(worst, share)
            over |= share > shares[n]
        todo &= counts > 0

    raw = w.data.tobytes()
    lines = np.array([_lines(raw[a:b]) for a, b in zip(w.offs[:-1].tolist(), w.offs[1:].tolist())],
                     np.int64).reshape(-1, 3)
    in_lines = lines[:, 1] / np.maximum(lines[:, 2], 1)
    base_failed = (w.n_words < min_words) | (100 * repeat_words > BASE_PERCENT * w.n_words)
    return {"n_words": w.n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": lines[:, 0],
            "n_repeat_words": repeat_words, "ngram_share": worst, "line_share": in_lines, "base_failed": base_failed,
            "kept": ~base_failed & ~over & ~(in_lines > line_share)}


def repetition_rules(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None,
                     min_words: int = MIN_WORDS, ngram_share: dict[int, float] | None = None,
                     line_share: float = LINE_SHARE) -> DataFrame:
    """Rows ``(doc, quality)``: ``doc`` holds the input columns (or those in
    ``carry``), ``quality`` the statistics, ``base_failed`` and ``kept``."""
    src = with_doc(docs, text_col, carry)
    doc_kind = dict(src.dtypes)["doc"]
    stats = ", ".join(f"{n}: {t}" for n, t in STATS)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offs = text_buffer(text_of(batch, text_col))
            parts = [measure(data, offs[i:j + 1], min_words, ngram_share, line_share) for i, j in slices(offs)]
            fields = [pa.array(np.concatenate([p[n] for p in parts])) for n, _ in STATS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.StructArray.from_arrays(fields, [n for n, _ in STATS])], ["doc", "quality"])

    return src.mapInArrow(run, f"doc {doc_kind}, quality struct<{stats}>")
