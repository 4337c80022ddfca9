"""Operators on texts against brute force, on odd little tables and on the
small supplied tables."""
import base64
import hashlib
import math
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from kiln.llm import byte_bpe, packing, pii, quality, simhash, substrings, suffix_lm
from kiln.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, quality string, kept int, row string"


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


@pytest.fixture(scope="module")
def odd():
    """Null, empty and very long texts, ties, repeated rows, clashing names."""
    rng = np.random.default_rng(5)
    vocab = ["alpha", "Beta", "gam-ma", "é", "ß|", "#x", "naïve", "日本", "10.0.0.1", "a@b.co", "+1 (555) 010-9999",
             "4111111111111111", "x" * 70]
    texts = [None, "", " ", "\n\n", "one", "two words", "a\x0bb\x0cc\x85d　e", "z" * 5000, "w " * 3000,
             " ".join(f"n{i}" for i in range(9000))]
    passage = " ".join(f"p{i}" for i in range(60))
    for i in range(40):
        texts.append(" ".join(rng.choice(vocab, int(rng.integers(1, 120)))))
    texts += [passage, "lead " + passage + " tail", f"lead\n{passage}\n\nother  end", texts[-1], texts[-2]]
    texts += ["same line here\n" * 8, "\n".join(f"line {i % 3} of some text" for i in range(30)),
              "near copy " + " ".join(f"q{i}" for i in range(300)), "near copy " + " ".join(f"q{i}" for i in range(301))]
    rows = [(i, t, "q", i % 2, "r") for i, t in enumerate(texts)]
    return rows + [rows[12], rows[12], (None, "no id here", None, None, None), (None, passage, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, odd):
    return spark.createDataFrame(odd, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def counted(rows):
    return Counter(tuple(r) for r in rows)


# --- 1 ---------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("chunk", [(16384, 1024), (50, 20)])
def test_bpe_round_trip(docs, odd, library, chunk):
    out = byte_bpe.decode(byte_bpe.encode(docs, chunk_chars=chunk[0], overlap=chunk[1])).collect()
    want = []
    for i, t, *_ in odd:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), struct.pack(f"<{len(ids)}I", *ids), (t or "").encode()))
    assert counted((r["doc_id"], r["n_tokens"], bytes(r["ids"]), bytes(r["decoded"])) for r in out) == counted(want)


def test_bpe_chunks_of_any_cut(library):
    import random
    rnd, enc = random.Random(3), byte_bpe.encoder()
    alphabet = [" ", "  ", "\n", "\x1c", "\x85", "\xa0", "　", "'s", "'", "a", "é", "1", "!!", "<|endoftext|>", "  \n ",
                "\t", " \n", "​", "𝔘", "ab cd"]
    for _ in range(3000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
        size, lap = rnd.choice([(5, 2), (7, 6), (12, 3)])
        chunks = [(s, text[s:s + size + lap], byte_bpe._bounds(text[s:s + size + lap], s))
                  for s in range(0, len(text), size)]
        pieces = list(byte_bpe.stitched(chunks))
        assert "".join(pieces) == text
        ids = b"".join(enc.cache[p[1:]] if k else enc.cache.first(p) for k, p in enumerate(pieces))
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == library.encode_ordinary(text)


def test_bpe_long_piece_and_cache(library, monkeypatch):
    enc = byte_bpe.Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for text in ("ab" * 3000 + "é" * 500, "x" * 20000, "=" * 999):
        assert enc.merge(text.encode()) == library.encode_ordinary(text)
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 3)
    text = " ".join(f"w{i % 7}" for i in range(200))
    assert list(struct.unpack("<" + "I" * (len(enc.encode(text)) // 4), enc.encode(text))) == library.encode_ordinary(text)


def test_bpe_same_ids_as_tokenizers(spark, sf):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").limit(40).collect()] + ["a <|endoftext|> b"]
    enc = byte_bpe.encoder()
    for text, e in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == e.ids


def test_bpe_empty_table_and_bad_overlap(empty, docs):
    assert byte_bpe.encode(empty).count() == 0
    with pytest.raises(ValueError):
        byte_bpe.encode(docs, chunk_chars=10, overlap=10)


# --- 9 ---------------------------------------------------------------------------------------------------

def check_packing(rows, texts, library, window=1024):
    by_seq, by_doc = {}, {}
    for r in rows:
        assert r["length"] == len(r["ids"]) // 4 > 0
        by_seq.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    want = Counter()
    for i, t in texts:
        ids = library.encode_ordinary(t or "") + [0]
        want[(i, struct.pack(f"<{len(ids)}I", *ids))] += 1
    got = Counter()
    for (i, n), pieces in by_doc.items():
        copies = Counter((r["start"], bytes(r["ids"])) for r in pieces)
        # equal documents may be cut differently: follow starts
        pool = sorted(copies.elements())
        while pool:
            at, ids = 0, b""
            while at < n:
                k = next(k for k, p in enumerate(pool) if p[0] == at)
                ids += pool.pop(k)[1]
                at = len(ids) // 4
            got[(i, ids)] += 1
    assert got == want
    return padding, sum(r["length"] for r in rows)


@pytest.mark.parametrize("most", [1, 32])
def test_packing(docs, odd, library, most):
    rows = packing.pack(docs.select("doc_id", "text", "kept"), open_windows=most).collect()
    padding, total = check_packing(rows, [(r[0], r[1]) for r in odd], library)
    assert padding <= total * 0.02


def test_packing_small_table(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.pack(docs).collect()
    padding, total = check_packing(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], library)
    assert padding <= total * 0.01


def test_packing_has_the_ids_of_the_library_for_added_tokens(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    e = "<|endoftext|>"
    texts = [f"a{e}b", e, f"{e}{e}", f" {e} ", f"one two {e}\n\n  three <|endoftext|", f"<|endof{e}text|>", "none at all"]
    out = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {i: b"" for i in range(len(texts))}
    for r in sorted(out, key=lambda r: r["start"]):
        got[r["doc_id"]] += bytes(r["ids"])
    for i, text in enumerate(texts):
        assert np.frombuffer(got[i], "<u4").tolist() == [*t.encode(text, add_special_tokens=False).ids, packing.END_ID], text


def test_packing_empty(empty):
    assert packing.pack(empty).count() == 0


# --- 10 --------------------------------------------------------------------------------------------------

def brute_quality(text):
    w = words(text)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = set()
    for i in range(len(w) - 7):
        if grams[tuple(w[i:i + 8])] > 1:
            hit.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit),
            len(w) < 20 or 100 * len(hit) > 30 * len(w))


def share(text, n):
    w = words(text)
    grams = Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    hit = set()
    for i in range(len(w) - n + 1):
        if grams[tuple(w[i:i + n])] > 1:
            hit.update(range(i, i + n))
    return sum(len(w[i]) for i in hit) / max(1, sum(map(len, w)))


def test_quality_rules(docs, odd):
    out = quality.repetition_rules(docs).select("doc.doc_id", "doc.text", "quality.*").collect()
    assert len(out) == len(odd)
    for r in out:
        base = brute_quality(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base
        worst = max(share(r["text"], n) for n in quality.NGRAM_SHARE)
        assert r["ngram_share"] == pytest.approx(worst)
        over = any(share(r["text"], n) > s for n, s in quality.NGRAM_SHARE.items()) or r["line_share"] > quality.LINE_SHARE
        assert r["kept"] == (not base[-1] and not over)


def test_quality_clean_texts_stay(spark, sf):
    out = QUERIES["op10_quality_rules"](spark, sf).toPandas()
    plain = out[(out.n_words >= 50) & (out.n_repeat_words == 0) & (out.n_dup_lines == 0)]
    assert len(plain) > 50 and plain.kept.all()


def test_quality_empty(empty):
    assert quality.repetition_rules(empty).count() == 0


# --- 6 ---------------------------------------------------------------------------------------------------

def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    k = min(3, len(w))
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42) for i in range(len(w) - k + 1)] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, near):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("tile", [4, 16384])
def test_simhash(docs, odd, tile, monkeypatch):
    monkeypatch.setattr(simhash.class_links, "__defaults__", (simhash.RADIUS, tile))
    out = simhash.near_duplicates(docs, carry=["doc_id", "text"]).collect()
    rows = sorted(((r["doc"]["doc_id"], r["doc"]["text"]) for r in out), key=str)
    assert rows == sorted(((r[0], r[1]) for r in odd), key=str)
    fps = [brute_fingerprint(r["doc"]["text"]) for r in out]
    assert fps == [r["fp"] % (1 << 64) for r in out]
    root = roots(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for k, r in zip(root, out):
        if r["doc"]["doc_id"] is not None:
            least[k] = min(least.get(k, 1 << 60), r["doc"]["doc_id"])
    assert [r["component_id"] for r in out] == [least.get(k) for k in root]
    chosen = Counter(k for k, r in zip(root, out) if r["representative"])
    assert set(chosen) == set(root) and max(chosen.values()) == 1
    assert all(r["doc"]["doc_id"] == r["component_id"] for r in out if r["representative"])


def test_simhash_tiles_of_random_fingerprints():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    a = np.unique(np.concatenate([base, base ^ np.uint64(1 << 9), base ^ np.uint64(0b111 << 20), base ^ np.uint64(0b1111)]))
    b = np.unique(base ^ np.uint64(1 << 60))
    u, v = simhash.tile_links(a, b, 3)
    both = [int(x) for x in np.concatenate([a, b])]
    got = {}

    def find(x):
        while got.get(x, x) != x:
            x = got[x]
        return x

    for x, y in zip(u.tolist(), v.tolist()):
        assert x in both and y in both
        got[find(x)] = find(y)
    # forests span exactly the links between the two tiles
    sides = [(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()]
    root = roots(sides, lambda p, q: p[1] != q[1] and (p[0] ^ q[0]).bit_count() <= 3)
    pairs = {(x, y) for (x, i), (y, j) in zip(sides, [sides[r] for r in root]) if (x, i) != (y, j)}
    assert all(find(x) == find(y) for x, y in pairs)


def test_simhash_empty(empty):
    assert simhash.near_duplicates(empty).count() == 0


# --- 3 ---------------------------------------------------------------------------------------------------

def brute_repeats(texts, size):
    split = [words(t) for t in texts]
    grams = Counter(tuple(w[i:i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - size + 1):
            if grams[tuple(w[i:i + size])] > 1:
                gone.update(range(i, i + size))
        out.append(([x for i, x in enumerate(w) if i not in gone], len(w), len(gone)))
    return out


@pytest.mark.parametrize("size,runs,tree", [(35, 512, 400_000), (35, 1, 50), (3, 4, 100), (1, 2, 100)])
def test_substring_dedup(docs, odd, size, runs, tree, monkeypatch):
    monkeypatch.setattr(substrings.repeats, "__defaults__", (size, substrings.GRAM, runs))
    monkeypatch.setattr(substrings, "TREE_WORDS", tree)
    out = substrings.remove_repeats(docs, window=size, carry=["doc_id", "text"]).collect()
    want = Counter((t, " ".join(k), n, g) for (_, t, *_), (k, n, g) in zip(odd, brute_repeats([r[1] for r in odd], size)))
    got = Counter((r["doc"]["text"], " ".join(words(r["text"])), r["n_words"], r["n_removed"]) for r in out)
    assert got == want
    assert all(r["text"] == (r["doc"]["text"] or "") for r in out if not r["n_removed"])


def test_substring_empty(empty):
    assert substrings.remove_repeats(empty).count() == 0


# --- 7 ---------------------------------------------------------------------------------------------------

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum((2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) if i % 2 else int(c)
               for i, c in enumerate(reversed(digits))) % 10 == 0


def brute_pii(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@pytest.fixture(scope="module")
def personal():
    import random
    rnd = random.Random(11)
    bits = ["a@b.co", "x.y+z@host-1.example.org", "@", ".", "..", "_", "a@b", "a@b.c_d@e.fr", "1.2.3.4", "300.1.2.3.4", "007.0.0.1",
            "1.2.3.4.5.6.7.8", "4111111111111111", "4111 1111 1111 1111", "4111-1111 1111-1112", "1  2345", "+1 (555) 010-9999",
            "+44 20 7946 0958", "+1+2", "+", "-", " ", "é", "𝔘", "\n", "555-0100", "00000000000000", "12345678901234567890"]
    texts = ["".join(rnd.choice(bits) + rnd.choice(["", " ", ", "]) for _ in range(rnd.randint(0, 14))) for _ in range(400)]
    return texts + [None, "", "1" * 60000, "a" * 60000 + "@", "a@" + "b." * 20000 + "c", "1 " * 30000, "+1 " * 5000]


def test_pii_base_rules(spark, personal):
    df = spark.createDataFrame(list(enumerate(personal)), "doc_id long, text string")
    out = pii.find(df, selector=pii.Selector()).collect()
    assert len(out) == len(personal)
    for r in out:
        got = [(s["start"], s["kind"], s["stop"]) for s in r["base"]]
        assert got == brute_pii(r["doc"]["text"]), r["doc"]["text"][:200]


def test_pii_base_rules_do_not_need_unrelated_characters(spark):
    texts = ["378 282 246 310 005", "3 7 8 2 8 2 2 4 6 3 1 0 0 0 5", "37-82-82-24-63-10-00-5", "+1 2 0 2 5 5 5 0 1 4 3", "+1(2)0(2)5(5)5(0)1(4)"]
    out = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), selector=pii.Selector()).collect()
    for r in out:
        assert [tuple(s) for s in r["base"]] == brute_pii(r["doc"]["text"])
    assert all(len(r["base"]) == 1 for r in out)


def test_pii_selection(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = ["tel (988) 555-2485 or mail jo (at) example (dot) org now", "+1 (988) 555-2485"]
    more = spark.createDataFrame([(10_000_000 + i, odd[i % 2], "en", "s", 1) for i in range(60)], docs.schema)
    both = docs.unionByName(more)
    selector = pii.fit(both)
    assert selector.model is not None
    out = pii.find(both, selector=selector).withColumn(
        "clean", pii.redacted(F.col("text"), F.col("spans"))).collect()
    for r in out:
        base = [tuple(s) for s in r["base"]]
        spans = [tuple(s) for s in r["spans"]]
        text = r["doc"]["text"]
        assert base == brute_pii(text) and set(base) <= set(spans) and spans == sorted(spans)
        at, clean = 0, ""
        for start, kind, stop in spans:
            if start >= at:
                clean += text[at:start] + f"[{pii.KINDS[kind].upper()}]"
            at = max(at, stop)
        assert r["clean"] == clean + text[at:]


def test_pii_adds_loose_forms_but_no_plain_numbers(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = []
    for i in range(240):
        rows += [f"mail jo{i} (at) example (dot) org. Then go", f"at 2001:0db8:85a3:0:0:8a2e:{i:x}:7334 now", f"order {9885550000 + 7 * i} done",
                 f"see you{i} (at) home now"]
    more = spark.createDataFrame([(10_000_000 + i, t, "en", "s", 1) for i, t in enumerate(rows)], docs.schema)
    selector = pii.fit(docs.unionByName(more))
    got = {r["doc"]["text"]: [(pii.KINDS[s["kind"]], r["doc"]["text"][s["start"]:s["stop"]]) for s in r["spans"]]
           for r in pii.find(more, selector=selector).collect()}
    for i in range(240):
        mail, six, number, home = rows[4 * i:4 * i + 4]
        assert got[mail] == [("email", f"jo{i} (at) example (dot) org")]
        assert got[six] == [("ip", f"2001:0db8:85a3:0:0:8a2e:{i:x}:7334")]
        assert got[number] == got[home] == []


def test_pii_thresholds_come_from_all_documents(spark):
    """Every kind that has confirmed candidates gets its threshold, however few
    documents hold them."""
    rows = [(i, f"mail a{i}@b{i}.org or me (at) noon {i}") for i in range(30_000)]
    rare = [(40_000 + i, f"host 2001:0db8:85a3:0:0:8a2e:{i + 1:x}:7334 up") for i in range(6)]
    docs = spark.createDataFrame(rows + rare, "doc_id long, text string").repartition(8)
    selector = pii.fit(docs)
    assert {pii.KINDS.index(k) for k in ("email", "ip")} <= set(selector.thresholds)
    found = pii.find(docs.filter("doc_id >= 40000"), selector=selector).collect()
    assert len(found) == 6 and all([s["kind"] for s in r["spans"]] == [pii.KINDS.index("ip")] for r in found)


def test_pii_trees_as_columns_agree_with_the_model(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 5)).round(2)
    df = spark.createDataFrame([(float(a[0] * a[1] > a[2]), a.tolist()) for a in x], "label double, f array<double>")
    train = df.withColumn("features", array_to_vector("f"))
    model = GBTClassifier(maxIter=5, maxDepth=3, seed=1).fit(train)
    out = model.transform(train).select(vector_to_array("rawPrediction")[1].alias("want"), pii._margin(model, F.col("f")).alias("got"))
    assert all(r["got"] == pytest.approx(r["want"]) for r in out.collect())


def test_pii_empty(empty):
    assert pii.find(empty).count() == 0


# --- 5 ---------------------------------------------------------------------------------------------------

def brute_base(rows):
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in tokens]
    c = Counter()
    for (_, w), h in zip(tokens, held):
        if not h:
            c.update(w)
    n, v = sum(c.values()), len(c)
    return [(i, h, len(w), sum(x in c for x in w), n,
             round(sum(math.log10((c.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6)) for (i, w), h in zip(tokens, held)]


def test_lm_base(docs, odd):
    out = suffix_lm.score(docs).collect()
    got = Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                  for r in out)
    assert got == Counter(brute_base([(r[0], r[1]) for r in odd]))
    assert all(math.isfinite(r["score"]) and r["score"] <= 1e-9 for r in out)


def test_lm_beats_word_counts_on_held_out_texts(spark, sf):
    out = QUERIES["op5_lm_score"](spark, sf).toPandas()
    held = out[out.held_out]
    assert held.score.sum() > held.base_score.sum()


def brute_tree(rows, depth, least, prior, divergence, assured):
    """``(log10 probability of each row, retained contexts, probability function)``
    of a suffix tree in dictionaries; None is the end."""
    texts = [(t or "").encode().lower().split() + [None] for _, t in rows]
    train = [w for (i, _), w in zip(rows, texts) if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1]
    words = Counter(x for w in train for x in w)
    z = sum(words.values()) + 0.5 * (len(words) + 1)

    def contexts(w, i):
        before = [None, *w[:i]]
        return [tuple(before[-d:]) for d in range(1, min(depth, len(before)) + 1)]

    seen = {}
    for w in train:
        for i, x in enumerate(w):
            for c in contexts(w, i):
                seen.setdefault(c, Counter())[x] += 1
    kept = set()

    def prob(c, x):
        while c and c not in kept:
            c = c[1:]
        if not c:
            return (words.get(x, 0) + 0.5) / z
        return (seen[c][x] + prior * prob(c[1:], x)) / (sum(seen[c].values()) + prior)

    for c in sorted(seen, key=len):
        total = sum(seen[c].values())
        told = {x: math.exp(-np.rint(-math.log(prob(c[1:], x)) * 64) / 64) for x in seen[c]}
        gain = sum(n * math.log((n + prior * told[x]) / ((total + prior) * told[x])) for x, n in seen[c].items())
        if total >= least and (total > assured or gain > divergence):
            kept.add(c)
    scores = [sum(math.log10(prob(contexts(w, i)[-1], x)) for i, x in enumerate(w)) for w in texts]
    return scores, kept, prob, words


@pytest.mark.parametrize("model", [dict(depth=3, least=2, prior=4.0, divergence=8.0, assured=10 ** 6),
                                   dict(depth=5, least=3, prior=1.5, divergence=0.5, assured=12)])
def test_lm_scores_equal_a_suffix_tree(spark, odd, model):
    """Also across chunks, and with frequent contexts dealt by the next symbol."""
    rng, follow = np.random.default_rng(6), {}
    odd = list(odd)
    for i in range(100, 112):                               # texts whose next word hangs on more than one
        w = [0, 1, 2, 0, 1]
        while len(w) < 150:
            w.append(follow.setdefault(tuple(w[-model["depth"]:]), int(rng.integers(0, 4))) if rng.random() < 0.9
                     else int(rng.integers(0, 4)))
        odd.append((i, " ".join(f"m{x}" for x in w), None, None, None))
    docs = spark.createDataFrame(odd, SCHEMA).repartition(3)
    want, kept, prob, words = brute_tree([(r[0], r[1]) for r in odd], **model)
    assert {len(c) for c in kept} == set(range(1, model["depth"] + 1))
    for c in list(kept)[::25]:
        assert sum(prob(c, x) for x in [*words, b"never seen"]) == pytest.approx(1.0)
    got = suffix_lm.score(docs, **model).collect()
    assert sorted((str(r["doc_id"]), round(r["score"], 4)) for r in got) == \
        sorted((str(r[0]), round(s, 4)) for r, s in zip(odd, want))


@pytest.mark.parametrize("dealt", [3, 7])
def test_lm_scores_do_not_depend_on_what_is_dealt(spark, dealt):
    rng = np.random.default_rng(9)
    rows = [(i, " ".join("abc"[k] if rng.random() < 0.8 else f"w{k}{rng.integers(0, 9)}" for k in rng.integers(0, 3, 40)))
            for i in range(60)]
    model = dict(depth=3, least=2, prior=4.0, divergence=8.0)
    want, kept, _, words = brute_tree(rows, assured=math.inf, **model)
    assert kept and any((w,) not in kept for w, n in words.items() if n > dealt)        # a dealt context that fails
    got = suffix_lm.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), dealt=dealt, **model).collect()
    assert sorted((r["doc_id"], round(r["score"], 6)) for r in got) == [(r[0], round(s, 6)) for r, s in zip(rows, want)]


def test_lm_tests_contexts_of_any_size(spark):
    """Two words at random: neither says anything of the next one, however often it occurs."""
    rng = np.random.default_rng(10)
    rows = [(i, " ".join("ab"[k] for k in rng.integers(0, 2, 9000))) for i in range(70)]
    want, kept, _, words = brute_tree(rows, 1, 2, 4.0, 8.0, math.inf)
    assert min(words[b"a"], words[b"b"]) > 200_000 and (b"a",) not in kept and (b"b",) not in kept
    got = suffix_lm.score(spark.createDataFrame(rows, "doc_id long, text string"), depth=1, prior=4.0).collect()
    assert sorted((r["doc_id"], round(r["score"], 4)) for r in got) == [(r[0], round(s, 4)) for r, s in zip(rows, want)]


def test_lm_learns_a_phrase_alike_in_a_larger_corpus(spark):
    """Counts decide, not shares: a phrase seen five times is learnt from 40
    texts and from 40 times as many words."""
    rng = np.random.default_rng(8)
    ids = [i for i in range(9000) if zlib.crc32(str(i).encode()) % 5 != 1]
    phrase = "one very odd phrase nobody else writes"

    def ratio(n):
        rows = [(i, " ".join(f"v{k}" for k in rng.integers(0, 300, 50))) for i in ids[:n]]
        rows[:5] = [(i, phrase) for i in ids[:5]]
        got = suffix_lm.score(spark.createDataFrame(rows, "doc_id long, text string"), prior=4.0)
        return got.filter(f"doc_id = {ids[0]}").first()["score"] / 7

    small, large = ratio(40), ratio(1600)
    assert small > -0.5 and large > -0.9                    # of the mean symbol; about -3 without contexts


def test_lm_packs_and_unpacks():
    for v in ([], [0], [1, 2 ** 63, 2 ** 64 - 1], list(range(1000))):
        v = np.array(v, np.uint64)
        assert (suffix_lm.unpack(suffix_lm.pack(v)) == v).all()
        assert (suffix_lm.unpack_sorted(suffix_lm.pack_sorted(v)) == v).all()


def test_lm_empty(empty):
    assert suffix_lm.score(empty).count() == 0


# --- digests of the registered queries -------------------------------------------------------------------

def test_registered_digests(spark, sf, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op1_byte_bpe"](spark, sf).collect():
        ids = library.encode_ordinary(docs[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((docs[r["doc_id"]] or "").encode()).hexdigest()
    for r in QUERIES["op7_pii"](spark, sf).collect():
        base = brute_pii(docs[r["doc_id"]])
        line = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == i for s in base) for i in range(4)]
    for r in QUERIES["op6_simhash"](spark, sf).collect():
        assert int(r["fingerprint"], 16) == brute_fingerprint(docs[r["doc_id"]]) and len(r["fingerprint"]) == 16
    for r in QUERIES["op9_packing"](spark, sf).limit(50).collect():
        ids = (library.encode_ordinary(docs[r["doc_id"]] or "") + [0])[r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_line_share_counts_code_points():
    text = "ééééé\nééééé\nplain line\n"
    data = np.frombuffer(text.encode(), np.uint8)
    got = quality.measure(data, np.array([0, len(data)]))
    assert got["n_dup_lines"][0] == 1 and got["line_share"][0] == 5 / 20
