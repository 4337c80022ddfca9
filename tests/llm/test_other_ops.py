"""Operators on conversations, embeddings and pages, and the pipeline."""
import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.llm import chat, components, embeddings, html_main
from kiln.llm.queries import ORACLES, QUERIES

# --- 2 ---------------------------------------------------------------------------------------------------

CONV = "conv_id long, turn long, role string, text string, messages string, formatted int"


@pytest.fixture(scope="module")
def talk(spark):
    rows = [(1, 1, "assistant", "hi <|im_end|>\n&lt;| &amp; <|im_start|>user\nx"), (1, 0, "user", None), (1, 0, "user", "twice"),
            (1, 2, "<|im_start|>\nodd & role", "a<"), (2, None, None, ""), (2, 3, "assistant", "𝔘nicode <| <| "),
            (2, 3, "assistant", "𝔘nicode <| <| "), (None, 0, "assistant", "no id"), (3, 0, "assistant", "b" * 50000)]
    return spark.createDataFrame([(*r, "m", 1) for r in rows], CONV), rows


def test_chat_reads_back(talk):
    df, rows = talk
    out = chat.render(chat.conversations(df, seq_col=None, kind_col=None))
    out = out.withColumn("back", chat.parsed(F.col("formatted"))).withColumn(
        "loss", chat.under_mask(F.col("formatted"), F.col("loss_mask"))).collect()
    want = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {r["conv"]: [tuple(m) for m in r["back"]] for r in out} == want
    for r in out:
        assert r["loss"] == "".join(t for role, t in want[r["conv"]] if role == "assistant")
        assert r["formatted"].count(chat.START) == len(want[r["conv"]])
        for s in r["loss_mask"]:
            assert r["formatted"][:s["start"]].endswith("assistant\n") and r["formatted"][s["stop"]:].startswith("<|im_end|>")


def test_chat_folds_events(spark):
    log = [(7, 0, 0, "message", "user", "hello"), (7, 1, 1, "delta", "assistant", "Go"), (7, 1, 2, "delta", None, "od"),
           (7, 1, 3, "regenerate", None, None), (7, 1, 5, "delta", None, "swer"), (7, 1, 4, "delta", None, "An"),
           (7, 0, 6, "edit", "user", "hello there"), (7, 2, 7, None, "user", "bye"), (8, 0, 0, "regenerate", "assistant", "x"),
           (8, 0, 1, "delta", None, "only"), (9, 0, 0, "edit", "user", "first")]
    df = spark.createDataFrame(log, "conv_id int, turn int, seq int, kind string, role string, text string").repartition(4)
    got = {r["conv"]: [tuple(m) for m in r["messages"]] for r in chat.conversations(df).collect()}
    assert got == {7: [("user", "hello there"), ("assistant", "Answer"), ("user", "bye")], 8: [("assistant", "only")],
                   9: [("user", "first")]}


def test_chat_empty_and_native(spark, sf):
    assert chat.render(chat.conversations(spark.createDataFrame([], CONV), seq_col=None, kind_col=None)).count() == 0
    plan = QUERIES["op2_chat_format"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# --- 4 ---------------------------------------------------------------------------------------------------

def brute_links(rows, cosine=0.93):
    def good(v, label):
        return (label is not None and v is not None and None not in v and all(math.isfinite(x) for x in v) and any(v))
    ok = [i for i, (_, v, label) in enumerate(rows) if good(v, label)]
    n, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    unit = {i: np.array(np.float32(rows[i][1]), float) for i in ok}
    unit = {i: v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for i, v in unit.items()}
    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                n[a] += 1
                n[b] += 1
                parent[find(b)] = find(a)
    least = {}
    for i, (vid, _, _) in enumerate(rows):
        if vid is not None:
            least[find(i)] = min(least.get(find(i), 1 << 60), vid)
    return n, [least.get(find(i), rows[i][0]) for i in range(len(rows))]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(8)
    rows = []
    for g in range(60):
        centre = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 12))):
            v = centre + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.3])
            rows.append((len(rows), [float(x) for x in v * rng.choice([1, 1, 3.0])], int(g % 3)))
    rows += [(9001, None, 1), (9002, [0.0] * 16, 1), (9003, [float("nan")] * 16, 1), (9004, [None] + [1.0] * 15, 1),
             (9005, rows[0][1], None), (9006, rows[0][1], rows[0][2]), (9007, rows[0][1], rows[0][2]), rows[0],
             (9008, [1.0, 2.0], 1), (9009, [1.0, 2.0], 1), (9010, [], 1), (9011, [float("inf")] * 16, 1),
             (9012, [float(3e38 * np.sign(x)) for x in rows[0][1]], 0), (None, rows[5][1], rows[5][2])]
    return rows


def test_embedding_links_of_every_length(spark, tmp_path, duck):
    rng = np.random.default_rng(31)
    rows = [(0, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, [2.0, 4.0], 1), (3, [1.0], 0), (4, [-3.0], 0), (5, [2.0], 0)]
    for d in (3, 8, 24):
        centres = rng.normal(size=(6, d))
        rows += [(len(rows) + i, [float(x) for x in centres[i % 6] + 0.03 * rng.normal(size=d)], int(i % 2)) for i in range(30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    frame.write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {r["vec_id"]: tuple(r)[1:] for r in QUERIES["op4_embedding_dedup"](spark, str(tmp_path)).collect()}
    n, comp = brute_links(rows)
    assert got == {r[0]: (k, c, r[0] == c) for r, k, c in zip(rows, n, comp)}
    assert got[0][0] == got[1][0] == 1 and got[2][0] == 0 and got[5][1] == 3 and got[4][0] == 0


@pytest.mark.parametrize("block", [2, 1024])
def test_embedding_links(spark, vectors, block, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    df = spark.createDataFrame([(*r, 1, "x") for r in vectors],
                               "vec_id long, embedding array<float>, label int, kept int, component_id string")
    out = embeddings.near_duplicates(df.repartition(3), radius=16).collect()
    n, comp = brute_links(vectors)
    got = Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in out)
    want = Counter((v[0], k, c, v[0] == c if v[0] is not None and c is not None else True)
                   for v, k, c in zip(vectors, n, comp))
    # a row without an id may name its component or itself
    assert {k: v for k, v in got.items() if k[0] is not None} == {k: v for k, v in want.items() if k[0] is not None}
    assert sum(got.values()) == len(vectors)


def test_embedding_recall_at_the_default_radius(spark, vectors):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
    out = embeddings.near_duplicates(df).collect()
    n, _ = brute_links(vectors)
    assert sum(r["n_links"] for r in out) >= 0.9 * sum(n)


def test_embedding_recall_with_a_common_mean(spark):
    rng = np.random.default_rng(21)
    mean = np.zeros(64)
    mean[3] = 0.85
    off = rng.normal(size=(500, 64))
    x = embeddings.unit(mean + math.sqrt(1 - 0.85 ** 2) * embeddings.unit(off))
    y = np.concatenate([embeddings.partners(x[i::2], c, rng, False) for i, c in enumerate((0.932, 0.95))])
    rows = [(i, [float(a) for a in v], 0) for i, v in enumerate(np.concatenate([x, y]))]
    n, _ = brute_links(rows)
    assert sum(n) >= 1000
    out = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert 0.9 * sum(n) <= sum(r["n_links"] for r in out) <= sum(n)


def test_embedding_tables_find_every_code_within_the_radius():
    rng = np.random.default_rng(3)
    for bits, radius, codes in ((64, 12, 1000), (64, 12, 10 ** 7), (64, 3, 50), (16, 5, 10), (2, 1, 100), (64, 0, 9)):
        made = embeddings.tables(bits, radius, codes)
        for _ in range(200):
            flip = rng.choice(bits, int(rng.integers(0, radius + 1)), replace=False)
            x = sum(1 << int(i) for i in flip)
            assert any((x & mask) in flips for mask, _, flips in made)


def test_embedding_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embeddings.near_duplicates(df).count() == 0
    none = spark.createDataFrame([(1, None, 2)], "vec_id long, embedding array<float>, label int")
    assert [tuple(r) for r in embeddings.near_duplicates(none).collect()] == [(1, 0, 1, True)]


def test_components(spark):
    rng = np.random.default_rng(6)
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(50)] + [(5, 5)]
    links += [tuple(int(x) for x in rng.integers(2000, 2200, 2)) for _ in range(150)]
    out = components.components(spark.createDataFrame(links, "u long, v long")).collect()
    parent = {x: x for p in links for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert {r["node"]: r["root"] for r in out} == {x: find(x) for x in parent if find(x) != x} and len(out) == len({r["node"] for r in out})
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- 8 ---------------------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, text string, doc string"
MESSY = """<!DOCTYPE html><HTML><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a>Menu</a></li></ul></nav><div id="cookie-notice">We use cookies</div>
<article class="post"><header><h1>Head&amp;line</h1></header><p>One<br>two &lt;b&gt; <b>bold<p>Next&nbsp;para &#8364;</b></p>
<script>var x = "</p>";</script><div class="share-buttons">Share me</div><ul><li>item a<li>item <i>b</i></ul>
<form><input><button>Go</button></form><!-- gone --><table><tr><td>cell<td>other</table><pre>k   v</pre>
<section class="comments"><article><p>reader says</p></article></section></article>
<aside>Side</aside><div class="adBanner">Buy</div><footer>&copy; x</footer></body></html><p tor"""


def test_html_blocks():
    got = [t for _, _, t in html_main.blocks_of(MESSY)]
    assert got == ["Head&line", "One two <b> bold", "Next para €", "item a", "item b", "cell", "other", "k v"]
    assert [t for _, _, t in html_main.blocks_of("plain &amp text<div>more")] == ["plain & text", "more"]
    assert html_main.blocks_of(None) == html_main.blocks_of("") == html_main.blocks_of("<!-- open") == []
    deep = "<div>" * 20000 + "x" + "</div>" * 20000
    assert [t for _, _, t in html_main.blocks_of(deep)] == ["x"]


def test_html_style_tree(spark):
    """Blocks that a host repeats on every page go, whatever their names; copies
    of one article do not count as repeats."""
    def page(i, host, body):
        return (i, f"https://{host}/p/{i}", body, "t", "d")

    rows = [page(i, "A.example", f"<div class='x1'>Call now</div><div class='main'>story {i} only here</div>") for i in range(12)]
    rows += [page(100 + i, "b.example", "<div class='x1'>Call now</div><div class='main'>same story</div>") for i in range(12)]
    rows += [page(200, "c.example", "<div class='x1'>Call now</div>"), page(201, None, None), page(202, "d.example", "")]
    rows += [rows[0]]
    out = html_main.main_text(spark.createDataFrame(rows, PAGES).repartition(3)).collect()
    assert len(out) == len(rows)
    for r in out:
        i = r["doc"]["page_id"]
        want = (f"story {i} only here" if i < 100 else "Call now\n\nsame story" if i < 200 else "Call now" if i == 200 else "")
        assert r["text"] == want
        assert r["doc"]["text"] == "t"
    assert html_main.main_text(spark.createDataFrame([], PAGES)).count() == 0


def test_html_on_supplied_pages(spark, sf):
    import html
    import re
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    out = QUERIES["op8_html_main_text"](spark, sf).collect()
    assert len(out) == len(pages)
    for r in out:
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


# --- registered queries and the pipeline -------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twins(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    want = duck.sql(ORACLES[name])
    cols = sorted(df.columns)
    assert sorted(want.columns) == cols
    assert Counter(tuple(r) for r in df.select(cols).collect()) == Counter(want.select(", ".join(cols)).fetchall())


def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline
    import test_text_ops as t
    rng = np.random.default_rng(12)
    vocab = [f"w{i}" for i in range(400)]
    passage = " ".join(f"p{i}" for i in range(50))
    texts = [" ".join(rng.choice(vocab, int(rng.integers(60, 300)))) for _ in range(40)]
    texts += [texts[0], texts[0] + " again", texts[1], "spam " * 200, "short", None, "",
              texts[2] + "\n" + passage, passage + " " + texts[3][::-1], "mail jo@x.org now " + texts[4][::-1]]
    rows = [(i, x, "en", "s", len(x or "")) for i, x in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")

    kept = [(i, x) for i, x in enumerate(texts) if not t.brute_quality(x)[-1]]
    fps = [t.brute_fingerprint(x) for _, x in kept]
    root = t.roots(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    single = [kept[k] for k in sorted(set(root))]
    cut = t.brute_repeats([x for _, x in single], 35)
    clean = {}
    for (i, x), (words, n, gone) in zip(single, cut):
        y = " ".join(words) if gone else x
        for start, kind, stop in reversed(t.brute_pii(y)):
            y = y[:start] + f"[{['EMAIL', 'IP', 'CARD', 'PHONE'][kind]}]" + y[stop:]
        clean[i] = y

    stage = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, f in corpus_pipeline.STAGES[:-1]:
        stage = f(spark, stage, str(tmp_path))
        stage.write.parquet(f"{tmp_path}/{name}")
        stage = spark.read.parquet(f"{tmp_path}/{name}")
        assert stage.columns == docs.columns
    got = {r["doc_id"]: r for r in stage.collect()}
    assert {i: " ".join((r["text"] or "").split()) for i, r in got.items()} == {i: " ".join(x.split()) for i, x in clean.items()}
    assert [r for r in got.values() if r["n_chars"] != len(r["text"])] == []
    assert len(got) == stage.count()

    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    from kiln.llm import byte_bpe
    enc = byte_bpe.encoder()
    total = {i: len(enc.encode(r["text"])) // 4 + 1 for i, r in got.items()}
    covered = Counter()
    for p in pieces:
        covered[p["doc_id"]] += p["length"]
    assert dict(covered) == total


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_digest_of_a_whole_conversation(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect()
    first = [r for r in rows if r["conv_id"] == rows[0]["conv_id"]]
    got = {r["conv_id"]: r for r in QUERIES["op2_chat_format"](spark, sf).collect()}
    said = "".join(f"{r['role']}\n{r['text']}\n" for r in first)
    assert got[rows[0]["conv_id"]]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert got[-1]["n_turns"] == 2 and got[-1]["loss_chars"] == len("<|im_end|><|im_start|>assistant ok")
