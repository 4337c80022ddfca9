"""Style trees of pages against a plain version, and names that mislead."""
import math
import random
from collections import Counter, defaultdict

import pytest

from kiln.llm import html_main as H

PAGES = "page_id long, url string, html string, low string, host string"


@pytest.mark.parametrize("html,want", [
    ('<div class="layout has-sidebar"><article><p>Main story text.', ["Main story text."]),
    ('<div id="post-no-comments"><p>Main story text.', ["Main story text."]),
    ('<div class="promo-free content">A long story</div><div>stays</div>', ["A long story", "stays"]),
    ('<article><p>Main</p><section class="reply-all-explained"><p>kept text</section></article>', ["Main", "kept text"]),
    ('<article class="teaser">card</article><div id="content">Long main story', ["Long main story"]),
    ('<form id=aspnet><div class=x><article>Story here</article></div><footer>f</footer></form>', ["Story here"]),
    ('<div class="comments"><article>c1</article></div><article>the story</article>', ["the story"]),
    ('<section class="comments"><article>says a reader</article></section>', ["says a reader"]),
    ('<aside><article>card</article></aside><p>text of the page', ["text of the page"]),
    ('<div class="story-sidebar">own words</div><p>main', ["own words", "main"]),
    ('<div class="main-nav">Home</div><div class="site-footer">x</div><div id="cookieBar">ok</div><p>main', ["main"]),
    ('<div role="main"><p>The story</p></div><div>See also</div>', ["The story"]),
    ('<div hidden>not shown</div><span class="ad">buy</span> now', ["now"]),
])
def test_names_only_lower_weights(html, want):
    assert [t for _, _, t in H.blocks_of(html)] == want


def plain_low(pages):
    """Low nodes per host by one pass over all trees in memory."""
    sites = defaultdict(dict)
    for html, url in pages:
        page = H.parse(html)
        if page.blocks:
            sites[H.host_of(url)].setdefault(tuple((page.nodes[k].path, t) for k, t in page.blocks), page)
    out = {}
    for host, trees in sites.items():
        keys, share, up, leaf = defaultdict(Counter), Counter(), {}, {}
        for page in trees.values():
            for n in page.nodes:
                if n.chars:
                    keys[n.path][n.content.intdigest() if n.content else tuple(n.kids)] += 1
                    up[n.path] = page.nodes[n.up].path if n.up >= 0 else None
                    leaf[n.path] = n.content is not None
                    share[n.path] += n.chars / page.nodes[n.up].chars if n.up >= 0 else 1

        def importance(path):
            m = sum(keys[path].values())
            if m < H.PAGES:
                return 1.0
            own = -sum(c / m * math.log(c / m) for c in keys[path].values()) / math.log(m)
            if leaf[path]:
                return own
            rest = H.DECAY ** len(keys[path])
            return (1 - rest) * own + rest * sum(share[k] / m * importance(k) for k in keys if up[k] == path)

        out[host] = {p: (importance(p), sum(keys[p].values())) for p in keys}
    return {h: {p: x for p, x in t.items() if x[0] < H.LOW} for h, t in out.items()}


def site(rnd, host, n):
    words = "sun moon river stone cloud bird field road winter light".split()

    def say(k):
        return " ".join(rnd.choice(words) + str(rnd.randrange(999)) for _ in range(k))
    rows = []
    fixed, motto = say(12), say(5)
    for i in range(n):
        story = "".join(f"<p>{say(rnd.randrange(8, 30))}</p>" for _ in range(rnd.randrange(1, 6)))
        stats = f"<div class='c4'><b>Members</b><p>since long ago</p><p>{motto}</p><p class='n'>{rnd.randrange(9999)}</p></div>"
        body = (f"<div class='top'><p>{motto}</p><ul>{'<li>Home</li><li>News</li>' * 2}</ul></div><div class='wrap'><div class='a1'>"
                f"<h2>{say(4)}</h2>{story}</div>{stats}</div><div class='b2'>{fixed}</div>")
        rows.append((i, f"https://{host}/p{i}", body, "x", "y"))
    return rows


def test_style_trees_against_a_plain_version(spark):
    rnd = random.Random(3)
    rows = site(rnd, "one.example", 40) + site(rnd, "two.example", 12) + site(rnd, "few.example", 3)
    rows += rows[:5] + [(999, None, rows[0][2], None, None), (1000, "https://one.example/e", None, None, None),
                        (1001, "https://one.example/x", "<p>" + "very long " * 40000, None, None)]
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    want = plain_low([(r[2], r[1]) for r in rows])
    out = {r["doc"]["page_id"]: r["text"] for r in H.main_text(spark.createDataFrame(rows, PAGES).repartition(4)).collect()}
    assert len(out) == len(rows)
    for i, url, html, _, _ in rows:
        assert out[i] == "\n\n".join(t for _, _, t in H.parse(html).kept(want.get(H.host_of(url), {})))


def test_static_parts_go_and_the_story_stays(spark):
    rows = site(random.Random(5), "one.example", 30)
    for r in H.main_text(spark.createDataFrame(rows, PAGES)).collect():
        assert "Home" not in r["text"] and "since long ago" not in r["text"] and "Members" not in r["text"]
        inner = r["doc"]["html"].split("<div class='a1'>")[1].split("</div>")[0]
        assert all(t in r["text"] for t in inner.replace("<h2>", "|").replace("</h2>", "|").replace("<p>", "|").replace("</p>", "|").split("|") if t)
        number = r["doc"]["html"].split("<p class='n'>")[1].split("<")[0]
        assert number not in r["text"].split("\n\n")            # varies, but its branch is a template's


def test_no_host_is_gathered(spark):
    rows = site(random.Random(6), "one.example", 30)
    low = H.low_nodes(spark.createDataFrame(rows, PAGES).select("html", "url"))
    got = low.collect()
    shapes = {H._shape(H.parse(r[2])) for r in rows}
    assert {r["shape"] for r in got} <= shapes and all(len(r["low"]) <= 40 for r in got)
