"""Page extraction on several layouts, and exact search against brute force."""

import math
import random
import re
from collections import Counter

from inkwell.llm import bm25_search, html_extraction

LAYOUT = """<html><head><title>T{i}</title><script>var a="</p><p>no";</script><style>p{{}}</style></head><body>
<header><h2>Site name</h2></header><div id="menu"><a href=/>Home</a> <a href=/x>Other</a></div>
<div class="cookie-notice">We use cookies</div><main><div class="post">{body}<p>Read more on our site</p></div>
<aside>Related things</aside><form><label>Mail</label><button>Go</button></form></main>
<section id="comments"><p>A reader says {i}</p></section><footer>&copy; us</footer></body></html>"""


def page(i, paragraphs):
    return LAYOUT.format(i=i, body="<h1>Head &amp; line {0}</h1>".format(i) + "".join(f"<p>{p}" for p in paragraphs))


def test_article_of_another_layout(spark):
    rng = random.Random(1)
    body = {i: [" ".join(f"w{rng.randrange(999)}" for _ in range(30)) for _ in range(4)] for i in range(40)}
    rows = [(i, f"https://Host.example/{i}", page(i, body[i])) for i in body]
    rows += [(90, None, None), (91, "x", ""), (92, "https://one.example/", "<p>a <b>b</b>c<br>d &lt;e&gt; < f<ul><li>g<li>h</ul><!-- no --"), (92, "https://one.example/", "<div>x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumnRenamed("url", "url")
    out = {}
    for r in html_extraction.extract_pages(df).collect():
        out.setdefault(r["page_id"], []).append(r["text"])
        assert r["n_chars"] == len(r["text"])
    for i in body:
        assert out[i] == ["\n".join([f"Head & line {i}", *body[i]])]
    assert out[90] == [""] and out[91] == [""] and sorted(out[92]) == ["a bc\nd <e> < f\ng\nh", "x"]
    assert html_extraction.extract_pages(df.limit(0)).count() == 0


def test_article_text_under_ids_and_classes_that_sound_like_no_article(spark):
    body = (
        '<header class="entry-header"><h1>Head {0}</h1></header><p>First {0} and more words of it</p><section id="discussion"><p>Discussed {0} at length</p></section>'
        '<h2 id="related-work">Related work {0}</h2><h2 id="share-prices" class="social">Prices {0}</h2><div class="article-header"><p>Lead {0} of the text</p></div>'
        '<p class="notice" id="alert-{0}">Noticed {0}</p>'
    )
    apart = '<div class="share-links"><a href=/a>Tell {0}</a> <a href=/b>Send</a></div><div class="newsletter"><p>Write {0}</p><form><input name=m></form></div>'
    want = "Head {0}\nFirst {0} and more words of it\nDiscussed {0} at length\nRelated work {0}\nPrices {0}\nLead {0} of the text\nNoticed {0}"
    rows, wants = [], {}
    for k, shell in enumerate(("<html><body><nav>Go</nav><article>%s</article></body></html>", '<html><body><div id="content-sidebar-wrap"><div class="post">%s</div></div></body></html>')):
        for n in (1, 4, 9):
            if "<article>" not in shell and n == 1:
                continue
            inner = body if "<article>" in shell else body.replace("header class", "div class").replace("</header>", "</div>")
            for i in range(n):
                rows.append((len(rows), f"http://h{k}{n}.example/{i}", shell.replace("%s", inner.format(i) + apart.format(i))))
                wants[len(rows) - 1] = want.format(i)
    out = html_extraction.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in out} == wants


def test_template_lines_do_not_hang_on_the_number_of_pages(spark):
    rng, rows, wants = random.Random(4), [], {}
    for n in (4, 7, 8, 120):
        for i in range(n):
            body = " ".join(f"w{rng.randrange(999)}" for _ in range(20))
            html = f"<html><body><article><h2>Summary</h2><p>{body}</p><p>All rights with us</p></article></body></html>"
            for _ in range(1 + (i == 0)):
                rows.append((len(rows), f"http://h{n}.example/{len(rows)}", html))
                wants[len(rows) - 1] = f"Summary\n{body}"
    out = html_extraction.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in out} == wants


def test_classes_need_one_order():
    counts = [Counter("abc"), Counter("abc")]
    assert html_extraction.valid_classes(counts, [list("abc"), list("abc")]) == {(1, 1): list("abc")}
    assert html_extraction.valid_classes(counts, [list("abc"), list("acb")]) == {}


def brute(rows, k):
    words = [[w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] for _, t in rows]
    n, mean = len(rows), sum(map(len, words)) / len(rows)
    df = Counter(w for ws in words for w in set(ws))
    out = set()
    for q, (i, _) in enumerate(rows):
        if i is None or i % 20:
            continue
        asked, found = Counter(words[q]), []
        for d, (j, _) in enumerate(rows):
            if j in (None, i):
                continue
            tf = Counter(words[d])
            score = sum(c * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(words[d]) / mean)) for w, c in asked.items() if w in tf)
            if score > 0:
                found.append((-round(score, 9), j))
        out.update((i, rank, j, round(-s, 6)) for rank, (s, j) in enumerate(sorted(found)[:k], 1))
    return out


def test_search_against_brute_force(spark, frame):
    rng = random.Random(2)
    common, rare = [f"c{i}" for i in range(30)], [f"r{i}" for i in range(2000)]
    rows = [(i, " ".join(rng.choice(common if rng.random() < 0.7 else rare) for _ in range(rng.randrange(0, 90)))) for i in range(400)]
    rows += [(1000 + i, rows[40][1]) for i in range(30)] + [(2000, ""), (2001, None), (None, rows[20][1]), (2020, "Only HERE once")]
    docs = frame(rows)
    for shard_bytes in (2_000, 1 << 30):
        out = bm25_search.search(docs, docs.where("doc_id % 20 = 0"), 7, shard_bytes=shard_bytes).collect()
        assert {(r["query_id"], r["rank"], r["doc_id"], round(r["score"], 6)) for r in out} == brute(rows, 7)
    assert bm25_search.search(docs.limit(0), docs.limit(0)).count() == 0


def test_pages_are_parsed_where_they_lie(spark, monkeypatch):
    """Only digests and sums of tokens move, never the pages; copies of a page count once."""
    plans, keep = {}, html_extraction.written

    def spy(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return keep(df, name)

    monkeypatch.setattr(html_extraction, "written", spy)
    rows = [(i, f"https://a.example/{i}", page(i, [f"words of {i} and {i * 7} more", f"again {i * 3}"])) for i in range(12)]
    copies = [(100 + i, "https://a.example/copy", rows[0][2]) for i in range(30)]
    schema = "page_id long, url string, html string"
    alone = {r["page_id"]: r["text"] for r in html_extraction.extract_pages(spark.createDataFrame(rows, schema)).collect()}
    out = html_extraction.extract_pages(spark.createDataFrame(rows + copies, schema).repartition(5))
    assert "hashpartitioning" not in plans["parsed-pages"]
    found = {r["page_id"]: r["text"] for r in out.collect()}
    assert {i: found[i] for i in alone} == alone
    assert all(found[100 + i] == alone[0] for i in range(30))
