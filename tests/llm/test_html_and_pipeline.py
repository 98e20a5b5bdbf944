import html as entities
import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

import brute
import data
from sheetrecon.llm import html_tree

PAGE = """<html><body><header><h1>Site</h1></header><div id="cookie-banner">We use cookies</div>
<div class="sidebar"><p>Related long text here with many words that could be taken for content, really.</p></div>
<div class="post-content"><h1>Title</h1><p>First <b>para</b>graph &amp; more,&nbsp; with words enough in it to look like
an article of some kind.</p><div class="advertisement">Buy!</div><p>Short.</p><ul><li>one<li>two</ul>
<form><p>Your name here</p><input></form><blockquote>Quoted<br>text</blockquote><script>no()</script></div>
<section class="comments"><div class="comment"><p>I think this is a great article and want to say so at length.</p></div>
</section><footer><p>c 2020</p></footer></body></html>"""


def test_messages_give_exact_marginals():
    r = random.Random(1)
    for _ in range(40):
        n = r.randint(1, 9)
        parent = [-1] + [r.randrange(i) for i in range(1, n)]
        weights = {k: r.uniform(-3, 3) for k in html_tree.PRIOR}
        feats = [r.sample(list(weights), 2) for _ in range(n)]
        marked = [not html_tree.MARKS.isdisjoint(f) for f in feats]
        up, total = [0.0] * n, 0.0
        for y in itertools.product((0, 1), repeat=n):
            e = sum(weights[f] for i in range(n) if y[i] for f in feats[i])
            for i in range(1, n):
                p = parent[i]
                if (y[p], y[i]) == (0, 1):
                    e += html_tree.RISE_IN_MARKED if marked[p] else html_tree.RISE
                elif (y[p], y[i]) == (1, 0):
                    e += html_tree.FALL_OF_MARKED if marked[i] else html_tree.FALL
            total += math.exp(e)
            up = [u + math.exp(e) * v for u, v in zip(up, y)]
        want = [math.log(u / (total - u)) for u in up]
        assert html_tree.marginals(parent, feats, weights) == pytest.approx(want, abs=1e-6)


def test_unmarked_page():
    weights = html_tree.fit([])
    assert html_tree.main_text(PAGE, weights) == (
        "Title First paragraph & more, with words enough in it to look like an article of some kind. Short. one two "
        "Quoted text")
    assert html_tree.main_text("", weights) == ""


def test_held_out_pages(spark):
    """Fitted on some pages that mark their article, right on all others."""
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect()]
    weights = html_tree.fit(pages[:60])
    for page in pages[60:]:
        body = re.search("<article>(.*?)</article>", page, re.S)[1]
        text = re.sub("<[^>]*>", "", re.sub("</?(p|h1|br)>", " ", body))
        assert html_tree.main_text(page, weights) == " ".join(entities.unescape(text).split())


def test_extract(spark):
    rows = [(1, "u", PAGE), (2, None, None), (None, "v", ""), (1, "u", PAGE), (3, "w", "<p>" * 3000 + "deep"),
            (4, "x", "<article>" + "<p>a b</p>" * 20_000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = html_tree.extract(df).collect()
    assert [(r.page_id, r.url) for r in got] == [(i, u) for i, u, _ in rows]
    assert [r.n_chars for r in got] == [len(r.text) for r in got]
    assert got[1].text == got[2].text == "" and got[0].text == got[3].text != ""
    assert got[5].n_chars == 4 * 20_000 - 1
    assert html_tree.extract(df.limit(0)).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as cp
    rows, docs = data.corpus(spark, 80)
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup",
                                         "benchmark_decontamination", "byte_level_bpe"]
    for name, stage in cp.STAGES[:-1]:
        kept = cp.materialize(stage(spark, docs, data.SF), name)
        assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
        docs = kept
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{data.SF}/benchmark.parquet").collect()]
    left = [(r.doc_id, r.text) for r in docs.collect()]
    assert not any(k[5] for k in brute.contamination(left, bench))
    fp = [brute.simhash(t) for _, t in left]
    assert all(bin(a ^ b).count("1") > 2 for i, a in enumerate(fp) for b in fp[:i])
    out = cp.STAGES[-1][1](spark, docs, data.SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == len(left)


def test_pipeline_of_an_empty_table(spark):
    import corpus_pipeline as cp
    docs = data.documents(spark, [], clashing=False)
    for name, stage in cp.STAGES:
        docs = cp.materialize(stage(spark, docs, data.SF), name)
        assert docs.count() == 0


def test_registered_queries():
    import __spark_entry__ as entry
    names = list(entry.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names


def test_a_head_ends_without_its_end_tag():
    weights = html_tree.fit([])
    article = "<article><h1>Title</h1><p>Some words of an article that is long enough to be one.</p></article>"
    want = "Title Some words of an article that is long enough to be one."
    head = "<head><meta charset=u><title>x</title><style>p {}</style><script>a = '<p>no</p>'</script>"
    for page in (f"<html>{head}<body>{article}", head + article, f"{head}<noscript><img></noscript></head>{article}",
                 f"<html>{head}</head><body>{article}</body></html>"):
        assert html_tree.main_text(page, weights) == want
    assert "loose" in "".join(sum((pieces for _, pieces in html_tree.Tree(head + "loose").runs), []))


def test_formulas_and_objects_of_an_article_stay():
    page = ("<article><p>The sum <math><mi>a</mi><mo>+</mo><mi>b</mi></math> is what we want, and nothing else.</p>"
            "<object data=x><p>The text that stands for the object, with words enough.</p></object></article>")
    assert html_tree.main_text(page, html_tree.fit([])) == (
        "The sum a+b is what we want, and nothing else. The text that stands for the object, with words enough.")
