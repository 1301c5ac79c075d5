"""Pipeline stages keep clashing columns; main texts of wrapped pages; densities by a recursive brute force."""

import math
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from saltmarsh.llm import exact_copies, main_text, quality_model, rule_cascade, shingle_join

CLASHES = ["_row", "__digest", "__copy", "_digest", "_keep_row", "_ROW_", "__p_text", "_p_text", "__prior", "_prior", "__host", "_host", "_path", "_total",
           "name", "n", "root", "row", "host", "path", "text_sha256", "key"]


@pytest.fixture(scope="module")
def wide(spark):
    words = [" ".join(f"w{k}x{j}" for j in range(60)) for k in range(30)]
    data = [(k, words[k], "en", f"src{k % 2}", 1) for k in range(30)] + [(40, words[3], "en", "src0", 1), (41, words[4].replace("w4x7 ", "other "), None, None, 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.select("*", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in CLASHES])


def stages(spark):
    labels = spark.createDataFrame([(k, 1, 0) for k in range(10)], "doc_id long, quality int, toxic int")
    return {
        "rules": (rule_cascade.keep_good, None), "classifier": (lambda d: quality_model.keep_good(d, labels), None),
        "exact": (exact_copies.drop_copies, 40), "near": (shingle_join.drop_near_copies, 41),
    }


@pytest.mark.parametrize("stage", ["rules", "classifier", "exact", "near"])
def test_stages_keep_extra_columns_whatever_their_names(spark, wide, stage):
    keep, gone = stages(spark)[stage]
    found = keep(wide)
    assert found.columns == wide.columns
    rows = found.collect()
    assert rows and all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in CLASHES)
    assert (gone not in {r["doc_id"] for r in rows}) and {0, 3, 4} <= {r["doc_id"] for r in rows}
    assert keep(wide.limit(0)).count() == 0


def test_frequent_copies_go_and_one_stays(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot  text").otherwise(F.col("id").cast("string")).alias("text"), F.lit("x").alias("row"))
    kept = exact_copies.drop_copies(docs)
    assert kept.count() == 2001 and [r.doc_id for r in kept.where("text LIKE 'hot%'").collect()] == [0]


TITLE = "<h1>Title here</h1>"
PARTS = [f"Paragraph number {k} of the article has some words, as texts do have them." for k in range(8)]
ARTICLE = TITLE + "".join(f"<p>{p}</p>" for p in PARTS)
WANT = " ".join(["Title here", *PARTS])
MENU = '<ul class="menu"><li><a href=1>Home</a><li><a href=2>News</a><li><a href=3>More</a></ul>'
COMMENTS = '<div class="comments"><div class=comment><p>I liked this very much, thank you for it.</p></div><div class=comment><p>Me too, a great text to read.</p></div></div>'


@pytest.mark.parametrize("name", [
    "layout with-sidebar", "has-sidebar", "page no-sidebar", "content social-share-enabled", "search-results", "modal-open", "post comments-open",
    "single-post related-on", "sidebar", "ad", "widget-area"])
@pytest.mark.parametrize("inner", [ARTICLE, f"<article>{ARTICLE}</article>", f"<main><div>{ARTICLE}</div></main>"])
def test_a_wrapper_with_a_noise_name_keeps_its_article(name, inner):
    side = '<div class="sidebar"><p>Other news of today and more of it.</p></div><div id="cookie-notice">We use cookies.</div>'
    page = f'<body>{MENU}<div class="{name}">{inner}{side}</div>{COMMENTS}<div id="footer">Copyright</div></body>'
    assert main_text.main_text(page) == WANT


def test_long_comments_forms_around_pages_links_in_articles_and_teasers():
    many = '<div class="comments">' + COMMENTS * 20 + "</div>"
    assert main_text.main_text(f"<body>{MENU}<div>{ARTICLE}</div>{many}</body>") == WANT
    links = "<p>See <a href=1>one</a> <a href=2>two</a> <a href=3>three</a></p>"
    assert main_text.main_text(f"<body><form id=f>{MENU}<div>{ARTICLE}{links}</div>{COMMENTS}<form>Name <input></form></form></body>") == WANT + " See one two three"
    teaser = "<div class=related><article><p>Teaser</p></article></div>"
    assert main_text.main_text(f"<body>{teaser}<div id=content>{ARTICLE}</div></body>") == WANT
    words = "word " * 200_000
    assert main_text.main_text(f"<body>{MENU}<div><p>{words}</p></div></body>") == words.strip()


class _Plain(HTMLParser):
    """Well-formed pages as nested lists, for the brute force."""

    def __init__(self):
        super().__init__()
        self.stack = [["html"]]

    def handle_starttag(self, tag, attrs):
        self.stack.append([tag])

    def handle_endtag(self, tag):
        done = self.stack.pop()
        self.stack[-1].append(done)

    def handle_data(self, data):
        self.stack[-1].append(data)


def _counts(node, in_link=False):
    """Characters, tags, link characters and link tags below a node, by recursion."""
    chars = tags = link_chars = link_tags = 0
    for child in node[1:]:
        if isinstance(child, str):
            chars += len(" ".join(child.split()))
        else:
            c, t, lc, lt = _counts(child)
            chars, tags, link_chars, link_tags = chars + c, tags + t + 1, link_chars + lc, link_tags + lt
    if node[0] == "a":
        link_chars, link_tags = chars, tags + 1
    return chars, tags, link_chars, link_tags


def _densities(node, page):
    c, t, lc, lt = _counts(node)
    own = 0.0
    if c:
        t = max(t, 1)
        inner = math.log(c / max(c - lc, 1) * lc + page[2] / max(page[0], 1) * c + math.e)
        own = max(c / t * math.log(max(c / max(lc, 1) * t / max(lt, 1), 1.0) + 1e-9, max(inner, 1.0 + 1e-9)), 0.0)
    below = [_densities(child, page) for child in node[1:] if not isinstance(child, str)]
    return own, sum(d[0] for d in below), below


def _flat(found):
    yield found[:2]
    for child in found[2]:
        yield from _flat(child)


def _page(rng, depth=0):
    if depth > 4 or rng.random() < .2:
        return "".join(rng.choice(["word ", "longer text of words ", '<a href="x">link here</a> ']) for _ in range(rng.randint(0, 12)))
    tag = rng.choice(["div", "section", "span", "b"])
    return "".join(f"<{tag}>{_page(rng, depth + 1)}</{tag}>" for _ in range(rng.randint(1, 4)))


def test_densities_and_sums_equal_a_recursive_computation():
    rng = random.Random(11)
    for _ in range(200):
        html = f"<body>{_page(rng)}</body>"
        tree, plain = main_text.Tree(), _Plain()
        tree.feed(html), tree.close(), plain.feed(html)
        main_text.measure(tree.root)
        page = plain.stack[0]
        want = list(_flat(_densities(page, _counts(page))))
        todo, got = [tree.root], []
        while todo:
            node = todo.pop()
            got.append((node.density, node.total))
            todo.extend(reversed([c for c in node.children if not isinstance(c, str)]))
        assert [pytest.approx(w) for w in want] == got


def test_without_article_elements_the_densest_subtree_wins():
    body = "".join(f"<p>{p}</p>" for p in PARTS)
    links = "<div>" + "".join(f"<span><a href={k}>A headline of some length number {k}</a></span>" for k in range(30)) + "</div>"
    page = f"<body>{links}<div><div><h2>Head</h2>{body}</div></div><div><p>Short note.</p></div></body>"
    assert main_text.main_text(page) == " ".join(["Head", *PARTS])
