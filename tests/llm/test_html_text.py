import html
import re

import duckdb
import pytest

from tenderlake.llm import html_text, queries

SF = "/root/testdata/sf0.01"


def test_pages_give_their_articles(spark):
    rows = queries.op3_html_text(spark, SF).collect()
    pages = dict(duckdb.execute(f"select page_id, html from '{SF}/pages.parquet'").fetchall())
    assert len(rows) == len(pages)
    for r in rows:
        article = pages[r.page_id].partition("<article>")[2].partition("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


LONG = "This is a sentence of the main text that has a fair length. " * 3


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("just text", "just text"), ("<p>a &lt; b &amp; c&nbsp;d<p>e", "a < b & c d\n\ne"), ("1 < 2 <b>x</b>", "1 < 2 x"),
        ("<body><nav>m</nav><main><h1>T</h1><p>one<br>two</p><aside>x</aside><footer>f</footer></main><footer>g</footer>", "T\n\none two"),
        ("<article><p>a</p><div class='ad-box'>buy<p>now</div><p>b</p></article><section id=comments><p>nice</p></section>", "a\n\nb"),
        ("<article><p>a<script>if (1 < 2) '<p>x</p>'</script> b</p><style>p{}</style><p hidden>h</p><ul><li>i<li>j</ul></article>", "a b\n\ni\n\nj"),
        ("<article><p title='a > b'>x</p><form><p>name</p></form><!-- <p>no</p> --><p>y</article>", "x\n\ny"),
        (f"<div><a href=/>Home</a></div><div><a href=/>News</a></div><h2>Title</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p><div class=footer>(c)</div>", f"Title\n\n{LONG.strip()}\n\nShort.\n\n{LONG.strip()}"),
        ("<article><p>" + "<b>" * 5000 + "deep</article>", "deep"), ('<article><p class="x>open</p> quote</article>', "open\n\nquote"),
        ("<div class=siteHeader>Site</div><div role='main'><p class=lead>One</p><div id=cookieNotice>Accept</div><p>Two</p></div><div class='reader-comments'><p>Me too</p></div>", "One\n\nTwo"),
        ("<article><header><h1>T</h1></header><div class='article-header'>By A</div><p>x<img src=a><p>y</article><article><p>z</article>", "T\n\nBy A\n\nx\n\ny\n\nz"),
        ("<ARTICLE><P>&#233;&#x41;&eacute;&bogus;</P></ARTICLE>", "éAé&bogus;"),
    ],
)
def test_pages(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<article><p>Teaser.</p></article><div><p>{LONG}</p><p>{LONG}</p></div>", f"Teaser.\n\n{LONG.strip()}\n\n{LONG.strip()}"),
        (f"<div>{LONG}</div><main><p>Short.</p></main><div>Terms</div>", f"{LONG.strip()}\n\nShort."),
        (f"<div>Posted today</div><article><h1>T</h1><p>{LONG}</p><p><a href=/>Source</a></p></article><div><p>You may like</p></div>", f"T\n\n{LONG.strip()}\n\nSource"),
    ],
)
def test_text_outside_an_article_mark_surges_by_itself(page, text):
    assert html_text.main_text(page) == text


AD = "<div class=ad><p>Buy</p><p>now</p><p>here</p><p>or there</p></div>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div><p>{LONG}</p><p>{LONG}</p>{AD}<p>Short closing.</p></div>", f"{LONG.strip()}\n\n{LONG.strip()}\n\nShort closing."),
        (f"<div><p>{LONG}</p><form><p>Mail</p><p>Name</p><p>Go</p></form><ul><li>One</li><li>Two</li></ul>{AD}<p>Signed</p></div>", f"{LONG.strip()}\n\nOne\n\nTwo\n\nSigned"),
        (f"<ul><li><a href=/>Home</a></ul><p>{LONG}</p><p><a href=/x>All of it is link</a></p><p>Short.</p><ul><li><a>A</a><li><a>B</a><li><a>C</a></ul>", f"{LONG.strip()}\n\nAll of it is link\n\nShort."),
    ],
)
def test_asides_and_links_amid_unmarked_text_cut_nothing(page, text):
    assert html_text.main_text(page) == text


def test_odd_rows(spark, tables):
    pages = spark.createDataFrame([(1, None, None, "own"), (None, "u", "", "own"), (2, "u", "<p>" + "word " * 50_000, "own"), (2, "u", "<p>x", "own"), (2, "u", "<p>x", "own")], "page_id long, url string, html string, text string")
    rows = queries.op3_html_text(spark, tables(pages=pages)).collect()
    assert sorted(r.n_chars for r in rows) == [0, 0, 1, 1, 249_999]
    assert queries.op3_html_text(spark, tables(pages=pages.limit(0))).collect() == []


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<article><h1>T</h1><p class='share-price'>Up 3</p><p class=hidden-gem>{LONG}</p><div class='related-work'><p>Smith</p></div><p class='price-alert'>b</p></article>", f"T\n\nUp 3\n\n{LONG.strip()}\n\nSmith\n\nb"),
        (f"<article><p>{LONG}</p><div class='share-buttons'>Share</div><div class='relatedPosts'><p>{LONG[:60]}</p></div><p>b</p><p class=ad>Buy</p></article>", f"{LONG.strip()}\n\nb"),
        (f"<form id=aspnetForm><div class=menu>Home</div><article><p>{LONG}</p></article><input></form>", LONG.strip()),
        (f"<aside><article><p>{LONG[:60]}</p></article></aside><p>{LONG}</p>", LONG.strip()),
    ],
)
def test_names_that_only_hold_a_sign_weigh_nothing(page, text):
    assert html_text.main_text(page) == text


def test_a_page_whose_names_mislead_is_kept_by_its_windows():
    assert html_text.main_text(f"<div id=sidebar-layout>{f'<p>{LONG}</p>' * 4}<nav><a href=/>Home</a></nav></div>") == "\n\n".join([LONG.strip()] * 4)
    assert html_text.main_text("<nav><a href=/>Home</a> now</nav><footer>(c) us</footer>") == ""


def brute_blocks(blocks, window=3, surge=86):
    """The lines kept, from a page's blocks (kind, text): every window anew, by the definition."""
    def weight(kind, text):
        return {"menu": 0, "ad": 0.01 * len(text), "article": 80 + len(text), "link": 0}.get(kind, len(text))

    faint = lambda kind: kind in ("menu", "ad")
    runs = []
    for kinds in (lambda k: not faint(k), faint):
        run = []
        for i, (kind, _) in enumerate(blocks):
            if kinds(kind):
                if run and not faint(kind) and (blocks[run[-1]][0] == "article") != (kind == "article") or run and faint(kind) and run[-1] != i - 1:
                    runs.append(run)
                    run = []
                run.append(i)
        runs += [run] if run else []
    sums = {i: sum(weight(*blocks[j]) for j in run[at : at + window]) for run in runs for at, i in enumerate(run)}
    level = min(surge, max(sums.values(), default=0) / 2)
    kept = set()
    for run in runs:
        least = max(level, 2.0) if faint(blocks[run[0]][0]) else level
        text = [i for at, i in enumerate(run) if any(weight(*blocks[run[s]]) > 0 and sums[run[s]] >= least and all(sums[run[k]] > 0 for k in range(s, at + 1)) for s in range(at + 1))]
        for i in reversed(run):  # what stands just before a surge and joins it
            after = run[run.index(i) + 1 :][:1]
            if i not in text and after and after[0] in text and weight(*blocks[i]) > 0 and blocks[i][0] in ("article", "heading"):
                text.append(i)
        kept |= set(text)
    return "\n\n".join(blocks[i][1] for i in sorted(kept))


def test_random_pages_match_windows_by_definition():
    import random

    rng = random.Random(3)
    shapes = {"menu": "<nav><ul><li><a href=/>{}</a></li></ul></nav>", "ad": "<div class='ad-box'>{}</div>", "article": "<article><p>{}</p></article>", "link": "<p><a href=/>{}</a></p>", "heading": "<h2>{}</h2>", "plain": "<div>{}</div>"}
    decided = 0
    for _ in range(1500):
        kinds = rng.choice((list(shapes), ["plain", "link", "heading"], ["menu", "plain", "ad", "heading"]))
        blocks = [(kind, "x" * rng.choice((1, 5, 20, 60, 150, 900))) for kind in rng.choices(kinds, k=rng.randint(0, 14))]
        page = "".join(shapes[kind].format(text) for kind, text in blocks)
        want = brute_blocks(blocks)
        assert html_text.main_text(page) == want, blocks
        decided += want != "\n\n".join(text for kind, text in blocks if kind not in ("menu", "ad"))
    assert decided > 500
