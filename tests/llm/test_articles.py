"""Main text: hand-made pages of many builds, and pages put together from known parts."""

import random

import pytest

from chainlytics.llm import articles as A

LONG = "A sentence of the article that is long enough to look like prose, with commas, and it goes on for a while. "
SHORT = "So."


def page(body, head="<title>T &amp; t</title><style>p{}</style><script>if (a < b) t='</p>';</script>"):
    return f'<!DOCTYPE html><html lang="en"><head>{head}</head><body>{body}</body></html>'


MENU = '<nav><ul><li><a href="/">Home</a></li><li><a href="/b">News of the day</a></li></ul></nav>'
AROUND = [
    MENU,
    f"<header><h1>The site</h1><p>{LONG}</p></header>",
    f'<div class="site-header">{LONG}</div>',
    f"<footer><p>&copy; 2024 {LONG}</p></footer>",
    f'<aside><p>{LONG}</p></aside>',
    f'<div class="col sidebar-left"><p>{LONG}</p><p>{LONG}</p></div>',
    f'<div id="cookieNotice">{LONG}<button>Accept</button></div>',
    f'<div class="ad">{LONG}</div>',
    f'<div role="complementary">{LONG}</div>',
    f'<form action="/s"><label>Search</label><input name="q"><p>{LONG}</p><textarea>{LONG}</textarea></form>',
    f'<section id="comments"><h2>Comments</h2><article class="comment"><p>{LONG * 3}</p></article></section>',
    f"<script>document.write('<p>{LONG}</p>')</script><noscript><p>{LONG}</p></noscript><template>{LONG}</template>",
    f"<!-- <p>{LONG}</p> --><div hidden>{LONG}</div><div style='display: none'>{LONG}</div>",
]
PARTS = [
    (f"<h2>Head &lt;{{}}&gt;</h2>", "Head <{}>"),
    (f"<p>{LONG}{{}}</p>", LONG + "{}"),
    ("<p>So {}.</p>", "So {}."),
    (f"<p>{LONG}<b>bold {{}}</b>,<br/>and\n\t more&nbsp;of <a href='/x'>it</a>.", LONG + "bold {}, and more of it."),
    (f"<ul><li>{LONG}<li>second {{}}</ul>", LONG.strip() + "\nsecond {}"),
    (f"<blockquote><p>{LONG}</p>{{}}</blockquote>", LONG.strip() + "\n{}"),
    ("<table><tr><th>Name<td>{}</tr><tr><td>more<td>cells</table>", "Name {}\nmore cells"),
    ("<div><div>{} &eacute;&#233;&#xe9; &am</div></div>", "{} ééé &am"),
    ("<p>  </p><p>{}<span> inline</span></p>", "{} inline"),
    (f'<div class="ad">{LONG}</div><p>after the advert {{}}</p>', "after the advert {}"),
]


def built(rng, wrap):
    inner, want = [], []
    for k in range(rng.randint(1, 12)):
        html, text = rng.choice(PARTS)
        inner.append(html.format(k))
        want.append(text.format(k).strip())
    around = rng.sample(AROUND, rng.randint(0, len(AROUND)))
    cut = rng.randint(0, len(around))
    return page("".join(around[:cut]) + wrap[0] + "".join(inner) + wrap[1] + "".join(around[cut:])), "\n".join(want)


@pytest.mark.parametrize("wrap", [("<article>", "</article>"), ("<div class='wrap has-sidebar'><main><article class='post'>", "</article></main></div>"), ("<main id='content'>", "</main>"), ("<div role='main'><div itemprop=articleBody>", "</div></div>")])
@pytest.mark.parametrize("seed", range(40))
def test_the_article_and_nothing_else(seed, wrap):
    html, want = built(random.Random(seed), wrap)
    assert A.main_text(html) == want


@pytest.mark.parametrize("seed", range(20))
def test_without_article_elements_the_ratios_decide(seed):
    """Paragraphs in an unnamed container, with unnamed menus and a line of links around it."""
    rng = random.Random(seed)
    ps = [LONG * rng.randint(1, 3) + str(k) if rng.random() < 0.7 or k in (0, 5) else f"So {k}." for k in range(6)]
    links = "<div>" + "".join(f"<p><a href='/{k}'>Link {k}</a></p>" for k in range(8)) + "</div>"
    html = page(links + "<div><h1>The heading</h1><div>" + "".join(f"<p>{p}</p>" for p in ps) + "</div></div>" + links + f"<footer>{LONG}</footer>")
    assert A.main_text(html) == "\n".join(["The heading", *ps])


def test_broken_and_odd_pages():
    assert A.main_text(None) == A.main_text("") == A.main_text(" \n ") == A.main_text(MENU) == A.main_text("<p><b><!-- ") == ""
    assert A.main_text("no markup  at\nall") == "no markup at all"
    assert A.main_text(page(MENU + "<article></article>")) == ""
    assert A.main_text("</div></p></article><article><p>one</div><p>two<article>three") == "one\ntwo\nthree"
    assert A.main_text("<article><p>cut off &amp and <a href='x") == "cut off & and"
    assert A.main_text("<ARTICLE><H1>Title</H1><P>Text</ARTICLE><FOOTER>no") == "Title\nText"
    assert A.main_text("<article><header><h1>Title</h1><p>by line</p></header><p>Text</p></article>") == "Title\nText"


def test_a_run_of_links_in_an_article_is_a_menu():
    links = "".join(f"<li><a href='#{k}'>Part {k}</a></li>" for k in range(4))
    assert A.main_text(f"<article><h1>T</h1><ul>{links}</ul><p>{LONG}</p><p><a href='/'>one link</a></p></article>") == f"T\n{LONG.strip()}\none link"


def test_a_long_comment_does_not_win_over_a_short_article():
    html = page(f'<article><h1>T</h1><p>{SHORT}</p></article><div class="comments"><p>{LONG * 20}</p></div>')
    assert A.main_text(html) == f"T\n{SHORT}"


def test_deep_and_long_pages():
    assert A.main_text("<div>" * 3_000 + LONG + "</div>" * 3_000) == LONG.strip()
    many = "".join(f"<p>{LONG}{k}</p>" for k in range(20_000))
    assert A.main_text(page(MENU + "<article>" + many + "</article>")).count("\n") == 19_999


def test_smoothing_is_gaussian():
    flat = A.smoothed(A.np.array([0.0, 0, 1, 0, 0]))
    assert flat[2] > flat[1] > flat[0] > 0 and abs(flat.sum() - 1) < 1e-9 and flat[1] == flat[3]


def test_rows_pass_with_their_columns(spark):
    rows = [(1, "<article><p>é&nbsp;1</article>", "old", "u", 5), (1, None, "old", None, 6), (None, "", None, "w", 7)]
    wide = spark.createDataFrame(rows, "page_id bigint, html string, text string, url string, n_chars int")
    found = A.extracted(wide)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(repr, (tuple(r) for r in found.collect()))) == sorted(map(repr, [(1, "u", "é 1", 3), (1, None, "", 0), (None, "w", "", 0)]))
    assert A.extracted(wide.where("false")).isEmpty()
