"""Main text of pages."""

import pytest

from tests.llm.rows import frame
from txn_risk.llm.pages import extract, main_text

LONG = "A first paragraph long enough to count as text, with several words in it."
MORE = "A second paragraph &amp; a reference, <b>bold</b> and\n  more   words in it."
CLEAN = "A second paragraph & a reference, bold and more words in it."


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   ", ""), ("plain words only", "plain words only"), ("<p>one", "one"),
    (f"<nav><a href=/a>a</a></nav><article><h1>T</h1><p>{LONG}<p>{MORE}</article><footer>f</footer>", f"T {LONG} {CLEAN}"),
    (f"<body><div class='sidebar'><p>{LONG}</p></div><main><p>{MORE}</p></main>", CLEAN),
    (f"<div id=content><p>{LONG}</p><p>{MORE}</p></div><div id='comments'><p>{LONG}</p></div>", f"{LONG} {CLEAN}"),
    (f"<article><p>{LONG}</p><form><input><label>mail</label></form><script>x='<p>'</script></article>", LONG),
    (f"<article><p>{LONG}<!-- <p>gone</p> --></p><aside>{MORE}</aside></article>", LONG),
    ("<p>a<br>b</p><ul><li>c<li>d</ul>", "a b c d"),
    ("<p>x &lt;b&gt; &copy &#233; &nope;</p>", "x <b> © é &nope;"),
    (f"<article><header><h1>Site</h1></header><p>{LONG}</p><div class='cookie-notice'>ok?</div></article>", LONG),
    ("<p>" * 3000 + "deep", "deep"), ("<div>" * 3000 + "deep", "deep"), ("<", "<"), ("<a", "<a"), ("<p", "<p"),
    ("<article><p>cut off <b>here", "cut off here"),
])
def test_main_text(page, text):
    assert main_text(page) == text


def test_pages_of_any_kind(spark):
    rows = [(1, "u", f"<p>{LONG}</p>"), (1, "u", f"<p>{LONG}</p>"), (None, None, None), (2, "v", "é" * 100_000)]
    got = extract(frame(spark, rows, "page_id long, url string, html string")).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(
        repr((i, u, main_text(h), len(main_text(h)))) for i, u, h in rows
    )
    assert extract(frame(spark, [], "page_id long, url string, html string")).count() == 0


def hundred(first, n):
    """``n`` paragraphs of 100 characters, and their text."""
    own = [f"{first}{i} ".ljust(100, "x") for i in range(n)]
    return "".join(f"<p>{x}</p>" for x in own), own


LINKS = "<div>" + "".join(f'<a href=/{i}>{str(i).ljust(20, "k")}</a>' for i in range(10)) + "</div>"


def test_sibling_blocks_as_dense_as_the_path_are_content():
    (a, of_a), (b, of_b) = hundred("a", 5), hundred("b", 4)
    assert main_text(f"<body><div>{a}</div><div>{b}</div>{LINKS}</body>") == " ".join(of_a + of_b)
    assert main_text(f"<body><div>{b}</div>{LINKS}<div><div>{a}</div></div></body>") == " ".join(of_b + of_a)
    three = f"<body><div>{a}</div>{LINKS}<div>{b}</div><section>{b}</section></body>"
    assert main_text(three) == " ".join(of_a + of_b + of_b)


@pytest.mark.parametrize("mark", [
    "div style='overflow:hidden'", "div style='visibility:hidden'", "div data-hidden=false", "div title='what is hidden'",
    "div data-id=related", "div data-role='content-header'", "div class='has-sidebar'", "div class='layout-with-banner'",
    "div id=no-comments", "div class='page right-sidebar'", "form id=aspnetForm", "div class=sidebar",
])
def test_a_wrapper_is_kept_by_what_it_holds(mark):
    end = f"</{mark.split()[0]}>"
    assert main_text(f"<body><{mark}><p>{LONG}</p><p>{MORE}</p>{end}</body>") == f"{LONG} {CLEAN}"
    assert main_text(f"<{mark}><article><p>{LONG}</p></article>{end}<footer>{MORE}</footer>") == LONG


@pytest.mark.parametrize("mark", [
    "div class='x site-footer'", "div id=comment-list", "div role=navigation", "div class='ad-300x250'", "form", "div hidden",
    "div data-x='>' CLASS = Sidebar", "div aria-hidden='true'",
])
def test_what_is_named_noise_is_left_out(mark):
    end = f"</{mark.split()[0]}>"
    assert main_text(f"<div><p>{LONG}</p><p>{MORE}</p></div><{mark}><p>{LONG}</p>{end}") == f"{LONG} {CLEAN}"
    assert main_text(f"<main><p>{LONG}</p></main><{mark}>" + f"<p>{MORE}</p>" * 9 + end) == LONG


def test_density_decides_with_an_article_too():
    (a, of_a), (b, of_b) = hundred("a", 5), hundred("b", 4)
    beside = f"<body><article><h1>T</h1>{a}</article><div>{b}</div>{LINKS}</body>"
    assert main_text(beside) == " ".join(["T", *of_a, *of_b])
    teaser = f"<article>{LINKS}</article>"
    assert main_text(f"<body><article><h1>T</h1>{a}</article>{teaser}{LINKS}</body>") == " ".join(["T", *of_a])
    inner = f"<body><article><h1>T</h1><div><div>{a}</div></div>{LINKS}<h2>more</h2></article></body>"
    assert main_text(inner) == " ".join(["T", *of_a])
    bold = f"<article><h1>T</h1><p><b>{'b' * 900}<br></b></p><p>short one</p><p>of 14 letters.</p></article>"
    assert main_text(f"<body>{bold}{LINKS}</body>") == f"T {'b' * 900} short one of 14 letters."
