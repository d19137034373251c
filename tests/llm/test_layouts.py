"""Pages whose layouts the extraction model was not trained on, with their main text.

Those about rivers showed which kinds of training pages were lacking; those
about glaciers were written afterwards and changed nothing.
"""

import pytest

from cohortlens.llm import html_extract

RIVER = ("Rivers carry sand and gravel from the hills to the plain, where the current is slower "
         "and the load is dropped, so that the bed rises a little with every flood.")
NOTE = "It was noted in three valleys."
ICE = ("Glaciers grind the rock beneath them to a fine meal, which colours the lakes below a milky "
       "green and settles in thin layers, one for every summer.")
EARLY = "They melt early."
LAYOUTS = [
    (f"<p><a href=/>Home</a></p><p>{RIVER}</p><p>{NOTE}</p><p>{RIVER}</p><address>Me"
     "</address>",
     [RIVER, NOTE, RIVER]),
    ("<div class=site><div class=nav><a href=/>Home</a></div><table><tr><td class=left>"
     f"<a href=/1>One</a></td><td><h1>T</h1><p>{RIVER}</p></td></tr></table></div>",
     ["T", RIVER]),
    (f"<div class=container><div class=row><div class=col><h1>T</h1><p>{RIVER}</p>"
     f"<p>{RIVER}</p></div></div></div><div class=cookie-banner><p>We use cookies.</p>"
     "<button>OK</button></div>",
     ["T", RIVER, RIVER]),
    (f"<article><h1>T</h1><p>{RIVER}</p><figure><img src=x><figcaption>{NOTE}</figcaption>"
     f"</figure><p>{RIVER}</p></article><div class=disqus><p>{RIVER}</p></div>",
     ["T", RIVER, NOTE, RIVER]),
    (f"<dl><dt>Term</dt><dd>{RIVER}</dd><dt>Other</dt><dd>{RIVER}</dd></dl>",
     ["Term", RIVER, "Other", RIVER]),
    (f"<nav><a href=/>Home</a></nav><ol><li>{RIVER}</li><li>{NOTE}</li><li>{RIVER}</li>"
     "</ol><footer>Foot</footer>",
     [RIVER, NOTE, RIVER]),
    (f"<nav><a href=/>Home</a></nav><section><h1>T</h1><p>{RIVER}</p><p>{RIVER}</p>"
     "</section><footer>Foot</footer>",
     ["T", RIVER, RIVER]),
    (f"<div><div><h1>T</h1><p>{RIVER}</p><p>{RIVER}</p><p>{RIVER}</p></div></div>",
     ["T", RIVER, RIVER, RIVER]),
    (f"<table><tr><td><a href=/>Home</a></td><td><h2>T</h2><p>{RIVER}</p></td></tr></table>",
     ["T", RIVER]),
    (f"<table width=100%><tr><td>{RIVER}</td></tr></table>",
     [RIVER]),
    (f"<article><p>{RIVER}</p><select><option>One</select></article>",
     [RIVER]),
    (f"<article><h1>T</h1><p>{RIVER}<button>Share</button></p><noscript>Turn on scripts."
     f"</noscript><p>{NOTE}</p></article>",
     ["T", RIVER, NOTE]),
    (f"<article><p>{RIVER} <span class=ad>Buy now.</span></p><p>{RIVER}</p></article>",
     [RIVER, RIVER]),
    (f"<div><p>{RIVER} <span class='comment'>I agree.</span> {NOTE}</p><p>{RIVER}</p></div>",
     [f"{RIVER} {NOTE}", RIVER]),
    ("<div><ul><li><a href=/>Home</a></li><li><a href=/x>News</a></li></ul></div><div>"
     f"<h1>T</h1><p>{RIVER}</p><p>{NOTE}</p><p>{RIVER}</p></div>",
     ["T", RIVER, NOTE, RIVER]),
    (f"<form action=/><div><a href=/>Home</a></div><div><h1>T</h1><p>{RIVER}</p><p>{RIVER}"
     "</p></div><input></form>",
     ["T", RIVER, RIVER]),
    ("<div class=wrapper><header><a href=/>Site</a></header><div class=columns><div><h1>T"
     f"</h1><p>{RIVER}</p><h2>U</h2><p>{RIVER}</p></div><div class=sidebar><p>{RIVER}</p>"
     "</div></div><footer>&copy; Me</footer></div>",
     ["T", RIVER, "U", RIVER]),
    (f"<main><h1>T</h1><section><h2>U</h2><p>{RIVER}</p></section><section><h2>V</h2>"
     f"<p>{NOTE}</p><p>{RIVER}</p></section></main><aside><p>{RIVER}</p></aside>",
     ["T", "U", RIVER, "V", NOTE, RIVER]),
    ("<div id=header><a href=/>Home</a></div><div id=main><div class=post><h2>T</h2>"
     f"<div class=byline>By someone</div><p>{RIVER}</p><p>{RIVER}</p></div></div>"
     "<div id=footer>Foot</div>",
     ["T", "By someone", RIVER, RIVER]),
    (f"<h1>T</h1><p>{RIVER}</p><pre>x = 1</pre><p>{RIVER}</p><hr><p>&copy; Me</p>",
     ["T", RIVER, "x = 1", RIVER]),
    (f"<article><h1>T</h1><p>{RIVER}</p><form><p>Join our letter</p><input><button>Go"
     f"</button></form><p>{RIVER}</p></article>",
     ["T", RIVER, RIVER]),
    ("<center><table><tr><td><a href=/a>A</a> <a href=/b>B</a></td></tr><tr><td><h1>T"
     f"</h1>{RIVER}<p>{RIVER}</td></tr><tr><td>&copy; Me</td></tr></table></center>",
     ["T", RIVER, RIVER]),
    (f"<div class=portal><div class=lead><h2>T</h2><p>{RIVER}</p><p>{NOTE}</p></div>"
     "<div class=trending><a href=/1>One</a><a href=/2>Two</a></div></div>",
     ["T", RIVER, NOTE]),
    (f"<section><article><h2>T</h2><p>{RIVER}</p><table><tr><th>Year</th><th>Flow</th></tr>"
     f"<tr><td>1990</td><td>12</td></tr></table><p>{RIVER}</p></article></section>"
     f"<section class=comments><article><p>{RIVER}</p></article></section>",
     ["T", RIVER, "Year", "Flow", "1990", "12", RIVER]),
    (f"<div role=main><p>{RIVER}</p><div class=share><a href=/>Share</a></div><p>{RIVER}"
     "</p></div><div role=contentinfo>Foot</div>",
     [RIVER, RIVER]),
    (f"<ul><li><a href=/>Home</a></li></ul><blockquote><p>{RIVER}</p></blockquote>"
     f"<p>{RIVER}</p><div>Copyright Me</div>",
     [RIVER, RIVER]),
    ("<div id=top><ul class=menu><li><a href=/>Home</a></ul></div><div class=page-body>"
     f"<h1>T</h1><p>{ICE}</p><p>{EARLY}</p><p>{ICE}</p></div><div class=bottom>Me</div>",
     ["T", ICE, EARLY, ICE]),
    (f"<section><h2>T</h2><div>{ICE}</div><div>{ICE}</div></section><section><h3>More</h3>"
     "<ul><li><a href=/1>One</a><li><a href=/2>Two</a></ul></section>",
     ["T", ICE, ICE]),
    ("<table><tbody><tr><td><table><tr><td><a href=/>Home</a></td></tr></table></td></tr>"
     f"<tr><td><h1>T</h1><p>{ICE}</p><p>{ICE}</p></td></tr></tbody></table>",
     ["T", ICE, ICE]),
    (f"<main><h1>T</h1><p>{ICE}</p><div class='promo box'>Buy it</div><ol><li>{EARLY}</li>"
     f"<li>{ICE}</li></ol></main><dialog class=modal><p>Sign up</p></dialog>",
     ["T", ICE, EARLY, ICE]),
    (f"<div><h1>T</h1></div><div><p>{ICE}</p><p>{ICE}</p></div><div><a href=/a>About</a>"
     "</div>",
     ["T", ICE, ICE]),
    (f"<article><header><h1>T</h1></header><p>{ICE}</p><blockquote>{EARLY}</blockquote>"
     "<footer>Filed under lakes</footer></article><footer>Me</footer>",
     ["T", ICE, EARLY]),
    (f"<body><p>{ICE}</p><p>{EARLY}</p></body>",
     [ICE, EARLY]),
    ("<div class=content-wrap><div class=crumbs><a href=/>Home</a> &gt; <a href=/x>X</a>"
     f"</div><div><h2>T</h2><p>{ICE}</p><h3>U</h3><p>{EARLY}</p></div></div>",
     ["T", ICE, "U", EARLY]),
    (f"<header><a href=/>Site</a></header><div><p>{ICE}</p></div><section id=respond>"
     "<h3>Leave a reply</h3><form><p>Your text</p></form></section>",
     [ICE]),
    (f"<div class=forum><div class=post><p>{ICE}</p></div></div><div class=social-links>"
     "<a href=/f>F</a></div><p>&copy; 1999 Me</p>",
     [ICE]),
]


@pytest.mark.parametrize("page, want", LAYOUTS)
def test_layouts(page, want):
    assert html_extract.main_text(page, *html_extract.train()) == "\n".join(want)


def test_inline_nodes_stay_on_their_line():
    page = (f"<article><p>{RIVER} <span class=note-text>one <b>two</b></span> three"
            f"<button>x</button> four.</p><p>{NOTE}</p></article>")
    assert html_extract.main_text(page, *html_extract.train()) == (
        f"{RIVER} one two three four.\n{NOTE}")


def test_only_closed_controls_are_left_out():
    nodes = html_extract.parse_page("<div><select><option>a<option>b</select>c</div>")
    assert [n.tag for n in nodes if n.never] == ["select", "option", "option"]
    nodes = html_extract.parse_page(f"<div><button><p>{RIVER}</p></div>")
    assert not any(n.never for n in nodes)
    kept, parents = html_extract.tree_of(
        html_extract.parse_page("<ul><li><select><option>a</select></li><li>b</li></ul>"))
    assert kept == [0, 1, 2, 5] and parents == [-1, 0, 1, 1]
