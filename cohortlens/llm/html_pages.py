"""Labelled pages that the content model is trained on.

Written for this purpose. ``data-content`` labels an element and what is inside
it (1 content, 0 not) up to elements with a label of their own; the model never
sees the attribute. LONG, MID and LINE stand for paragraphs, whose words say nothing.
"""

LONG = ("Lorem ipsum dolor sit amet, consetetur sadipscing elitr, sed diam nonumy eirmod tempor "
        "invidunt ut labore et dolore magna aliquyam erat, sed diam voluptua. At vero eos et "
        "accusam et justo duo dolores et ea rebum.")
MID = LONG[:123] + "."
LINE = "Stet clita kasd gubergren, no sea takimata."
LINKS = ("<ul><li><a href=/a>Lorem</a></li><li><a href=/b>Ipsum dolor</a></li>"
         "<li><a href=/c>Amet</a></li></ul>")

_SKELETONS = (
    # a plain article between menu, advert and footer
    "<body data-content=0><nav>@links</nav><div class=ad>@line</div>"
    "<article data-content=1><h1>Lorem ipsum</h1><p>@long</p><p><b>@line</b></p><p>Sit.</p>"
    "<p>@long</p></article><footer>&copy; example.org &middot; @line</footer></body>",
    "<body data-content=0><nav>@links</nav><div class=ad>@long</div>"
    "<article data-content=1><h1>Lorem ipsum</h1><p>Sit amet.</p></article>"
    "<footer>&copy; example.org &middot; @line</footer></body>",
    # short articles
    "<body data-content=0><nav>@links</nav><div class='ad'>@line</div>"
    "<article data-content=1><h1>Lorem.</h1><p><b>Lorem.</b></p></article>"
    "<footer>@line</footer></body>",
    "<body data-content=0><nav>@links</nav><div class='ad'>@line</div>"
    "<article data-content=1><h1>Lorem ipsum dolor sit</h1><p>@long</p></article>"
    "<footer>&copy; example.org &middot; @line</footer></body>",
    "<body data-content=0><nav>@links</nav><div class=ad>Sit amet.</div>"
    "<article data-content=1><h1>Lorem ipsum dolor sit</h1><p>Amet sit</p></article>"
    "<footer>&copy; example.org &middot; Lorem ipsum.</footer></body>",
    "<body data-content=0><header>@links</header><article data-content=1><p>Lorem</p>"
    "</article><footer>Ipsum</footer></body>",
    # blog with sidebar, comments and cookie notice
    "<body data-content=0><div class='cookie-notice'><p>@long</p><button>OK</button></div>"
    "<header class='site-header'><h1><a href=/>Lorem</a></h1><p>@line</p></header>"
    "<div id=wrapper><div class='post-content' data-content=1><h2>Ipsum</h2><p>@long</p><p>@line"
    "</p><blockquote>@long</blockquote><ul><li>@line</li><li>@long</li></ul></div>"
    "<aside class=sidebar><h3>Popular</h3>@links<p>@line</p></aside></div>"
    "<section id=comments><h3>3 comments</h3><div class=comment><p>@long</p></div>"
    "<div class=comment><p>@line</p><p>@long</p></div>"
    "<form><p>@line</p><label>Name</label><input></form></section>"
    "<footer><p>@line</p><p>@long</p></footer></body>",
    # main element with article header, share bar, related links
    "<body data-content=0><div class=topbar>@links</div><main data-content=1><article>"
    "<header><h1>Lorem ipsum dolor</h1></header><div class='share-buttons' data-content=0>@links"
    "</div><p>@long</p><h2>Sit amet</h2><p>@long</p><figure><figcaption>@line</figcaption>"
    "</figure><pre>@line</pre><p>@line</p></article>"
    "<div class=related data-content=0><h3>Related</h3>@links</div></main>"
    "<div id=footer><p>@line</p></div></body>",
    # comments as articles inside the main article
    "<body data-content=0><nav class=menu>@links</nav><article class=story data-content=1>"
    "<h1>Lorem</h1><p>@long</p><p>@long</p><section class='comments' data-content=0>"
    "<article class=comment><p>@long</p></article><article class=comment><p>@line</p></article>"
    "</section></article><footer class='site-footer'>@links<p>@line</p></footer></body>",
    # divisions only
    "<body data-content=0><div id=header><div class=logo>Lorem</div><div class=nav>@links</div>"
    "</div><div class=banner>@long</div><div id=content data-content=1><h1>Ipsum</h1>"
    "<div>@long</div><div>@long<p>@line</p>@line</div><div class='newsletter' data-content=0>"
    "<p>@line</p></div></div><div id=sidebar><div class=widget><p>@long</p></div></div>"
    "<div class='copyright'>@line</div></body>",
    # a table and lists as content
    "<body data-content=0><nav>@links</nav><main data-content=1><h1>Lorem</h1><table><tr><td>"
    "@line</td><td>Sit</td></tr><tr><td>Amet</td><td>@line</td></tr></table><ol><li>@line</li>"
    "<li>Dolor</li></ol><dl><dt>Sit</dt><dd>@line</dd></dl><p>@long</p></main>"
    "<aside><p>@long</p><p>@long</p></aside><footer><p>@long</p></footer></body>",
    # text without structure
    "<body data-content=1>@long @long</body>",
    "<body data-content=1>@line @line @line</body>",
    "<body data-content=1>@line</body>",
    "<body data-content=1><p>@long sit</p><p>@long</p></body>",
    "<body data-content=1><p>@long sit</p></body>",
    "<body data-content=1><div>@long</div><div>@long sit</div></body>",
    "<body data-content=1><p>@long</p><p>@long</p><p>@line</p></body>",
    "<body data-content=1><h1>Lorem</h1><p>@line</p><p>@long</p></body>",
    "<body data-content=1><table><tr><td>@long</td></tr></table></body>",
    "<body data-content=1><table><tr><td><h1>Lorem</h1>@long<p>@line</p></td></tr></table></body>",
    "<body data-content=1><table border=0><tbody><tr><td>@line @long</td></tr></tbody></table></body>",
    "<body data-content=1><table><tr><td>@mid</td></tr></table></body>",
    "<body data-content=1><center><p>@mid</p></center></body>",
    # articles of a few words between menu, advert and footer
    "<body data-content=0><nav>@links</nav><div class=ad>@long</div><article data-content=1>"
    "<h1>Lorem | ipsum | dolor | sit | amet |</h1><p><b>Lorem | ipsum | dolor | sit | amet | et</b>"
    "</p></article><footer>&copy; example.org &middot; @line</footer></body>",
    "<body data-content=0><nav>@links</nav><div class=ad>@line</div><article data-content=1>"
    "<h1>Lorem ipsum dolor sit amet</h1><p>Lorem ipsum dolor sit amet, consetetur sadipscing elitr,"
    " sed diam |</p></article><footer>&copy; example.org &middot; @line</footer></body>",
    "<body data-content=0><nav>@links</nav><article data-content=1><h1>Lorem | sit</h1><p>Lorem |"
    "</p><p>Sit</p></article><footer>&copy; example.org &middot; @long</footer></body>",
    # notices, adverts and forms around a section
    "<body data-content=0><div role=banner>@line</div><div role=navigation>@links</div>"
    "<div class='alert notice'>@long</div><section class='entry-content' data-content=1>"
    "<h2>Lorem</h2><p>@long</p><div class='advertisement' data-content=0><p>@long</p></div>"
    "<p>@long</p><aside class=promo data-content=0><p>@line</p></aside><p>@line</p></section>"
    "<form class=subscribe><p>@long</p><button>Go</button></form>"
    "<div role=complementary><p>@long</p></div><div role=contentinfo>@line</div></body>",
    "<body data-content=0><header><p>@line</p>@links</header><div class='gdpr-consent'>@line"
    "</div><div class=article data-content=1><p>@long</p><h3>Lorem</h3><p>@line</p></div>"
    "<div class='user-comments'><ul><li>@long</li><li>@line</li></ul></div>"
    "<div class='sponsored-links'><p>@long</p></div><footer><div>@line</div></footer></body>",
    # nothing but menus
    "<body data-content=0><header>@links</header><nav>@links</nav><footer>@line</footer></body>",
)

# Blocks that are no content wherever they stand, inside the article too.
_OTHER_BLOCKS = (
    "<div class=ad>@line</div>", "<div class=advert>Sit amet!</div>", "<div class='advert box'><p>@long</p></div>",
    "<nav class=toc>@links</nav>", "<div class='menu'>@links</div>",
    "<aside><p>@long</p></aside>", "<div class=sidebar><p>@line</p></div>",
    "<div class='cookie-notice'><p>@line</p><button>OK</button></div>",
    "<div id=newsletter>@line</div>", "<form><p>@line</p><input></form>",
    "<div id=comments><p>@long</p></div>", "<ol class='comment-list'><li>@long</li></ol>",
    "<footer><p>@line</p></footer>", "<div class='share'>@links</div>",
    "<div class=related><p>@line</p></div>", "<div hidden><p>@line</p></div>")
_CONTAINERS = ("<article data-content=1>@text</article>",
               "<main data-content=1><article>@text</article></main>",
               "<div class='post-body' data-content=1>@text</div>")
_PARTLY = tuple(
    "<body data-content=0><nav>@links</nav>" + container.replace(
        "@text", "<h1>Lorem ipsum</h1><p>@long</p>"
        + block.replace(" ", " data-content=0 ", 1).replace("<aside>", "<aside data-content=0>")
        .replace("<form>", "<form data-content=0>").replace("<footer>", "<footer data-content=0>")
        + "<p>@line</p><p>@long</p>")
    + block + "<footer>@line</footer></body>"
    for container in _CONTAINERS for block in _OTHER_BLOCKS)

# Pages without telling names: each holder meets each menu, with bodies and ends in turn.
_TEXTS = (
    "<h1>Lorem ipsum</h1><p>@long</p><p>@long</p>", "<h2>Lorem</h2><p>@long</p>",
    "<p>@long</p><p>@line</p><ul><li>@line</li><li>@line</li></ul><p>@long</p>",
    "<h1>Lorem</h1>@long<br><br>@long", "<div>@long</div><div>@line</div><div>@long</div>",
    "<h1>Lorem ipsum</h1><p>@long <span class=ad data-content=0>@line</span></p><p>@long</p>",
    "<p>@long</p><p>@long <a class=share data-content=0 href=/s>Lorem</a></p><p>Sit.</p>",
    "<h1>Lorem</h1><h2>Sit</h2><p>@long</p><blockquote><p>@long</p></blockquote><p>@line</p>",
    "<p>@long</p><span class='comment' data-content=0>@line</span><p>@long</p>",
    "<p>@long</p><p>@long</p><p>@long</p>", "<h3>Lorem</h3><p>@line</p><p>@long</p><p>@line</p>")
_HOLDERS = (
    "@menu<div role=main data-content=1>@text</div>@end",
    "@menu<div id=main><div class=post data-content=1>@text</div></div>@end",
    "@menu<section data-content=1>@text</section>@end",
    "@menu<div data-content=1>@text</div>@end",
    "@menu<div><div><div data-content=1>@text</div></div></div>@end",
    "<div>@menu<div data-content=1>@text</div>@end</div>",
    "<div id=page>@menu<div><div data-content=1>@text</div></div>@end</div>",
    "@menu<table><tr><td data-content=1>@text</td></tr></table>@end",
    "<table><tr><td colspan=2>@menu</td></tr><tr><td>@links</td><td data-content=1>@text</td></tr>"
    "<tr><td>@end</td></tr></table>",
    "<table><tr><td>@menu</td><td data-content=1>@text</td></tr></table>@end",
    "<form>@menu<div data-content=1>@text</div>@end</form>",
    "@menu<main><div data-content=1>@text</div></main>@end",
    "<center>@menu<div data-content=1>@text</div>@end</center>",
    "@menu<article data-content=1>@text</article>@end",
    "@menu<section><header data-content=1><h1>Lorem</h1></header><div data-content=1>@text</div>"
    "</section>@end",
    "@menu<div class='row'><div class='col' data-content=1>@text</div><div class='col'>@links</div>"
    "</div>@end")
_MENUS = (
    "<nav>@links</nav>", "@links", "<div>@links</div>", "",
    "<p><a href=/a>Lorem</a> | <a href=/b>Ipsum</a></p>",
    "<div><a href=/a>Lorem</a> <a href=/b>Ipsum dolor</a></div>",
    "<header><div><a href=/>Lorem</a></div>@links</header>",
    "<div><a href=/>Lorem</a></div><ul><li><a href=/a>Lorem</a></li></ul>",
    "<header><h1>Lorem</h1><p>@line</p></header><nav><a href=/a>Sit</a></nav>")
_ENDS = (
    "<footer>@line</footer>", "<div>&copy; Lorem 2020</div>", "", "<p>Copyright 2020 Lorem</p>",
    "<div><a href=/a>Lorem</a> <a href=/b>Sit</a></div>", "<footer><p>@long</p></footer>",
    "<div class=comments><p>@long</p><p>@long</p></div><footer>@line</footer>",
    "<form><p>@line</p><label>Lorem</label></form><footer>@line</footer>",
    "<aside><h3>Lorem</h3><p>@long</p></aside>", "<ul><li><a href=/a>Lorem ipsum</a></li></ul>",
    "<div class='ad-box'>@line</div><footer>@line</footer>",
    "<section><h3>Lorem</h3>@links</section>", "<hr><p><a href=/a>Lorem</a> &copy; Sit</p>")


def _other(part: str) -> str:
    """The part with its first element labelled as no content."""
    part = part.replace("@links", LINKS)
    head, _, rest = part.partition(">")
    return f"{head} data-content=0>{rest}" if part else ""


# Text that stands in the body itself, between parts of one element.
_BARE = tuple(
    f"<body data-content=1>{_other(menu)}{_TEXTS[(i + 4 * j) % len(_TEXTS)]}{_other(end)}</body>"
    for i, menu in enumerate((*_MENUS[:7], "<p><a href=/>Lorem</a></p>"))
    for j, end in enumerate((*_ENDS[:6], "<div class=comments><p>@long</p></div>", *_ENDS[8:11],
                             "<p>&copy; Lorem</p>", "<address>Lorem</address>")))
_PLAIN = tuple(
    "<body data-content=0>" + holder.replace("@menu", menu)
    .replace("@text", _TEXTS[(5 * i + j) % len(_TEXTS)])
    .replace("@end", _ENDS[(3 * i + 2 * j) % len(_ENDS)]) + "</body>"
    for i, holder in enumerate(_HOLDERS) for j, menu in enumerate(_MENUS))

# Paragraphs of middle length in the one half of these pages, long ones in the other.
_VARIED = tuple(page.replace("@long", "@mid") if i % 2 else page
                for i, page in enumerate((*_PLAIN, *_BARE)))

LABELLED_PAGES = tuple(
    page.replace("@long", LONG).replace("@mid", MID).replace("@line", LINE).replace("@links", LINKS)
    for page in (*_SKELETONS, *_PARTLY, *_VARIED))
