import pytest

from tackroom.llm.html_extract import extract, extract_text, page_tokens

NONE = frozenset()


@pytest.mark.parametrize(("html", "text"), [
    ("", ""),
    ("plain text", "plain text"),
    ("<p>a<b>b</b>c</p><p> d\n\t e&nbsp;&amp;&#233;&eacute; </p>", "abc d e &éé"),
    ("<article><h1>T</h1><p><b>one<br>two<p>three</article><footer>f</footer>", "T one two three"),
    ("<nav>n</nav><article>x<!-- <p>no</p> --></article><p>after</p>", "x"),
    ("<ARTICLE><P CLASS='ad'>buy</P><p>keep &lt;p&gt; 1 < 2</p><ASIDE>side</ASIDE></ARTICLE>", "keep <p> 1 < 2"),
    ("<body><header>h</header><main><header><h1>t</h1></header>m<footer>f</footer></main></body>", "t m"),
    ('<body><script>var a="</p><p>no";</script><style>p{}</style><div id="cookie-notice">c</div><p title="a>b">y</p></body>', "y"),
    ("<article>a<section class=comments><p>reader</section><div class='commentList'>r</div><form>f<input></form>z</article>", "a z"),
    ("<article>a<div hidden>h</div><div style='display: none'>h</div><div role=navigation>n</div><span class='ad-box'>s</span>b</article>", "a b"),
    ("<div>unclosed <p>one <p>two </div></div></p> tail", "unclosed one two tail"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table></article>", "a b 1 2 3"),
    ("<article>x<script>never closed", "x"),
    ("<article>" + "<div>" * 500 + "deep" + "</div>" * 500 + "</article>", "deep"),
    ("<html><head><title>t</title></head><body></body></html>", ""),
])
def test_one_page(html, text):
    assert extract_text(html, None, NONE) == text


@pytest.mark.parametrize("attrs", [
    'title="the hidden valley"', 'title="a hidden gem"', 'data-hidden="false"', 'data-style="display:none"', 'data-id="comment-study"',
    'id="related-work"', 'class="search-algorithms"', 'class="share-price"', 'class="form-factor"', 'class="widget-theory"',
    "title='class=ad'", 'alt=x data-class="advert"', 'data-aria-hidden="true"', 'class="cookie-recipes"', 'class="intro" class="ad"'])
@pytest.mark.parametrize("tag", ["div", "section", "p"])
def test_ordinary_attributes_keep_the_text(tag, attrs):
    assert extract_text(f"<article><p>before</p><{tag} {attrs}>kept text</{tag}><p>after</p></article>", None, NONE) == "before kept text after"


@pytest.mark.parametrize("attrs", [
    "hidden", 'HIDDEN=""', "aria-hidden='true'", 'style="color:red; display : none"', 'class="related-posts"', 'id="comments"',
    'class="x share-buttons"', 'class="newsletter-box"', 'class="comment-list"', 'role="navigation"'])
def test_names_of_what_is_beside_the_article_leave_it_out(attrs):
    assert extract_text(f"<article><p>before</p><div {attrs}>gone</div><p>after</p></article>", None, NONE) == "before after"


def test_long_pages_of_unclosed_tags_and_deep_containers():
    import time
    start = time.process_time()
    assert extract_text("<article>x" + "<a " * 400_000, None, NONE).startswith("x")
    assert extract_text("<article>x</article>" + "<!-- <p>" * 200_000, None, NONE) == "x"
    assert extract_text("<article>" + "<div class=k>" * 30_000 + "deep" + "</div>" * 30_000 + "</article>", None, NONE) == "deep"
    assert extract_text("<p>a</p> 1 < 2 <!-- open <p>no", None, NONE) == "a 1 < 2"
    assert extract_text("<p>a</p><!-- open <p>no</p> b", None, NONE) == "a"
    assert time.process_time() - start < 60


def site(i, body):
    return (f"<html><head><title>{i}</title></head><body><div class='top'><a href=/>Home</a> <a href=/x>All {i}</a></div>"
            f"<div class='w{i}'><div class='story'><p>{body}</p></div><div class='box'>Call now</div>"
            f"<div class='more'><a href=/a>read {i}</a><a href=/b>see {i}</a></div></div><div class='low'>fixed words</div></body></html>")


def test_template_of_a_host_without_semantic_names(spark):
    rows = [(i, f"http://h.example/{i}", site(i, f"text number {i} has its own long words w{i * 7} and v{i * 13}, much more "
                                                 f"than all of what stands around it, sentence {i} after sentence {i + 1}")) for i in range(8)]
    rows += [(100, "http://other.example/1", "<body><p>single page</p></body>"), (101, None, "<p>no host</p>"), (102, "", None),
             (None, "http://h.example/none", rows[0][2]), (0, "http://h.example/0", rows[0][2])]
    d = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, n_chars int")
    out = extract(d)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in out.collect()]
    assert len(got) == len(rows) and all(n == len(t) for _, _, t, n in got)
    text = {(p, u): t for p, u, t, _ in got}
    for i in range(8):
        t = text[i, f"http://h.example/{i}"]
        assert t.startswith(f"text number {i}") and t.endswith(f"sentence {i + 1}")
    assert text[None, "http://h.example/none"] == text[0, "http://h.example/0"]
    assert text[100, "http://other.example/1"] == "single page" and text[101, None] == "no host" and text[102, ""] == ""
    assert extract(d.limit(0)).count() == 0


def test_tokens_skip_noise_and_count():
    t = page_tokens("<body><div class=a1>x</div><div class=a2>y</div><nav><div>n</div></nav></body>")
    assert t["/body/div.a0"][:2] == [2, 2] and "/body/nav" not in t


def test_given_pages(spark):
    import re
    from html import unescape
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for r in extract(pages).collect():
        inner = re.sub(r"</?(b|i|em|a|span)\b[^>]*>", "", re.search(r"<article>(.*?)</article>", html[r.page_id], re.S)[1])
        blocks = [" ".join(unescape(x).split()) for x in re.split(r"<[^>]*>", inner)]
        assert r.text == " ".join(b for b in blocks if b)


def host(n, page):
    return [(i, f"http://h.example/{i}", page(i)) for i in range(n)]


def texts(spark, rows):
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    return [r.text for r in extract(d).orderBy("page_id").collect()]


def long(i, n=12):
    return " ".join(f"w{i * 31 + k}" for k in range(n))


@pytest.mark.parametrize(("html", "text"), [
    ("<article><h1>T {a}</h1><div class=entry><p>{b}</p></div></article>", "T {a} {b}"),
    ("<main id=content><h1>T {a}</h1><div class=lead>{a}</div><div class=entry><p>{b}</p></div></main>", "T {a} {a} {b}"),
    ("<div class=page><div class=first>{a}</div><div class=second>{b}</div></div>", "{a} {b}"),
    ("<div class=page>lead {a}<div class=second>{b}</div></div>", "lead {a} {b}"),
])
def test_text_beside_the_largest_part_is_kept(spark, html, text):
    menu = "<body><div class=top><a href=/>Home</a> <a href=/x>All</a></div>"
    rows = host(6, lambda i: menu + html.format(a=long(i, 5), b=long(i + 50)) + "<div class=low>fixed words</div></body>")
    assert texts(spark, rows) == [text.format(a=long(i, 5), b=long(i + 50)) for i in range(6)]


MENU = "<html><body><div class=top><a href=/>Home</a> <a href=/x>All</a></div>"


@pytest.mark.parametrize("n", [2, 3, 1000])
def test_copies_of_one_article_are_no_template(spark, n):
    for article in (f"<article><h1>T</h1><div class=entry><p>{long(1)}</p></div></article>",
                    f"<div class=story><h1>T</h1><p>{long(1)}</p></div>"):
        page = MENU + article + "</body></html>"
        assert set(texts(spark, host(n, lambda i: page))) == {"T " + long(1)}
        dated = texts(spark, host(n, lambda i: page.replace("</body>", f"<div class=stamp>{i}</div></body>")))
        assert all(t.startswith("T " + long(1)) for t in dated)


def test_parts_that_only_copies_of_one_article_have_are_kept(spark):
    story = "<article><p>{}</p>{}<div class=box>Call now</div></article></body></html>"
    extra = "<ul><li>first point</li></ul><table><tr><td>cell</td></tr></table><section><p>part</p></section>"
    rows = host(12, lambda i: MENU + story.format(long(max(i, 3)), extra if i <= 3 else ""))
    got = texts(spark, rows)
    assert got[:4] == [long(3) + " first point cell part"] * 4
    assert got[4:] == [long(i) for i in range(4, 12)]


def test_link_lists_are_judged_page_by_page(spark):
    def page(i):
        body = f"<p>{long(i)}</p>" if i % 4 == 0 else "".join(f"<a href=/{k}>see page {i} and {k}</a> " for k in range(30))
        return MENU + f"<article><p>{long(i + 40)}</p><div class=extra>{body}</div></article></body></html>"
    assert texts(spark, host(12, page)) == [long(i + 40) + (" " + long(i) if i % 4 == 0 else "") for i in range(12)]


def test_linked_article_is_kept(spark):
    got = texts(spark, host(6, lambda i: MENU + f"<article><div class=entry><a href=/{i}>{long(i)}</a></div></article></body></html>"))
    assert got == [long(i) for i in range(6)]


@pytest.mark.parametrize(("html", "text"), [
    ("<div class='layout has-sidebar'><article>a text</article><div class=sidebar>side</div></div>", "a text"),
    ("<div class='layout has-sidebar'><main>a text</main><div class=related><article>card</article></div></div>", "a text"),
    ("<div class='no-comments'><main><p>a text</p></main></div>", "a text"),
    ("<main><div class='no-comments'><p>a longer text</p></div><p>end</p></main>", "a longer text end"),
    ("<body><form id=aspnet><div class=top><a href=/>Home</a></div><article>a text</article></form></body>", "a text"),
    ("<body><form id=aspnet><p>a text <input value=x></p></form></body>", "a text"),
    ("<article>a<h2 id='social-life'>b</h2><p id='search'>c</p><span class='form'> d</span></article>", "a b c d"),
    ("<article>text<section class=comments><article>c</article></section></article>", "text"),
    ("<article>text</article><div class=comments><article>reader with a much longer text</article></div>", "text"),
    ("<main><nav>menu</nav></main>", ""),
])
def test_names_do_not_leave_out_the_article(html, text):
    assert extract_text(html, None, NONE) == text


def test_names_of_a_host(spark):
    rows = host(6, lambda i: f"<body><div class='page has-sidebar'><div class=story><p>{long(i)}</p></div>"
                             f"<div class=sidebar><p>side {i}</p></div></div></body>")
    assert texts(spark, rows) == [long(i) for i in range(6)]
