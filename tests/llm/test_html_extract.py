import html as entities
import re
import time

import pytest

from rivulet.llm.html_extract import extract, main_text

P1 = "The first paragraph is long enough to matter, with commas, clauses, and a plain statement of facts."
P2 = "A second paragraph follows, somewhat shorter, yet still prose of the usual kind, as articles have."
P3 = "Third and last, this one ends the story, and says so, in one more sentence."


def reference(page):
    """Fixed-form pages: the article element's text without tags."""
    body = re.search(r"<article>(.*)</article>", page, re.S)[1]
    body = re.sub(r"</?(?:p|h\d|br|div|li|ul)\b[^>]*>", " ", body)
    return re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]+>", "", body))).strip()


def test_real_pages(spark, small):
    df = spark.read.parquet(f"{small}/pages.parquet")
    rows = {r.page_id: r.html for r in df.collect()}
    out = {r.page_id: r for r in extract(df).collect()}
    assert set(out) == set(rows)
    for i, page in rows.items():
        assert out[i].text == reference(page) and out[i].n_chars == len(out[i].text)


NOISY = f"""<html><head><title>T</title><style>p,q{{a:b}}</style><script>document.write("<p>no, no, no, no</p>")</script></head>
<body class="post-page"><header><h1>Site</h1><p>Our slogan, as long as it is, sits here, at the top of each page.</p></header>
<nav><ul><li><a href=/a>Home, sweet home, of links, and more</a><li><a href=/b>B</a></ul></nav>
<div id="cookie-notice"><p>We use cookies, partners, and others, to improve, well, everything you do here.</p></div>
<div class="layout"><div class="sidebar"><p>Popular, trending, hot, new, and other words, with commas, abound here today.</p></div>
<div class="{{cls}}"><h2>Head &amp; line</h2><p>{P1}</p>
<div class="ad"><p>Buy now, cheap, good, fast, and more, of all these things you need.</p></div>
<p>{P2.replace("usual", "<b>usu</b>al")}<form><p>Enter, your, mail, please, it is safe, really.</p><input></form>
<p>{P3}<!-- a, b, c -->  &nbsp; &#65;&copy;</div>
<section id="comments"><p>Great post, thanks, really, I liked it, a lot, more than I can say here.</p></section></div>
<footer><p>Copyright, terms, privacy, imprint, contact, and jobs, are linked here.</p></footer></body></html>"""


@pytest.mark.parametrize("cls", ["article-body", "x1", "entry-content main"])
def test_boilerplate_goes(cls):
    assert main_text(NOISY.replace("{cls}", cls)) == f"Head & line {P1} {P2} {P3} A©"


def test_paragraphs_directly_in_body():
    assert main_text(f"<p>{P1}<p>{P2}<ul class=menu><li><a href=x>x</a></ul><p>{P3}") == f"{P1} {P2} {P3}"


def test_edges(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "plain &lt;text&gt;\n here", None), (4, "u", "<div><p>a", "x"), (5, "u", "<script>var a = '<p>x</p>'", "x"), (6, "u", "<p" + " a=b" * 1000, "x"), (7, "u", "<p>" + "long, " * 200_000, "x"), (8, "u", "</p></div><p>x y z w v u t</b></p>a < b", "x"), (9, "u", "<div>" * 3000 + "deep words, here, and there" + "</div>" * 3000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = {r.page_id: r for r in extract(df).collect()}
    assert (out[1].text, out[1].n_chars, out[2].url, out[2].text) == ("", 0, None, "")
    assert out[3].text == "plain <text> here" and out[4].text == "a" and out[5].text == "" and out[6].text == ""
    assert out[7].n_chars == 6 * 200_000 - 1 and out[8].text == "x y z w v u t a < b" and out[9].text == "deep words, here, and there"
    assert extract(df.where("false")).collect() == []


ARTICLE = f"<p>{P1}</p><p>{P2}</p><p>{P3}</p>"


@pytest.mark.parametrize("attrs", ['class="content no-sidebar"', 'id="page" class="site has-sidebar"', 'class="layout with-sidebar"', 'class="content sidebar"', 'class="widget"', 'class="comment"', 'id="ad"'])
def test_names_of_noise_do_not_delete_an_article(attrs):
    assert main_text(f"<body><div {attrs}>{ARTICLE}</div></body>") == f"{P1} {P2} {P3}"


@pytest.mark.parametrize("part", ['<section id="related-work">{}</section>', '<section id="search">{}</section>', '<div id="search-algorithms">{}</div>', '<h3 id="share-price">Price</h3>{}', '<div class="social-science">{}</div>'])
def test_slugs_of_headings_and_sections_stay(part):
    text = f"{'Price ' if 'h3' in part else ''}{P2}"
    assert main_text(f"<body><article><p>{P1}</p>{part.replace('{}', f'<p>{P2}</p>')}<p>{P3}</p></article></body>") == f"{P1} {text} {P3}"


def test_parts_of_one_name_and_long_discussions():
    parts = "".join(f'<div class="x-widget x-widget-text"><p>{p}</p></div>' for p in (P1, P2, P3))
    assert main_text(f"<body><div>{parts}</div></body>") == f"{P1} {P2} {P3}"
    talk = "".join(f'<li class="comment"><div class="comment-body"><p>{P2} {P1} No {k}.</p></div></li>' for k in range(9))
    for page in (f"<div>{ARTICLE}<ol class='comment-list'>{talk}</ol></div>", f"<article>{ARTICLE}</article><div id='comments' class='comments-area'><ol>{talk}</ol></div>"):
        assert main_text(f"<body>{page}</body>") == f"{P1} {P2} {P3}"
    menu = "".join(f"<li><a href=/{k}>Another story, with a long title, number {k}</a></li>" for k in range(40))
    assert main_text(f"<body><div>{ARTICLE}<div class='related-posts'><ul>{menu}</ul></div></div></body>") == f"{P1} {P2} {P3}"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><meta charset=x><body>{ARTICLE}</body></html>",
        f"<head><title>T</title>{ARTICLE}",
        f"<head><title>T</title><p>{P1}<p>{P2}<p>{P3}",
        f"<body><div><p hidden>Not, to, be, seen.{ARTICLE}</div></body>",
        f"<body><div><ul><li hidden>Not, to, be, seen<p>at all.<li><p>{P1}<li><p>{P2}<li><p>{P3}</ul></div></body>",
        f"<body><table><tr><td class=nav aria-hidden=true><p>Not, to, be<td><p>{P1}<p>{P2}<p>{P3}</table></body>",
        f"<body><table><tr hidden><td>Not, to, be<tr><td><p>{P1}<p>{P2}<p>{P3}</table></body>",
        f"<body><table><thead hidden><tr><td>Not, to, be<tbody><tr><td><p>{P1}<p>{P2}<p>{P3}</table></body>",
        f"<body><div><table><tr><td class=nav><a href=/>Not, to, be</tr></table><p>{P1}<p>{P2}<p>{P3}</div></body>",
        f"<body><div><ul><li class=share>Not, to, be</ul><p>{P1}<p>{P2}<p>{P3}</div></body>",
        f"<body><div><div><nav>Not, to, be<b>this</b></i></div>{ARTICLE}</div></body>",
        f"<body><nav>Not, to, be</body>{ARTICLE}",
    ],
)
def test_dropped_elements_end_where_html_lets_their_end_tags_be_omitted(page):
    assert main_text(page) == f"{P1} {P2} {P3}"


def test_tags_within_dropped_elements_stay_dropped():
    assert main_text(f"<body><div><b><nav><ul><li>x, y</b><li>z, u</ul>More, of, the menu</nav></b>{ARTICLE}</div></body>") == f"{P1} {P2} {P3}"
    assert main_text(f"<body><div><select><option>a<option>b</select><nav><div><nav>x</nav>y</div>z</nav>{ARTICLE}</div></body>") == f"{P1} {P2} {P3}"


def test_adverts_and_comments_in_any_element_go():
    ads = ['<p class="advert">Buy now, cheap, good, and more.</p>', '<h3 class="sponsored">Sponsored, by us</h3>', '<div class="ad-box"><p>Buy, now.</p></div>', '<p class="comment">Nice, post.</p>', '<span class="ad">Buy</span>', '<p class="newsletter-signup">Sign up, now.</p>', '<table class="promo"><tr><td>Buy, now</td></tr></table>']
    for ad in ads:
        assert main_text(f"<body><article><p>{P1}</p>{ad}<p>{P2}</p><p>{P3}</p></article></body>") == f"{P1} {P2} {P3}", ad
    for head in ('<h2 class="section-header">Head</h2>', '<h1 class="header">Head</h1>', '<p class="side note">Head</p>'):
        assert main_text(f"<body><article>{head}{ARTICLE}</article></body>") == f"Head {P1} {P2} {P3}", head


def test_sections_of_different_lengths_stay():
    secs = "".join(f'<div class="sec"><h2>Part {k}</h2>{f"<p>{P1}</p>" * n}</div>' for k, n in enumerate((6, 1, 1, 1)))
    want = " ".join(f"Part {k} " + " ".join([P1] * n) for k, n in enumerate((6, 1, 1, 1)))
    assert main_text(f"<body><div class='wrap'>{secs}</div></body>") == want
    plain = secs.replace(' class="sec"', "")
    assert main_text(f"<body><div class='wrap'>{plain}</div></body>") == want
    assert main_text(f"<body><section>{secs}</section><footer>x, y, z</footer></body>") == want


def test_title_beside_and_closing_paragraph_stay():
    assert main_text(f'<body><div><h1>Title</h1><div id="content">{ARTICLE}</div><p>End</p></div></body>') == f"Title {P1} {P2} {P3} End"
    assert main_text(f'<body><h1>Title</h1><div class="x"><div id="content">{ARTICLE}</div></div></body>') == f"Title {P1} {P2} {P3}"
    assert main_text(f'<body><h1><a href="/">The site</a></h1><div id="content">{ARTICLE}</div></body>') == f"{P1} {P2} {P3}"
    assert main_text(f'<body><h1>The site</h1><div class="x"><div id="content"><h1>Title</h1>{ARTICLE}</div></div></body>') == f"Title {P1} {P2} {P3}"
    assert main_text(f"<body><div><div>{ARTICLE}</div><ul><li>one, of, these</li></ul><ul><li><a href=/>a link</a></li></ul></div></body>") == f"{P1} {P2} {P3} one, of, these"


def test_nested_texts_are_read_in_linear_time():
    n = 4000
    page = "<div>some words, of its own, here and there, to count " * n + "</div>" * n
    assert len(page) > 200_000
    began = time.perf_counter()
    text = main_text(page)
    assert time.perf_counter() - began < 2 and text.count("some words") == n


PROSE = "<p>This is a long paragraph of an article, with commas, and more words, so that it counts, as prose does, in fact.</p>"


@pytest.mark.parametrize(
    "html",
    [
        f'<body><form id="aspnetForm"><input name=a><label>Search</label><select><option>x</select><div id="content">{PROSE * 5}</div><button>Go</button></form></body>',
        f"<form role=form><article>{PROSE * 5}</article></form>",
        f"<form>{PROSE * 5}</form>",
        f"<object>{PROSE * 5}</object>",
        f"<div id=w>{PROSE * 5}<form><p>Sign up, for news, now</p><input></form><object><p>No player here</p></object></div>",
    ],
)
def test_pages_within_forms_and_objects(html):
    assert main_text(html) == " ".join([PROSE[3:-4]] * 5)


@pytest.mark.parametrize(
    ("before", "first"),
    [
        ('<div id="main"><div class="lead">Short lead text here.</div><div class="story">', "Short lead text here."),
        ('<div id="main"><div class="top"><h1>Head line</h1></div><div class="story">', "Head line"),
        ('<div class="top"><h1>Head line</h1></div><div id="w"><div class="story">', "Head line"),
        ('<div id="main"><div class="sidebar">Of the side</div><div class="story">', ""),
        ('<div id="main"><div>&copy; 2024 A Firm</div><div class="story">', ""),
        ('<div id="main"><div>See <a href=x>this</a></div><div class="story">', ""),
    ],
)
def test_leads_and_headlines_in_sections_of_their_own(before, first):
    assert main_text(f"{before}{PROSE * 4}</div></div>") == " ".join([*([first] if first else []), *[PROSE[3:-4]] * 4])
