"""Main text of pages."""

import pytest
from helpers import rows_of

from genoframe.llm.html import blocks_of, extract_text, learn_stop_words, main_text

LONG = (
    "The river of the town is in the hills and it was long with a bend that is wide, "
    "and the people who live by it say that it is the best place to be on a summer day."
)
NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>'
FOOT = "<footer>&copy; site &middot; all rights</footer>"


def page(body, head="<title>T</title><style>p{margin:0}</style>"):
    return f'<!DOCTYPE html><html lang="en"><head>{head}</head><body>{body}</body></html>'


CASES = {
    "article": (
        page(f"{NAV}<article><h1>Head</h1><p>{LONG}<p>Short.</article>{FOOT}"),
        f"Head\n{LONG}\nShort.",
    ),
    "unclosed tags": (
        page(f"{NAV}<article><h1>H</h1><p><b>One two.<br><p>{LONG}</p></article>"),
        f"H\nOne two.\n{LONG}",
    ),
    "scripts and comments": (
        page(f"<article><script>var t='</p><p>no'</script><p>{LONG}<!-- <p>no</p> --></p></article>"),
        LONG,
    ),
    "references and space": (
        page(f"<article><p>A &amp;&lt;b&gt; &eacute;&#233;&#x41;\n\t c&nbsp;d <i>e</i>f</p><p>{LONG}</p></article>"),
        f"A &<b> ééA c d ef\n{LONG}",
    ),
    "marked parts": (
        page(
            f'<article><p>{LONG}</p><div class="ad">{LONG}</div><div id="comments"><p>{LONG}</p></div>'
            f'<aside>{LONG}</aside><form><p>{LONG}</p></form><div class="related-posts">{LONG}</div>'
            f'<div role="navigation">{LONG}</div><p hidden>{LONG}</p></article>'
        ),
        LONG,
    ),
    "reader comments as articles": (
        page(
            f'<article class="post sidebar-right"><p>{LONG}</p>'
            f'<article class="comment"><p>{LONG}</p></article></article>'
            f'<section id="respond"><article><p>{LONG}</p></article></section>'
        ),
        LONG,
    ),
    "no article element": (
        page(
            f'<header><h1>Site</h1></header>{NAV}<div class="cookie-notice">{LONG}</div>'
            f"<h2>Title</h2><p>{LONG}</p><p>Brief one.</p><p>{LONG}</p>"
            f'<div class="sidebar"><p>{LONG}</p></div><ul><li><a href="x">More of this</a></li></ul>{FOOT}'
        ),
        f"Title\n{LONG}\nBrief one.\n{LONG}",
    ),
    "words that only look like marks": (
        page(f'<div class="reader shadow headline"><p>{LONG}</p></div>'),
        LONG,
    ),
    "header inside the article": (
        page(f'<article><header class="entry-header"><h1>Head</h1></header><p>{LONG}</p></article>'),
        f"Head\n{LONG}",
    ),
    "cut off in a tag": (page(f"<article><p>{LONG}</p>")[:-14] + "<a hre", LONG),
    "cut off in a reference": (f"<article><p>{LONG} &am", f"{LONG} &am"),
    "cut off in a script": (f"<article><p>{LONG}</p><script>var a = '<p>", LONG),
    "odd quotes": (f'<article><p title="x>{LONG}</p><p>{LONG}</p></article>', None),
    "less than": (f"<article><p>a < b {LONG}</p></article>", f"a < b {LONG}"),
    "nested lists": (
        f"<article><p>{LONG}</p><ul><li>one<ul><li>two</li></ul></li><li>three</li></ul></article>",
        f"{LONG}\none\ntwo\nthree",
    ),
    "table": (
        f"<article><p>{LONG}</p><table><tr><td>a<td>b</tr></table></article>", f"{LONG}\na\nb"
    ),
    "links in text": (
        f'<article><p>{LONG} <a href="x">Link</a></p><p>See <a>it</a> there.</p></article>',
        f"{LONG} Link\nSee it there.",
    ),
    "only a menu": (page(NAV + FOOT), ""),
    "plain text": (LONG, LONG),
    "empty": ("", ""),
    "null": (None, ""),
    "blank": (" \n ", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(name):
    html, expected = CASES[name]
    found = main_text(html)
    if expected is None:
        assert LONG in found
    else:
        assert found == expected


def test_undecided_blocks_take_the_label_of_near_neighbours():
    link = '<div><a href="x">Read more of this and that on the pages of our site</a></div>'
    html = page(f"{link}<div>Lone words.</div>{link}<p>{LONG}</p><div>Inner words.</div><p>{LONG}</p>")
    assert main_text(html) == f"{LONG}\nInner words.\n{LONG}"


def test_long_page_is_whole():
    assert main_text(f"<article>{'<p>' + LONG + '</p>'}</article>" * 3000).count("river") == 3000


def test_deep_nesting():
    assert main_text("<div>" * 5000 + f"<p>{LONG}" + "</div>" * 5000) == LONG


def test_blocks_know_their_place():
    block = blocks_of(f"<main><h1><a>Head</a></h1></main>")[0]
    assert (block.text, block.link_chars, block.heading, block.main) == ("Head", 4, True, True)


def test_rows(spark):
    pages = [(i, f"u{i}", html, "x", 1) for i, (html, _) in enumerate(CASES.values())]
    schema = "page_id bigint, url string, html string, text string, n_chars int"
    found = rows_of(extract_text(spark.createDataFrame(pages * 2, schema)))
    expected = [(i, u, main_text(h), len(main_text(h))) for i, u, h, *_ in pages * 2]
    assert found == sorted(expected, key=repr)
    assert extract_text(spark.createDataFrame([], schema)).collect() == []


LINK = '<div><a href="x">Read more of this and that on the pages of our site</a></div>'
PLAIN = "Lorem ipsum dolor consectetur adipiscing elit tempor incididunt labore magna aliqua " * 3


def test_passes_decide_inside_articles():
    parts = f"{LINK}<p>Share this</p><p>{PLAIN}</p>{LINK}"
    assert main_text(f"<article><p>{LONG}</p>{parts}<p>{LONG}</p></article>") == f"{LONG}\n{LONG}"
    inner = f"<p>{LONG}</p><p>By a writer</p><p>{PLAIN}</p><p>{LONG}</p>"
    assert main_text(f"<article>{inner}</article>") == f"{LONG}\nBy a writer\n{PLAIN.strip()}\n{LONG}"


def test_article_of_short_blocks_is_kept():
    verse = "".join(f"<p>Line {i}</p>" for i in range(4))
    assert main_text(page(f"{NAV}<article>{verse}</article>{FOOT}")) == "Line 0\nLine 1\nLine 2\nLine 3"


def test_article_elements_that_do_not_hold_the_article():
    story = f"<div><h1>Head</h1><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>"
    text = "\n".join(["Head", LONG, LONG, LONG])
    comments = f'<article class="comment-body"><p>{LONG}</p></article>' * 5
    assert main_text(page(f"{NAV}{story}{comments}{FOOT}")) == text
    cards = "<aside>" + f"<article><h2>Card</h2><p>{LONG}</p></article>" * 5 + "</aside>"
    assert main_text(page(f"{NAV}{story}{cards}{FOOT}")) == text
    teaser = "<article><h2>Other</h2><p>One line about it.</p></article>"
    assert main_text(page(f"{NAV}{story}{teaser}{FOOT}")).startswith(text)
    # An article that holds most of the page still ends the rest.
    assert main_text(page(f"<article>{story}</article><div><p>{LONG}</p></div>")) == text


@pytest.mark.parametrize(
    "wrapper",
    ["layout has-sidebar", "no-sidebar", "content-with-ads", "sidebar-layout", "elementor-widget", "post comments-open"],
)
def test_layout_wrappers_are_not_boilerplate(wrapper):
    comments = f'<div class="comments"><p>{LONG}</p></div>'
    for inner in (f"<article><p>{LONG}</p></article>", f"<p>{LONG}</p>"):
        assert main_text(page(f'{NAV}<div class="{wrapper}">{inner}{comments}</div>{FOOT}')) == LONG


def test_wrappers_with_the_same_word_hold_the_text_together():
    parts = "".join(f'<div id="widget-{i}"><p>{LONG}</p></div>' for i in range(4))
    assert main_text(page(f'{parts}<div class="ad"><p>{LONG}</p></div>')) == "\n".join([LONG] * 4)


def test_marks_of_headings_and_sections_name_their_subject():
    ids = ("discussion", "related-work", "search-results", "navigation")
    for name in ids:
        heading = f'<article><p>{LONG}</p><h2 id="{name}">Title</h2><p>{LONG}</p></article>'
        section = f'<article><p>{LONG}</p><section id="{name}"><h2>Title</h2><p>{LONG}</p></section></article>'
        assert main_text(heading) == main_text(section) == f"{LONG}\nTitle\n{LONG}"


def test_marks_stand_where_the_article_is_elsewhere():
    for mark in ("related-posts", "sidebar", "comments", "ad", "ad-no-border"):
        rest = f'<div class="{mark}"><p>{LONG}</p></div>'
        assert main_text(page(f"<article><p>{LONG}</p></article>{rest}")) == LONG
        assert main_text(page(f"<div><p>{LONG}</p><p>{LONG}</p>{rest}</div>")) == f"{LONG}\n{LONG}"
    more = f'<div class="comment"><p>{LONG}</p></div>' * 9
    assert main_text(page(f"<article><p>{LONG}</p></article>{more}")) == LONG
    assert main_text(page(f'<article><p>{LONG}</p><div id="related">{f"<p>{LONG}</p>" * 5}</div></article>')) == LONG


RUSSIAN = (
    "Река города течёт с холмов, и люди, которые живут у неё, говорят, что летом здесь "
    "лучше всего, потому что вода тёплая, а берег широкий и тихий."
)
CHINESE = "这座城市的河流发源于山中，河水宽阔而平静，住在河边的人们都说夏天的时候这里是最好的地方，水很暖和，岸边也很安静。"


@pytest.mark.parametrize("text", [RUSSIAN, CHINESE])
def test_other_languages_without_an_article_element(text):
    html = page(f"{LINK}<div><h1>1</h1><p>{text}</p><p>{text[:20]}</p><p>{text}</p></div>{LINK}")
    assert main_text(html) == f"1\n{text}\n{text[:20].strip()}\n{text}"


def test_copyright_lines():
    about = f"Copyright law protects texts. {LONG}"
    head = "<h2>Copyright law</h2><p>Copyright is old.</p>"
    html = f"<article><p>{about}</p>{head}<p>{about}</p><p>© 2024 The Site</p></article>"
    assert main_text(html) == f"{about}\nCopyright law\nCopyright is old.\n{about}"


def test_stop_words_are_learnt_from_the_pages(spark):
    filler = "rzeka miasto wzgórze człowiek chleb niebo trawa kamień ścieżka mosty".split()
    odd = " ".join(f"{word} {stop}" for word, stop in zip(filler, "się nie jest na że".split() * 2))
    html = page(f"<p>{odd}</p>" * 4 + f"<p>{' '.join(filler * 2)}</p>")
    pages = spark.createDataFrame([(i, "u", html) for i in range(40)], "page_id int, url string, html string")
    learnt = learn_stop_words(pages)
    assert list(learnt) == ["en LATIN"] and {"się", "nie", "jest", "na", "że"} <= learnt["en LATIN"]
    english = page(f"<p>{LONG}</p>")
    assert learn_stop_words(spark.createDataFrame([(english,)] * 100, "html string")) == {}
    assert {row["text"] for row in extract_text(pages).collect()} == {main_text(html, learnt)}
    assert odd in main_text(html, learnt)


@pytest.mark.parametrize(
    "attribute",
    ['title="the hidden gems"', 'data-state="hidden"', ":class=\"{'hidden': !open}\"", "x='a class=ad b'",
     'data-x = "id = sidebar role=navigation"', 'alt="style=display:none"', "data-hidden=1", "hiddenish"],
)
def test_words_in_other_attributes_are_no_marks(attribute):
    for name in ("div", "article", "section"):
        assert main_text(page(f"<{name} {attribute}><p>{LONG}</p></{name}>")) == LONG
    both = f'<article><p>{LONG}</p><p data-caption="a hidden valley" {attribute}>{LONG}</p></article>'
    assert main_text(page(both)) == f"{LONG}\n{LONG}"


@pytest.mark.parametrize("attribute", ["hidden", 'HIDDEN=""', "a=b hidden", 'style = "color:red; display : none"', "class=ad", "title='>' class='ad'", 'class=""class="x" hidden'])
def test_hidden_and_marked_parts_go(attribute):
    assert main_text(page(f"<article><p>{LONG}</p><div {attribute}><p>{LONG}</p></div></article>")) == LONG


def test_formulas_and_parts_for_screen_readers():
    formula = "<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math>"
    assert main_text(page(f"<p>{LONG} If {formula}, stop. {LONG}</p>")) == f"{LONG} If x=2, stop. {LONG}"
    icon = '<span aria-hidden="true">*</span>'
    assert main_text(page(f'<article><p aria-hidden="true">{LONG}{icon}</p></article>')) == LONG


def test_language_is_read_wherever_it_stands():
    from genoframe.llm.html import _language, _parsed, _plain

    for before in ("", "<!--" + "x" * 5000 + "-->", "<!DOCTYPE html>" + " " * 9000):
        html = f"{before}<html class='a lang=xx' lang='ru-RU'><p>{'latin ' * 60}{RUSSIAN * 9}</p></html>"
        found = _parsed(html)
        assert _language(found, _plain(found.blocks)) == "ru CYRILLIC"
    assert _parsed("<html data-lang='de'><p>x</p>").language is None


@pytest.mark.parametrize(
    "html",
    ["<b>" * 100_000 + "</i>" * 100_000, "<i><div>" + "<b>" * 100_000 + "</i>" * 100_000,
     '<a "' * 100_001, '<a "' * 100_001 + ">", '<a ">" ' * 100_000, "<b>" * 100_000 + "<hr>" * 100_000,
     "<!--" * 100_000, "<!" * 100_000, "<p" * 100_000, '<div class="ad">' * 100_000, "<li><ul>" * 100_000 + "</p>" * 100_000,
     "<script>" * 100_000, "<" * 100_000 + ">", "&" * 300_000],
)
def test_broken_pages_take_linear_time(html):
    from time import process_time

    began = process_time()
    assert LONG in main_text(f"<p>{LONG}</p>{html}")
    assert process_time() - began < 4


def test_stop_words_come_without_a_step(spark):
    """Of a language with few words, words must be the more frequent; no count switches."""
    filler = [f"sło{chr(97 + i)}{chr(97 + k)}wo" for i in range(20) for k in range(20)]
    for n in (1_990, 2_010):
        words = [("się" if i % 50 == 0 else filler[i % 400]) for i in range(n)]
        html = "".join(f"<p>{' '.join(words[i:i + 50])}</p>" for i in range(0, n, 50))
        pages = spark.createDataFrame([(page(html),)], "html string")
        assert learn_stop_words(pages) == {"en LATIN": frozenset({"się"})}
