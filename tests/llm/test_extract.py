from hypothesis import given, settings
from hypothesis import strategies as st

from tristrata.llm import extract

SCHEMA = "page_id long, url string, html string, text string, n_chars int"
LONG = "This is a sentence, with some words in it. And here is another one; it goes on, too."


def text_of(page):
    return "\n".join(extract.main_blocks(extract.blocks_of(page)))


def test_article_without_its_frame():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x="</p>";</script></head>
    <body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=x>One</a><li><a>Two</a></ul></nav>
    <div class="cookie-banner">We use cookies. Really, we do, on all pages.</div><!-- <p>no</p> -->
    <div class="ad">Buy this now, it is cheap. It is very cheap, indeed.</div>
    <article><h1>Title &amp; more</h1><p>{LONG}</p><p>A   b<b>old</b> &eacute;nd&#33;<br>Next
    line</p><ul><li>first<li>second <i>item</i></ul><p>{LONG}
    <form><input name=a><button>Go</button> Send it.</form>
    <aside>By the way, this is not the article.</aside>
    <section id="comments"><p>Nice article, I liked it. Thank you!</p></section></article>
    <div id=sidebar><p>{LONG}</p></div><footer>&copy; Someone, somewhere. All rights reserved.</footer></body></html>"""
    assert text_of(page).split("\n") == [
        "Title & more", LONG, "A bold énd!", "Next line", "first", "second item", LONG,
    ]


def test_root_is_found_without_an_article_element():
    boxes = "".join(f"<div><a href=x>Link {k}</a></div>" for k in range(12))
    page = f"<body><div>{boxes}</div><div><div><h2>Head</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div></div></body>"
    assert text_of(page).split("\n") == ["Head", LONG, "Short.", LONG]


def test_one_part_that_holds_most_of_the_text_is_not_the_whole():
    big = " ".join([LONG] * 4)
    parts = {
        f"<ul><li>{big}</li><li>{LONG}</li></ul>": [big, LONG],
        f"<ul><li><p>{big}</p></li></ul>": [big],
        f"<blockquote><p>{big}</p></blockquote>": [big],
        f"<table><tbody><tr><td>{big}</td></tr></tbody></table>": [big],
        f"<section><h2>Part</h2><p>{big}</p></section>": ["Part", big],
    }
    for part, lines in parts.items():
        inside = f"<h1>Title</h1><p>{LONG}</p>{part}<p>The end, at last.</p>"
        for around in ("article", "main", "div", "body"):
            page = f"<nav><a href=x>Menu</a></nav><{around}>{inside}</{around}>"
            assert text_of(page).split("\n") == ["Title", LONG, *lines, "The end, at last."]
    page = f"<body><div>Menu</div><section><article><h1>Title</h1><p>{LONG}</p></article></section></body>"
    assert text_of(page).split("\n") == ["Title", LONG]


def test_a_word_of_class_or_id_does_not_decide_alone():
    kept = [
        '<section id="discussion">%</section>', '<section id="commentary">%</section>',
        '<section id="cookies">%</section>', '<div class="cookie-recipe">%</div>',
        '<h2 id="related-work">%</h2>', '<h2 id="search">%</h2>', '<h2 id="header-files">%</h2>',
        '<p class="share-price">%</p>', '<div class="share-price">%</div>',
        '<h2><span class="headline" id="Comments">%</span></h2>',
    ]
    for part in kept:
        for end in ("", "<p>The end, at last.</p>"):
            if "cookies" in part and not end:
                continue
            page = f"<article><p>{LONG}</p>{part.replace('%', 'Own words, and more.')}{end}</article>"
            assert "Own words, and more." in text_of(page).split("\n"), page
    dropped = [
        '<div class="ad">Buy this, now.</div>', '<div class="cookie-banner">We use cookies.</div>',
        '<div class="related-posts"><h3>More</h3><a href=x>A linked title</a></div>',
        '<div id="sidebar-left">Some words, here.</div>', '<section class="comments">I like it.</section>',
    ]
    for part in dropped:
        page = f"<article><p>{LONG}</p>{part}<p>The end, at last.</p></article>"
        assert text_of(page).split("\n") == [LONG, "The end, at last."], page


STORY = f"<h2>Title</h2><p>{LONG} {LONG}</p><p>Short.</p><p>{LONG}</p>"
SMALL = "<h3>More</h3><p>Some words</p><p>Few words, here</p>"


def test_scores_choose_where_no_word_is_known(monkeypatch):
    """Frame and content differ by class only, and the classes say nothing."""
    links = "<ul><li><a href=x>One linked title</a> 3 min</li><li><a href=y>Other</a> 5 min</li></ul>"
    for frame in (SMALL, links, "<p>Part of the Example network</p>", "<p>Printed 12 times</p><p>Issue 7</p>"):
        for page in (
            f"<body><div class=x1>{frame}</div><div class=x2>{STORY}</div><div class=x3>{frame}</div></body>",
            f"<body><div><div class=x1>{frame}</div></div><div><div class=x2>{STORY}</div></div></body>",
            f"<body><div class=x1>{frame}{frame}</div><article class=x2>{STORY}</article></body>",
        ):
            assert text_of(page).split("\n") == ["Title", f"{LONG} {LONG}", "Short.", LONG], page
            with monkeypatch.context() as patch:
                patch.setattr(extract, "SCORE_SHARE", 0.0)
                assert text_of(page).split("\n") != ["Title", f"{LONG} {LONG}", "Short.", LONG]


def test_names_of_classes_do_not_make_the_result():
    page = f"""<body><div class="%0"><p>Some words</p></div><div class="%1"><div class="%2">{STORY}</div>
    <div class="%2"><p>{LONG}</p></div></div><div class="%3"><a href=x>Next</a> <a href=y>Last</a></div></body>"""

    def under(*names):
        text = page
        for k, name in enumerate(names):
            text = text.replace(f"%{k}", name)
        return text_of(text)

    want = under("notice", "content", "story", "pager")
    assert want.split("\n") == ["Title", f"{LONG} {LONG}", "Short.", LONG, LONG]
    assert under("x1", "x2", "x3", "x4") == under("colophon", "a", "b", "c") == want


def test_two_columns_of_text_both_stay():
    page = f"<body><div class=a><p>{LONG}</p><p>One.</p></div><div class=b><p>{LONG}</p><p>Two.</p></div></body>"
    assert text_of(page).split("\n") == [LONG, "One.", LONG, "Two."]


def test_frame_alone_is_no_article():
    assert text_of(f'<body><div class="ad">{LONG}</div><article></article></body>') == ""
    assert text_of('<body><div class="pager"><a href=x>Next</a></div></body>') == ""


def test_empty_elements_hold_nothing():
    for tag in ("<svg/>", "<object data='x'/>", '<div class="ad" />', "<canvas />", "<iframe src='x' />"):
        assert text_of(f"<article><p>{LONG}</p>{tag}<p>The end.</p></article>").split("\n") == [LONG, "The end."]
    assert text_of(f"<article><p>{LONG}</p><svg><path/></svg><p>The end.</p></article>").endswith("The end.")


def test_broken_markup():
    assert text_of("") == ""
    assert text_of("plain words") == "plain words"
    assert text_of("<p>a<p>b<b>c</p>d &am") == "a\nbc\nd &am"
    assert text_of("<p>1 < 2 and 3 > 2</p><p>cut <a href='x") == "1 < 2 and 3 > 2\ncut"
    assert text_of("<script>x") == ""
    assert text_of("<article><p>a</div></span></p></article>b").startswith("a")


@given(st.text(alphabet="<>/pabdiv \"'=&;!-é", max_size=80))
@settings(max_examples=300, deadline=None)
def test_any_input_is_read(page):
    for line in text_of(page).split("\n"):
        assert line == " ".join(line.split())


def test_rows(spark):
    rows = [(1, "u", f"<p>{LONG}</p>", "old", 1), (2, None, None, None, None), (3, "u", "", "x", 2)]
    rows += [(None, "u", "<p>é</p>", "x", 1), (1, "u", f"<p>{LONG}</p>", "old", 1), (4, "u", "<p>y " * 30_000, "", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = extract.extract(df)
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    by = {r.page_id: (r.text, r.n_chars) for r in got.collect()}
    assert by[1] == (LONG, len(LONG)) and by[2] == ("", 0) and by[3] == ("", 0) and by[None] == ("é", 1)
    assert by[4][1] == 2 * 30_000 - 1
    assert got.count() == 6
    assert extract.extract(df.limit(0)).count() == 0
