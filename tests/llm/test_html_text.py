import pytest

from trajspark.llm.html_text import blocks_of, extract_text, main_texts, trained_tree

STORY = "<p>" + "A sentence of the story with enough words to stand alone. " * 4 + "</p>"
TOLD = ("A sentence of the story with enough words to stand alone. " * 4).strip()

CASES = {
    "article only": (f"<nav><ul><li><a href=1>Home</a></li></ul></nav><article><h1>Title</h1>{STORY}<p>End.</p></article><footer>Copyright us</footer>",
                     f"Title\n{TOLD}\nEnd."),
    "references": ("<article><p>a &amp; b &lt;c&gt; &#233;&#x4e2d;&nbsp; d &unknown; e&amp</p></article>", "a & b <c> é中 d &unknown; e&"),
    "white space": ("<article><p> a\n\t b<br>c<br/>d </p></article>", "a b c d"),
    "inline": ("<article><p>a<b>b</b> <i>c</i><a href=x>d</a>. More words of text here.</p></article>", "ab cd. More words of text here."),
    "scripts": ("<article><script>if (a<b) '</p>'</script><style>p{}</style><p>x y</p><script>never closed", "x y"),
    "comments": ("<article><!-- <p>no</p> --><p>yes it is</p><!-- open <p>no</p>", "yes it is"),
    "upper case": ("<ARTICLE><P>Big words</P><NAV>menu here</NAV></ARTICLE>", "Big words"),
    "notices": (f"<article>{STORY}<div class='cookie-notice'>We use cookies on this site and more words.</div><div id=comments><p>Nice one, thanks!</p></div>"
                f"<form><p>Your name</p></form><aside>Read also this story</aside><p>End.</p></article>", f"{TOLD}\nEnd."),
    "hidden": ("<article><p>seen here</p><div hidden><p>not seen here</p></div><div style='display: none'>nor this</div></article>", "seen here"),
    "unclosed": ("<article><h1>T<p><b>one two<p>three four</article><footer>f", "T\none two\nthree four"),
    "open quote": ("<article><p class='x>one two</p><p>three</p></article>", "one two\nthree"),
    "less than": ("<article><p>1 < 2 and 3 <4</p></article>", "1 < 2 and 3 <4"),
    "no article": (f"<div class=menu><a href=1>Home</a></div><div>{STORY}{STORY}</div><div class=footer>Copyright 2024 us all</div>", f"{TOLD}\n{TOLD}"),
    "empty": ("", ""),
    "no markup": ("<nav>only a menu</nav>", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    html, text = CASES[name]
    assert main_texts([html], trained_tree()) == [text]


def test_links_and_words():
    block = blocks_of("<p>one <a href=x>two three</a> four</p>")[0]
    assert (block.words, block.linked) == (4, 2)


def test_long_page_of_open_tags():
    assert len(blocks_of("<p " * 20_000 + "<div>" * 20_000 + "x")) == 1
    assert main_texts(["<article>" + "<p>word two" * 50_000 + "</article>"], trained_tree())[0].count("\n") == 49_999


def test_table(spark):
    pages = spark.createDataFrame(
        [(1, "u", CASES["inline"][0], "x"), (1, "u", CASES["inline"][0], "x"), (2, None, None, "y"), (None, "v", "", "z")],
        "page_id long, url string, html string, text string")
    got = sorted([tuple(r) for r in extract_text(pages).collect()], key=str)
    told = CASES["inline"][1]
    assert got == sorted([(1, "u", told, len(told))] * 2 + [(2, None, "", 0), (None, "v", "", 0)], key=str)
    assert extract_text(pages.filter("false")).count() == 0


@pytest.mark.parametrize("unit", ["<p ", "<span class=ad>x", "<div>x y", "</b><div><i>", '<a "', '<div class="', "<li>x<ul>", "<!-", "&amp;<"])
def test_time_grows_with_the_length_alone(unit):
    import time

    def seconds(n):
        start = time.perf_counter()
        blocks_of(unit * n)
        return time.perf_counter() - start

    seconds(2000)
    assert min(seconds(40_000) for _ in range(2)) < 4 * max(0.05, min(seconds(20_000) for _ in range(2)))


def test_deep_nesting_is_kept_as_a_running_state():
    html = "<article>" + "<div>" * 3000 + "inside words here" + "</div>" * 3000 + "</article><nav>menu</nav>after"
    found = blocks_of(html)
    assert [(b.text, b.article, b.chrome_inside) for b in found] == [("inside words here", True, False), ("menu", False, True), ("after", False, False)]
