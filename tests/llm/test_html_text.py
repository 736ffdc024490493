import pytest

from tessera.llm.html_text import Page, main_text, with_main_text

BODY = "A paragraph of running text that goes on for a good while. "


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("no markup", "no markup"), ("<p>a &lt; b &amp;c", "a < b &c"),
    ("<html><head><title>T</title></head><body></body></html>", ""),
    ("<body><script>if (a < b) '</p>'</script><style>p{}</style><!-- c --><p>x\n\t y</p></body>", "x y"),
    ("<body><nav><a>Menu</a></nav><article><h1>Title</h1><p><b>Bold<br><p>next <i>in</i>line</article>"
     "<footer>foot</footer>", "Title Bold next inline"),
    ("<body><div class='cookie-notice'>We use cookies</div><main><p>One.</p><aside>side</aside><p>Two.</p>"
     "<section id=comments><article><p>First!</p></article></section></main></body>", "One. Two."),
    ("<body><form><label>Name</label><input></form><article><p>Text</p><div hidden>no</div></article></body>", "Text"),
    ("<body><article><p>" + BODY * 3 + "<p>short<p>" + BODY * 2 + "</article></body>",
     " ".join((BODY * 3 + "short " + BODY * 2).split())),
    ("<p>x</p>" * 3 + "<a title=\"y>" + "never closed", "x x x never closed"),
])
def test_pages(page, text):
    assert main_text(page) == text


def test_density_finds_the_text_without_names():
    links = "".join(f"<li><a href=/{i}>Topic {i}</a></li>" for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><div><h2>Head</h2><p>{BODY * 4}</p><p>{BODY * 5}</p></div>" \
           f"<div><a>Imprint</a> <a>Contact</a></div></body>"
    assert main_text(page) == " ".join(("Head " + BODY * 9).split())


def test_densities_are_those_of_the_formula():
    import math
    page = Page("<body><div><p>abcd <a>ef</a></p><p>ghij</p></div></body>")
    density, chars = page.densities()
    at = page.tag.index("p")
    c, lc, t, lt, share = 6, 2, 1, 1, 2 / 10
    assert chars[at] == c
    x = c / (c - lc) * lc + share * c
    assert density[at] == pytest.approx(c / t * math.log(c / lc * t / lt) / math.log(1 + math.log(x + math.e)))


def test_damage_and_size_take_linear_time():
    for page in ("<div>" * 20000 + "x", "<p><b>" * 20000 + "y", "<" * 50000, "<a b='" * 5000, "&amp;" * 100000):
        main_text(page)


@pytest.mark.parametrize("page", [
    lambda n: "<div>" * n + "x", lambda n: "<b>" * n + "<p>x" + "</i>" * n, lambda n: "<div>" * n + "</b>" * n + "x",
    lambda n: "<i><b>" * n + "<center>y" * n, lambda n: "<ul>" + "<li><span>a" * n, lambda n: "<article>" + "<p>word</p>" * n + "</article>",
    lambda n: "<i><div>" + "<b>" * n + "</i>x" * n])
def test_time_grows_with_the_page(page):
    """Eight times the page takes well under the 64 times that a walk of the stack at every tag takes."""
    import time

    def seconds(n):
        text, best = page(n), 9e9
        for _ in range(3):
            begin = time.perf_counter()
            main_text(text)
            best = min(best, time.perf_counter() - begin)
        return best
    assert seconds(16_000) < 24 * max(seconds(2_000), 1e-3)


def test_column_keeps_rows_and_other_columns(spark):
    rows = [(1, None, "u"), (2, "<p>a</p>", "u"), (2, "<p>a</p>", "u"), (None, "<p>b", None)]
    df = spark.createDataFrame(rows, "page_id long, html string, n_chars string")
    got = with_main_text(df)
    assert got.columns == ["page_id", "html", "n_chars", "text"]
    assert sorted(r.text for r in got.collect()) == ["", "a", "a", "b"]
    assert with_main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("attributes,kept", [
    ("style='overflow:hidden'", True), ("class='overflow-hidden'", True), ("aria-hidden='false'", True),
    ("class='content with-sidebar'", True), ("class=no-sidebar", True), ("data-role='sidebar'", True),
    ("title='hidden'", True), ("hidden='until-found'", True), ("hidden", False), ("HIDDEN=''", False),
    ("style='color:red; display : none'", False), ("aria-hidden=true", False), ("class='left sidebar'", False),
    ("class='sidebar-left'", False), ("id=ad-300x250", False), ("class='cookie-notice'", False),
])
def test_what_hides_an_element(attributes, kept):
    assert main_text(f"<body><div {attributes}><p>{BODY}</p><p>{BODY}</p></div></body>") \
        == (" ".join((BODY * 2).split()) if kept else "")


def test_threshold_chooses_beside_an_article_and_without_one():
    links = "".join(f"<li><a href=/{i}>Topic {i}</a></li>" for i in range(30))
    for tag in ("article", "div"):
        page = f"<body><ul>{links}</ul><{tag}><p>One.</p>{f'<p>{BODY * 4}</p>' * 6}</{tag}>" \
               f"<{tag}><p>Two.</p>{f'<p>{BODY * 4}</p>' * 5}</{tag}><div><a>Imprint</a></div></body>"
        assert main_text(page) == " ".join(f"One. {BODY * 24} Two. {BODY * 20}".split())
