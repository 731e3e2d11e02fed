import pytest

from quaystar.llm import html_text

PARTS = "<p>First of the article, with enough words to count as text.</p><p>Second &amp; last\n\n of   it &copy; here.</p>"
LINES = ["First of the article, with enough words to count as text.", "Second & last of it © here."]


@pytest.mark.parametrize(
    "source, expected",
    [
        (f"<html><body><nav><a href=x>Menu</a></nav><article><h1>Title</h1>{PARTS}</article><footer>End</footer></body></html>", ["Title", *LINES]),
        (f"<body><div class='site-header'>Top</div><div id=content>{PARTS}</div><div class=sidebar>{PARTS}</div>", LINES),
        (f"<main>{PARTS}<section id='comments'><p>{'Reader says so. ' * 30}</p></section></main>", LINES),
        (f"<article>{PARTS}<form><p>Sign up now</p></form><aside>{PARTS}</aside></article>", LINES),
        (f"<article>{PARTS}<script>var t='</p><p>no'</script><style>p{{}}</style><!-- <p>no</p> --></article>", LINES),
        ("<article><p><b>Never closed<br><p>next <i>one</p></article>", ["Never closed", "next one"]),
        ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table></article>", ["one", "two", "a b", "c"]),
        ("<article>bare text<p>block</p>more text</article>", ["bare text", "block", "more text"]),
        ("no markup at all &lt;here&gt; &#233;&#x1F600;", ["no markup at all <here> é😀"]),
        (f"<body><div><ul>{'<li><a href=/x>link here</a>' * 9}</ul></div><div>{PARTS}</div></body>", LINES),
        ("", []),
        ("<html><body><nav>only a menu</nav></body></html>", []),
        ("<p>ends in a tag <a href='x", ["ends in a tag"]),
        ("a < b and b > c <3 <p>x</p", ["a < b and b > c <3", "x"]),
    ],
)
def test_main_text(source, expected):
    assert html_text.main_text(source) == "\n".join(expected)


def _section(name: str, paragraphs: int, size: int) -> tuple[str, list[str]]:
    texts = [f"{name}{k} " + "word " * (size // 5) for k in range(paragraphs)]
    return f"<h2>Part {name}</h2>" + "".join(f"<p>{t}</p>" for t in texts), [f"Part {name}", *[t.strip() for t in texts]]


@pytest.mark.parametrize("tag", ["section", "div"])
def test_all_sections_of_a_page_without_article(tag):
    parts = [_section("A", 6, 300), _section("B", 3, 250), _section("C", 2, 300), _section("D", 1, 10)]
    inside = "".join(f"<{tag}>{source}</{tag}>" for source, _ in parts)
    menu = "<ul><li><a href=/a>Part A</a><li><a href=/b>Part B</a></ul>"
    page = f"<body><nav>Home</nav>{menu}<div><h1>The title of this page</h1>Between them.{inside}<p>Last.</p></div>{menu}<footer>End</footer></body>"
    assert html_text.main_text(page).split("\n") == ["The title of this page", "Between them.", *[x for _, lines in parts for x in lines], "Last."]


def test_deep_and_long_pages():
    deep = "<div>" * 5_000 + "text" + "</div>" * 5_000
    assert html_text.main_text(deep) == "text"
    long = "<article>" + "<p>some words here</p>" * 20_000 + "</article>"
    assert html_text.main_text(long).count("\n") == 19_999
    assert html_text.main_text("<a href=\"" * 3_000) is not None
    assert html_text.main_text("<" * 50_000).startswith("<")


def test_whole_operator(spark):
    rows = [(1, "u", f"<article>{PARTS}</article>", 9), (1, "u", f"<article>{PARTS}</article>", 9), (None, None, None, None), (2, "v", "", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, Text int")
    found, text, count = html_text.extracted(pages)
    assert (text, count) == ("_text", "n_chars")
    got = sorted(((row.page_id, row[text], row[count], row["Text"]) for row in found.collect()), key=str)
    whole = "\n".join(LINES)
    assert got == sorted([(1, whole, len(whole), 9)] * 2 + [(None, "", 0, None), (2, "", 0, 0)], key=str)
    assert html_text.article_texts(pages).columns == ["page_id", "url", "text", "n_chars"]
    assert html_text.article_texts(pages.limit(0)).count() == 0


def test_every_page_of_the_test_data(spark):
    """All of these pages hold an article of h1 and p elements: what is in it, by plain string work, is expected."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {row.page_id: row.text for row in html_text.article_texts(pages).collect()}
    for row in pages.collect():
        article = re.search("<article>(.*?)</article>", row.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert found[row.page_id] == "\n".join(filter(None, blocks))
