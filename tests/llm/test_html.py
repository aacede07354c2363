import html
import re

import pytest

from lexspark.llm.html_extract import blocks_of, extract_pages, main_text, page_blocks

SCHEMA = "page_id long, url string, html string, text string, n_chars string, n_blocks int"
LONG = "The council said on Monday that it will rebuild the old bridge by the mill, and that the work is to begin in the spring of next year if the money for it has been found."
MORE = "Most of the people who live by the river were in favour of the plan, which had been on the table for ten years, but some of them said that they had not been asked about it."


def text_of(page):
    return main_text(page)[0]


def test_pages_of_the_driver(spark):
    """An article's text, told plainly by its tags, which hold no containers of other kinds in these tables."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        lines = [" ".join(html.unescape(p.replace("<b>", "").replace("</b>", "").replace("<br>", " ")).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        want[r.page_id] = "\n".join(x for x in lines if x)
    got = {r.page_id: r for r in extract_pages(pages).collect()}
    assert {k: r.text for k, r in got.items()} == want
    assert all(r.n_chars == len(r.text) and r.n_kept < r.n_blocks for r in got.values())


def test_page_without_marks():
    page = f"""<html><head><title>Bridge</title><style>p {{}}</style></head><body>
      <div><a href=/>Home</a> | <a href=/a>About us</a> | <a href=/b>Contact</a></div>
      <div><h2>A bridge for the mill</h2><div>{LONG}</div><div>No date is set.</div><div>{MORE}</div></div>
      <div>Tags</div><div><a href=/1>The plan of the council</a> <a href=/2>What the people by the river said</a></div>
      <div>© 2024 The Daily of the River and of the Mill, all rights are reserved by the owners of it</div></body></html>"""
    assert text_of(page) == f"A bridge for the mill\n{LONG}\nNo date is set.\n{MORE}"


@pytest.mark.parametrize(
    "part",
    [
        "<nav><p>{}</p></nav>", "<footer>{}</footer>", "<aside>{}</aside>", "<div class='sidebar-left'>{}</div>", "<div id=cookie-notice>{}</div>", "<div role=alert>{}</div>", "<div class='Ad'>{}</div>",
        "<form><label>{}</label></form>", "<script>{}</script>", "<style>{}</style>", "<!-- {} -->", "<noscript>{}</noscript>", "<section id='comments'><article><p>{}</p></article></section>",
        "<div class='commentList'><p>{}</p></div>", "<div hidden>{}</div>", "<div style='display: none'>{}</div>", "<header><p>{}</p></header>", "<template>{}</template>", "<select><option>{}</option></select>",
    ],
)
def test_other_parts_go(part):
    other = "The editors of this paper are of the view that it is the best of all the papers that have been read by the people in the town, and by those who were there before them in the old days."
    for lead, tail in (("<article><h1>Title</h1><p>", "</p>{}</article>"), ("<main><h1>Title</h1><p>", "</p></main>{}"), ("<h1>Title</h1><div>", f"</div><div>{MORE}</div>{{}}")):
        want = ["Title", LONG] + ([MORE] if MORE in tail else [])
        assert text_of(f"<body>{lead}{LONG}{tail.format(part.format(other))}</body>").split("\n") == want


def test_references_and_space():
    assert text_of("<article><p>a &amp; b &lt;c&gt; &#233;&#x4e2d; &am; x&nbsp;y</p>\n\n<p>\t </p><p>one\n  two<br>three<b>f</b>our.</p></article>") == "a & b <c> é中 &am; x y\none two threefour."


def test_broken_pages():
    assert text_of("<article><p><b>First.<br><p>Second.</b><p>Third") == "First.\nSecond.\nThird"
    assert text_of("</div></p><article><p>a > b. </article></article><p>") == "a > b."
    assert text_of("<article><p title='it>s'>Kept.</p><p title=\"open>Also.</p>") == "Kept.\nAlso."
    assert text_of("<article><p>Cut here.</p><p cla") == "Cut here."
    assert text_of("<article><p>Before.</p><script>var t = '</p>'; if (a < b) x</article>") == "Before."
    assert text_of("plain") == "plain" and text_of("") == "" and main_text(None) == ("", 0, 0)
    assert text_of("<form><main><p>Whole page in a form.</p></main><input></form>") == "Whole page in a form."
    assert text_of("<article><header><h1>Head</h1><p>by someone.</p></header><p>Body.</p></article>") == "Head\nBody."


def test_ambiguous_blocks_follow_their_neighbours():
    menu = "<ul>" + "".join(f"<li><a href=/{k}>Part {k} of it</a></li>" for k in range(4)) + "</ul>"
    page = f"{menu}<div>Search this</div>{menu}<div>{LONG} {LONG}</div><div>In short</div><div>{MORE} {MORE}</div>"
    assert text_of(page) == f"{LONG} {LONG}\nIn short\n{MORE} {MORE}"
    first = {b.text: b.linked for b in blocks_of(page)}
    assert first["Search this"] == 0 and first["Part 1 of it"] == len("Part1ofit")


def test_rows(spark):
    page = f"<article><p>{LONG}</p></article>"
    long = "<article>" + "<p>word that is. </p>" * 60_000 + "</article>"
    rows = [(1, "u", page), (1, "u", page), (None, None, page), (4, "v", None), (5, "v", ""), (6, "w", long), (7, "x", "<div>" * 20_000 + "deep.")]
    d = spark.createDataFrame([(*r, "t", "n", 3) for r in rows], SCHEMA)
    got = extract_pages(d).collect()
    want = sorted([(1, LONG), (1, LONG), (-1, LONG), (4, ""), (5, ""), (6, "\n".join(["word that is."] * 60_000)), (7, "deep.")])
    assert sorted((r.page_id or -1, r.text) for r in got) == want and all(r.n_chars == len(r.text) for r in got)
    assert extract_pages(d.limit(0)).collect() == [] and page_blocks(d.limit(0)).collect() == []
    listed = page_blocks(d.filter("page_id = 1")).collect()
    assert [(r.page_id, r.block, r.text, r.first, r.kept) for r in listed] == [(1, 0, LONG, "good", True)] * 2
