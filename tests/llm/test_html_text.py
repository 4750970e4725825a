import html
import re
import time

import pytest

from prevascope.llm import html_text as op
from prevascope.llm.common import table
from tests.conftest import SAMPLE

SHELL = "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>%s</body></html>"


def plain(source):
    """The article of the sample's pages, taken apart by plain patterns."""
    article = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", article)
    texts = (" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks)
    return "\n\n".join(t for t in texts if t)


def test_sample(spark):
    pages = table(spark, SAMPLE, "pages")
    got = {r.page_id: r for r in op.extract(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == plain(r.html)
        assert got[r.page_id].n_chars == len(plain(r.html)) and got[r.page_id].url == r.url


def test_without_article():
    """Ratios alone find the container."""
    body = "".join(f"<p>Sentence number {i}, which is long enough, stands here. It has a second part.</p>" for i in range(6))
    links = "".join(f'<li><a href="/{i}">Link {i}</a></li>' for i in range(20))
    page = SHELL % f'<div class="top"><ul>{links}</ul></div><div><h2>Head</h2>{body}</div><div>Imprint</div>'
    text = op.main_text(page)
    assert text.startswith("Head\n\nSentence number 0") and text.count("\n\n") == 6 and "Link" not in text and "Imprint" not in text


@pytest.mark.parametrize("junk", [
    '<nav><ul><li>Menu entry, first.</li></ul></nav>', '<aside>A sidebar, with text.</aside>', '<form><label>Name</label><input></form>',
    '<div class="comments"><p>Reader says, no. Indeed, no!</p></div>', '<script>var a = "<p>x</p>";</script>', "<!-- <p>old</p> -->",
    '<div id="cookie-notice">We use cookies, sorry.</div>', '<section class="sponsored ad-box">Buy this, now!</section>', '<style>p{}</style>',
    '<div hidden>Not shown.</div>', '<footer>Foot</footer>', '<button>Press</button>', '<article class="comment">Me too.</article>',
])
def test_what_is_left_out(junk):
    article = f"<article><h1>Title</h1><p>First, a text.</p>{junk}<p>Second &amp; last &lt;one&gt;.</p></article>"
    for page in (SHELL % f"{junk}{article}{junk}", SHELL % f"<main>{article}{junk}</main>"):
        assert op.main_text(page) == "Title\n\nFirst, a text.\n\nSecond & last <one>."


def test_white_space_and_broken_markup():
    assert op.main_text(None) == op.main_text("") == op.main_text("<br><!-- x") == ""
    assert op.main_text("a  b\n\tc") == "a b c"
    assert op.main_text("<article><p>one<p>two <b>bold<p>three<br>four") == "one\n\ntwo bold\n\nthree four"
    assert op.main_text("<article>1 < 2 and <3</article>") == "1 < 2 and <3"
    assert op.main_text("<article><ul><li>x<li>y</ul></article></div></p>") == "x\n\ny"
    assert op.main_text('<article><p title="a > b">t&eacute;xt&nbsp;&#x41;</p></article>') == "téxt A"


@pytest.mark.parametrize("unit", ["<div>", "<p>x", "</div>", "<a '", '<a "', "<!--", "<script>", "<", "&", "<b>", "<ul><li>x", "<!", "</"])
def test_hostile_pages_take_linear_time(unit):
    began = time.time()
    op.main_text("<article>text" + unit * 60_000)
    assert time.time() - began < 8


def test_awkward_rows(spark):
    data = [(1, None, None), (1, "u", ""), (2, "u", "<p>a</p>"), (2, "u", "<p>a</p>"), (None, None, "<p>b</p>")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars")
    got = sorted((tuple(r) for r in op.extract(pages).collect()), key=repr)
    assert got == sorted([(1, None, "", 0), (1, "u", "", 0), (2, "u", "a", 1), (2, "u", "a", 1), (None, None, "b", 1)], key=repr)
    assert op.extract(pages.limit(0)).collect() == []


STORY = "".join(f"<p>Sentence number {i}, which is long enough, stands here. It has a second part.</p>" for i in range(9))


def test_blocks_are_selected_by_their_path():
    """A teaser in an article does not replace the story, several articles all stay, and a list of an article stays with it."""
    text = op.main_text(SHELL % f"<main><div>{STORY}</div><article><p>A teaser, with one more sentence of its own.</p></article></main>")
    assert all(f"Sentence number {i}," in text for i in range(9))
    text = op.main_text(SHELL % f"<article><h2>One</h2>{STORY}</article><article><h2>Two</h2>{STORY}</article><div>Imprint</div>")
    assert text.count("Sentence number") == 18 and "One\n\n" in text and "Two\n\n" in text and "Imprint" not in text
    links = "".join(f"<li>{i}</li>" for i in range(30))
    text = op.main_text(SHELL % f"<article>{STORY}<ul>{links}</ul></article>")
    assert text.count("Sentence number") == 9 and "\n\n17\n\n" in text


@pytest.mark.parametrize("wrapper", [
    'div class="layout with-sidebar"', 'div id="page" class="no-header"', 'section class="post has-share"', 'div class="ad-free content"',
    'div class="sidebar"', 'form id="aspnetForm"', 'div class="social widget"', 'article class="comment"',
])
def test_names_do_not_drop_the_story(wrapper):
    page = SHELL % f'<div class="top">Home</div><{wrapper}><h2>Head</h2>{STORY}</{wrapper.split()[0]}><div class="ad">Buy this, now!</div>'
    text = op.main_text(page)
    assert text.startswith("Head\n\nSentence number 0") and text.count("Sentence number") == 9 and "Buy" not in text


def test_named_blocks_can_win_back():
    note = " ".join(f"This long notice has sentence {i}, with a second half, and it goes on." for i in range(40))
    related = '<section class="related"><p>See also.</p></section>'
    page = SHELL % f'<article>{related}{STORY * 6}<div class="notice"><p>{note}</p></div></article>'
    text = op.main_text(page)
    assert note in text and text.count("Sentence number") == 54 and "See also" not in text
    page = SHELL % f"<article>{STORY}<p>The area is <math><mi>x</mi><mo>+</mo><mn>1</mn></math> units, as <svg><text>shown</text></svg> here.</p></article>"
    assert op.main_text(page).endswith("The area is x+1 units, as shown here.")


TABLE = "<table><tr><th>Year</th><th>Sum</th></tr>" + "".join(f"<tr><td>{y}</td><td>{y % 7}</td></tr>" for y in range(1990, 1996)) + "</table>"
INSIDE = {
    "table": (TABLE, ["Year", "1990", "1995"]),
    "list": ("<ul><li>Bring water</li><li>Bring bread</li></ul>", ["Bring water", "Bring bread"]),
    "definitions": ("<dl><dt>Mole</dt><dd>A unit</dd></dl>", ["Mole", "A unit"]),
    "code": ("<pre>x = 1</pre>", ["x = 1"]),
    "quote": ("<blockquote><p>So be it</p></blockquote>", ["So be it"]),
    "figure": ("<figure><img src='a'><figcaption>A hill</figcaption></figure>", ["A hill"]),
    "subject": ('<div class="related-work"><p>Earlier work is short</p></div>', ["Earlier work is short"]),
    "section": ('<section id="search"><p>The search went on for weeks, and nothing was found in the end.</p></section>', ["The search went on for weeks"]),
    "mixed links": ('<ul><li><a href="/a">Bread</a> takes two hours in all, with the rest</li></ul>', ["Bread takes two hours"]),
}


@pytest.mark.parametrize("wrapper", ["<article>%s</article>", "<div>%s</div>", "<main><div><div>%s</div></div></main>", "%s"])
@pytest.mark.parametrize("name", INSIDE)
def test_parts_of_the_text_stay(wrapper, name):
    part, wanted = INSIDE[name]
    links = "".join(f'<li><a href="/{i}">Place {i}</a></li>' for i in range(8))
    body = wrapper % f"<h1>Title</h1>{STORY}{part}{STORY}"
    text = op.main_text(SHELL % f'<div class="top"><ul>{links}</ul></div>{body}<div class="foot">Imprint</div>')
    assert text.startswith("Title\n\nSentence number 0") and text.count("Sentence number") == 18
    assert all(w in text for w in wanted) and "Place" not in text and "Imprint" not in text


@pytest.mark.parametrize("wrapper", ["<article>%s</article>", "<div>%s</div>"])
def test_lists_of_links_go(wrapper):
    links = "".join(f'<li><a href="/{i}">Place {i}</a></li>' for i in range(8))
    text = op.main_text(SHELL % (wrapper % f"{STORY}<ul>{links}</ul>{STORY}"))
    assert text.count("Sentence number") == 18 and "Place" not in text


def ratios_by_hand(page, named):
    """Tag-path ratios with every sum written out over the blocks of a path."""
    path = []
    for _, element in page.blocks:
        tags, at = [], element
        while at:
            tags.append(page.tags[at])
            at = page.parents[at]
        path.append((tuple(tags), named[element] > 0))
    same = [[j for j in range(len(path)) if path[j] == path[k]] for k in range(len(path))]
    marks = [sum(c in ".,;:!?…。，；：！？、¡¿" for c in block) for block, _ in page.blocks]
    length = [sum(len(page.blocks[j][0]) for j in own) / len(own) for own in same]
    stops = [sum(marks[j] for j in own) / len(own) for own in same]
    around = lambda x, k: (x[max(0, k - 1)] + 2 * x[k] + x[min(len(x) - 1, k + 1)]) / 4
    point = [(around(length, k) * (1 + around(stops, k))) ** 0.5 for k in range(len(path))]
    fused = [sum(point[j] for j in own) / len(own) for own in same]
    use = [k for k in range(len(path)) if not path[k][1]] or list(range(len(path)))
    mean = sum(fused[k] * len(page.blocks[k][0]) for k in use) / sum(len(page.blocks[k][0]) for k in use)
    raised = [any({"article", "main"} & set(path[j][0]) for j in own) for own in same]
    return [fused[k] * (0.2 if path[k][1] else 2 if raised[k] else 1) >= 0.5 * mean for k in range(len(path))]


def test_ratios_equal_those_by_hand(spark):
    sources = [r.html for r in table(spark, SAMPLE, "pages").limit(60).collect()]
    sources += [SHELL % (w % f"<h1>T</h1>{STORY}{part}{STORY}") for w in ("<article>%s</article>", "<div class='menu'>%s</div>x") for part, _ in INSIDE.values()]
    for source in sources:
        page = op.Page(source)
        named = page.named_below()
        assert op.chosen_blocks(page, named) == ratios_by_hand(page, named)
