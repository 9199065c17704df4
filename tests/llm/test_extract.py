import pytest

from opsledger.llm import extract

TREE = extract.train()
PROSE = "The river rose for three days and then fell again, and nobody in the town had seen such a flood before."

CASES = [
    ("", ""), (None, ""), ("   ", ""), ("<p", ""), (f"<article><p>{PROSE}</p></article>", PROSE),
    (f"<article><h1>A &amp; B&nbsp;&#233;</h1><p>x  \n y<br>z<p>{PROSE}</article>", f"A & B é\n\nx y z\n\n{PROSE}"),
    (f"<head><title>t</title><style>p{{}}</style></head><body><nav><a href=/>Home</a></nav><article><p>{PROSE}</p>"
     f"<script>var t='</p>';</script><!-- <p>no</p> --><p>Yes.</p></article><footer>{PROSE}</footer>", f"{PROSE}\n\nYes."),
    (f"<article><p>{PROSE}</p><div class='comments'><p>{PROSE}</p></div></article>", PROSE),
    (f"<article><p>{PROSE}</p><aside><p>{PROSE}</p></aside><form><p>Name</p></form></article>", PROSE),
    (f"<div class=\"cookie-notice\">{PROSE}</div><div class=\"ad\">{PROSE}</div><main><p>{PROSE}</p></main>", PROSE),
    (f"<article><p title=\"a > b\">{PROSE}</p><p>cut &am", f"{PROSE}\n\ncut &am"),
    (f"<article><p>{PROSE}</p></arti", PROSE), ("<article><p>1 < 2 & 3</p></article>", "1 < 2 & 3"),
    ("<ARTICLE><P>Upper Case.</P></ARTICLE>", "Upper Case."),
]


@pytest.mark.parametrize("html,want", CASES)
def test_main_text(html, want):
    assert extract.main_text(TREE, html) == want


def test_tree_fits_its_table():
    for page in extract.PAGES:
        known = extract.blocks(page)
        assert [extract.decide(TREE, r) for r in extract.features(known)] == [b.keep for b in known]


def test_long_and_deep_pages_take_linear_time():
    assert extract.main_text(TREE, "<div>" * 50_000 + "x") is not None
    assert extract.main_text(TREE, "<article>" + "<p>a b c d</p>" * 20_000).count("\n\n") == 19_999
    assert extract.main_text(TREE, "<a b='" * 30_000) is not None
    assert extract.main_text(TREE, "</div>" * 50_000 + "<" * 50_000) is not None


def test_frame(spark):
    rows = [(i, "u", h, "x") for i, (h, _) in enumerate(CASES)] + [(None, None, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: r.found for r in frame.select("page_id", extract.extract(frame).alias("found")).collect()}
    assert got == {i: w for i, (_, w) in enumerate(CASES)} | {None: ""}
    assert frame.limit(0).select(extract.extract(frame)).count() == 0


@pytest.mark.parametrize("html,want", [
    *((f"<body><nav><a href=/>Home</a></nav>{a}<p>{PROSE}</p>{b}<footer>{PROSE}</footer></body>", PROSE) for a, b in [
        ("<main class='has-sidebar'>", "</main>"), ("<div class='no-sidebar'><article>", "</article></div>"),
        ("<div class='content-sidebar-wrap'><main>", "</main></div>"), ("<article class='post legal'>", "</article>"),
        ("<div class='search'><article>", "</article></div>"), ("<div id=widget><div class=menu><main>", "</main></div></div>")]),
    (f"<div class='search'><div class='sidebar'><p>{PROSE}</p></div><article><p>Yes.</p></article></div>", "Yes."),
    (f"<article><p>Yes.</p></article><section id='comments'><article><p>{PROSE}</p></article></section>", "Yes."),
    *((f"<article><p>Before.</p><{x}><p>{PROSE}</p></article>", f"Before.\n\n{PROSE}")
      for x in ("svg", "math", "object", "canvas", "select", "noscript", "template")),
    (f"<article><p>Before.</p><script><p>{PROSE}</p></article>", "Before."),
    (f"<article><p>Before.</p><svg><text>{PROSE}</text></svg><p>After.</p></article>", "Before.\n\nAfter."),
])
def test_wrappers_and_elements_without_end(html, want):
    assert extract.main_text(TREE, html) == want


def test_many_elements_without_end_take_linear_time():
    assert extract.main_text(TREE, "<article>" + "<svg><p>a b c d</p>" * 20_000).count("\n\n") == 19_999
    assert extract.main_text(TREE, "<div class=menu>" * 20_000 + "<article><p>Yes.") == "Yes."


def splits(tree):
    return {extract.FEATURES[tree[0]]} | splits(tree[2]) | splits(tree[3]) if isinstance(tree, tuple) else set()


def test_tree_splits_on_words_links_and_neighbours():
    used = splits(TREE)
    assert {"words", "links"} <= used and used & {"words_before", "links_before"} and used & {"words_after", "links_after"}


@pytest.mark.parametrize("html,want", [
    (f"<div class='container sidebar-right'><div><h2>A title</h2><p>{PROSE}</p><p>{PROSE}</p></div></div>", f"A title\n\n{PROSE}\n\n{PROSE}"),
    (f"<body><div class='menu'><a href=/1>One</a></div><div id='widget'><p>{PROSE}</p><p>{PROSE}</p></div><div class='ad'>Buy now.</div></body>",
     f"{PROSE}\n\n{PROSE}"),
    (f"<body><div class='sidebar'><p>{PROSE}</p><p>{PROSE}</p></div><article><p>{PROSE}</p></article></body>", PROSE),
    (f"<body><p>{PROSE}</p><p>{PROSE}</p><div id='comments'><p>{PROSE}</p><p>{PROSE}</p></div></body>", f"{PROSE}\n\n{PROSE}"),
])
def test_pages_that_mark_no_article_are_decided_by_words_and_neighbours(html, want):
    assert extract.main_text(TREE, html) == want
