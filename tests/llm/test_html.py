import pytest

from marketframe.llm import html


def text(page):
    return html.main_text(page, html.trained_tree())


def test_the_tree_agrees_with_its_labelled_table():
    tree, right, total = html.trained_tree(), 0, 0
    for page in html.training_pages():
        blocks = html.blocks_of(page)
        kept = html.classify(tree, html.features(blocks)) > 0.5
        right += sum((b.mark == "main") == k for b, k in zip(blocks, kept))
        total += len(blocks)
    assert total > 500 and right >= 0.99 * total


def test_link_density_and_neighbours_decide_without_any_names():
    page = "<div>Home</div><div><a href=/>News</a></div><div><a href=/>Sport and more</a></div>" + "".join(
        f"<div>{'Some words of the story. ' * n}</div>" for n in (12, 9, 15)
    ) + "<div><a href=/>About</a></div><div>All rights reserved</div>"
    lines = text(page).split("\n")
    assert len(lines) == 3 and all(x.startswith("Some words") for x in lines)


def test_a_tree_learns_a_threshold():
    import numpy as np

    rows = np.array([[0.0, 5], [1, 6], [2, 7], [3, 8], [4, 9], [5, 1]])
    tree = html.grow_tree(rows, np.array([0.0, 0, 0, 1, 1, 1]))
    assert html.classify(tree, rows).tolist() == [0, 0, 0, 1, 1, 1]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("   \n ", ""),
        ("<article><p>a &amp; b&nbsp;&#233; &lt;i&gt;</p></article>", "a & b é <i>"),
        ("<article><p>one\n  two\tthree<br>four<p>five", "one two three four\nfive"),
        ("<article><p>x<b>y</b>z</p><script>var a='</p>';</script><style>p{}</style><!-- no --></article>", "xyz"),
        ("<article><h1>Title</h1><p>Body of it</article><footer>&copy; nobody</footer>", "Title\nBody of it"),
        ("<nav><a href=x>menu</a></nav><article><p>Hi</p></article>", "Hi"),
        ("<article><p>Hi</p></article><div class='comments'><article><p>me too, and a lot more to say</p></article></div>", "Hi"),
        ("<form><p>Your name and your address please</p><input value=x></form><article><p>Hi</p></article>", "Hi"),
        ("<div class='cookie-notice'>We use cookies to know all about you</div><article><p>Hi</p></article>", "Hi"),
        ("<div class='sideBar'><p>" + "aside " * 40 + "</p></div><article><p>Hi</p></article><ol class=commentlist><li>I say no</ol>", "Hi"),
        ("<div class='page has-sidebar'><article><p>Hi</p><p>there</p></article></div>", "Hi\nthere"),
        ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
        ("<article><p title='a>b'>c</p></article>", "c"),
        ("<article><header><h1>T</h1></header><p>p</p></article><header>site</header>", "T\np"),
        ("<div id=content><p>" + "long text " * 30 + "</p></div><div class=sidebar><p>other " * 5, ("long text " * 30).strip()),
    ],
)
def test_pages(page, want):
    assert text(page) == want


def test_long_and_broken_pages():
    body = "word " * 300_000
    assert text(f"<article><p>{body}</p></article>") == body.strip()
    assert text("<article>" + "<p>a</p>" * 20_000) == "\n".join(["a"] * 20_000)
    assert text("<article><p>x" + "<a title='" * 2_000).startswith("x")


def test_rows(spark):
    rows = [(1, "u", "<article><p>hi</p></article>", "x"), (None, None, None, "y"), (1, "u", "<article><p>hi</p></article>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(html.extract(pages).collect(), key=str)
    assert [tuple(r) for r in got] == [(1, "u", "hi", 2), (1, "u", "hi", 2), (None, None, "", 0)]
    assert html.extract(pages.limit(0)).collect() == []


def test_formulas_and_fallbacks_of_objects_are_text():
    long = "the committee of the old harbour met on a grey morning to hear what its members had found in the archive"
    page = (
        f"<body><article><p>{long} <math><semantics><mrow><mi>v</mi><mo>=</mo><mfrac><mn>7</mn><mn>4</mn></mfrac></mrow>"
        f"<annotation encoding='x'>v=\\frac74</annotation></semantics></math>, as {long}.</p>"
        f"<p>{long} <object data='a.pdf'><param name='n' value='v'>tables of the harbour</object> {long}.</p></article></body>"
    )
    blocks = [b.text for b in html.Flattener().read(page)]
    assert blocks == [f"{long} v = 7 4, as {long}.", f"{long} tables of the harbour {long}."]
    assert text(page) == "\n".join(blocks)


@pytest.mark.parametrize(
    ("written", "want"),
    [
        (" style='overflow: hidden' class=x", {"style": "overflow: hidden", "class": "x"}),
        (' title="my hidden gem" HIDDEN', {"title": "my hidden gem", "hidden": ""}),
        (" data-x=\"a 'class=ad' b\" id = 'main' /", {"data-x": "a 'class=ad' b", "id": "main"}),
        (" class=one class=two checked=", {"class": "one", "checked": ""}),
        (" 'stray' \"role='ad'", {"stray": "", "role": "ad"}),
        ("", {}),
    ],
)
def test_attributes(written, want):
    assert html.attributes_of(written) == want


@pytest.mark.parametrize(
    "page",
    [
        "<div style='overflow: hidden'>{}</div>",
        "<article style=\"overflow: hidden\">{}</article>",
        "<article data-state='class=ad hidden'>{}</article>",
        "<main aria-hidden='false' title='hidden'>{}</main>",
    ],
)
def test_values_of_attributes_hide_nothing(page):
    body = [" ".join([w] * 40) for w in ("alpha", "beta")]
    assert text(page.format("".join(f"<p title='my hidden gem'>{p}</p>" for p in body))).split("\n") == body
    assert text(page.format(f"<p>{body[0]}</p><p hidden>{body[1]}</p>")) == body[0]


@pytest.mark.parametrize(
    "page",
    [
        "<span>x " * 100_000 + "</i>" * 100_000,
        "<i><div>" + "<span>x " * 100_000 + "</i>" * 100_000,
        "<div>x " * 100_000,
        "<a " * 100_000,
        "<li>x <b>" * 50_000 + "</ul>" * 50_000,
        "<p>x<!-- " * 50_000,
        "<table><tr><td>" * 50_000,
    ],
)
def test_reading_is_linear(page):
    import time

    start = time.process_time()
    html.blocks_of(page)
    assert time.process_time() - start < 2


def test_comments_that_never_end():
    assert text("<article><p>Hi</p><!-- <p>no</p> and on") == "Hi"
