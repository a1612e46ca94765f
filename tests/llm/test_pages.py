import pyarrow as pa
from hypothesis import given, strategies as st

from keyfold.llm import pages


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for k, y in enumerate(b):
            new.append(row[k] + 1 if x == y else max(row[k + 1], new[-1]))
        row = new
    return row[-1]


@given(st.lists(st.integers(0, 3), max_size=14), st.lists(st.integers(0, 3), max_size=14), st.sampled_from([2, 1 << 25]))
def test_shared_lines(a, b, cells):
    kept, pages.CELLS = pages.CELLS, cells
    try:
        got = pages.shared_lines(a, b)
    finally:
        pages.CELLS = kept
    assert len(got) == brute_lcs(a, b) and got == sorted(set(got))
    rest = iter(b)
    assert all(any(x == a[i] for x in rest) for i in got)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>Home</ul></nav>
<div class="cookie-notice">We use cookies</div><!-- c --><article><h1>Head &amp; tail</h1><p><b>One&nbsp;two
three<br>four<p>five <script>var t="</p>";</script>six</p><form><input>Send</form><section class="comments"><article>Nice!</article></section>
<aside>Side</aside></article><div id="sidebar">S</div><footer>F</footer></body></html>"""


def test_blocks():
    main = [t for t, z in pages.blocks(PAGE) if z == pages.MAIN]
    assert main == ["Head & tail", "One two three four", "five six"]
    assert pages.blocks(None) == pages.blocks("") == [] and pages.blocks("a <!-- b") == [("a", pages.FREE)]
    assert pages.blocks("<p>x < y</p><div hidden>z</div>") == [("x < y", pages.FREE), ("z", pages.OFF)]


def test_extract(spark):
    def bare(k):
        return f"<body><p>Welcome to our site</p><p>Story number {k} is here.</p><p>All rights reserved by us</p></body>"
    rows = [(k, f"https://h.example.org/a/{k}?q={k}", bare(k), "x") for k in range(12)]
    rows += [(20, "https://other.example.org/", bare(20), "x"), (21, "https://h.example.org/b", PAGE, "x"), (22, "https://h.example.org/b2", PAGE, "x"),
             (23, None, None, "x"), (24, "odd url", "", "x"), (25, "https://m.example.org/1", bare(1), "x"), (26, "https://m.example.org/2", bare(1), "x"),
             (None, "https://h.example.org/a/1?q=1", bare(99), None), (3, rows[3][1], rows[3][2], "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(4)
    got = {}
    for r in pages.extract(df).collect():
        got.setdefault(r["page_id"], []).append((r["text"], r["n_chars"], r["url"]))
    for k in range(12):
        assert all(x[0] == f"Story number {k} is here." and x[1] == len(x[0]) for x in got[k])
    assert len(got[3]) == 2 and got[None][0][0] == "Story number 99 is here."
    assert got[20][0][0].count("\n") == 2                            # no neighbour on its host
    assert got[21][0][0] == got[22][0][0] == "Head & tail\nOne two three four\nfive six"   # shared, but the article's own
    assert got[23][0][:2] == ("", 0) and got[24][0][:2] == ("", 0) and got[25][0][0].count("\n") == 2   # mirrors
    assert pages.extract(df.limit(0)).count() == 0


def text_of(page, others=()):
    found = pages.marked_blocks(page)
    gone = set()
    if others:
        (row,) = pages._lines([pa.RecordBatch.from_pydict({"k": [1], "h": ["h"], "p": ["/"], "t": [page]})])
        gone = set(pages.chrome_lines(*(row.column(i)[0].as_py() for i in (3, 4, 5)),
                                      [[pages.line_hash(t) for t, _ in pages.blocks(o)] for o in others])[1])
    zones = {z for _, z, _ in found}
    zone = pages.MAIN if pages.MAIN in zones else pages.FREE if pages.FREE in zones else pages.NAMED
    return "\n".join(t for k, (t, z, _) in enumerate(found) if z == zone and k not in gone)


def test_names_that_only_look_like_chrome():
    assert text_of("<div class='page-with-sidebar'><p>Story</p></div>") == "Story"
    for name in ("id='social-policy'", "class='share-price'", "id='notice-of-meeting'"):
        assert text_of(f"<article><p>One</p><div {name}>Two</div></article>") == "One\nTwo"
    assert text_of("<div>body</div><article class='comment'>Nice post!</article>") == "body"
    for name in ("recommended", "signup-box", "tags", "pagination", "commentList", "site-footer", "post__share"):
        assert text_of(f"<article><p>One</p><div class='{name}'>Two</div></article>") == "One"
    assert text_of("<div class='widget'><p>All there is</p></div>") == "All there is"


def test_differencing_decides_in_articles():
    def page(k, extra="", quote="A line that all pages quote."):
        return (f"<article><h1>Title {k}</h1><p class='t'>Body {k} one.</p><p class='t'>{quote}</p><p class='t'>Body {k} two.</p>"
                f"<div class='teaser'><p>Read on, dear friend</p><p>More for you</p></div>{extra}</article>")
    kept = "Title 1\nBody 1 one.\nA line that all pages quote.\nBody 1 two."
    teaser = "\nRead on, dear friend\nMore for you"
    assert text_of(page(1), [page(0), page(2)]) == kept
    assert text_of(page(1), [page(0)]) == kept + teaser                                   # one neighbour is no proof
    assert text_of(page(1), [page(1), page(1), page(0)]) == kept + teaser                 # mirrors are no witnesses
    assert text_of(page(1, "<div class='teaser'>Mine</div>"), [page(0), page(2)]) == kept + teaser + "\nMine"


def test_marked_parts_of_a_host(spark):
    rows = [(k, f"https://h.example.org/a/{k:02}", f"<main><p>Story {k} here.</p><div class='teaser'>Read on</div></main>") for k in range(6)]
    got = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got == {k: f"Story {k} here." for k in range(6)}
