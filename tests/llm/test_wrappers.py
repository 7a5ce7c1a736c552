import json

from corpusloom.llm import wrappers


def page(title, paragraphs, extra="", foot="all rights"):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (
        f'<!DOCTYPE html><html lang="en"><head><title>{title}</title><style>p{{}}</style><script>var t="</p>";</script></head>'
        f'<body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><!-- ad 1 -->'
        f'<div class="ad">Buy now</div><article><h1>{title}</h1>{body}{extra}</article><footer>&copy; {foot}</footer>'
    )


def bare(lines, nav="Home"):
    """A page without article."""
    rows = "".join(f"<p>{x}</p>" for x in lines)
    return f"<html><body><div>{nav}</div><div class='sidebar'>links</div>{rows}<p>Fixed notice of the host</p></body></html>"


PAGES = [
    (1, "http://a.example/1", page("First", ["One &amp; two.", "Three\n  four"]) + "</body></html>", "First\n\nOne & two.\n\nThree four"),
    (2, "https://a.example/2?x", page("Second", []), "Second"),
    (3, "https://A.example#f", page("Third", ["x"] * 30, "<p><b>bold<br>line</b> rest<p>open"), "\n\n".join(["Third"] + ["x"] * 30 + ["bold line rest", "open"])),
    (4, "https://a.example/4", None, ""),
    (5, "https://a.example/5", "", ""),
    (6, None, page("No address", ["&quot;q&quot; &lt;b&gt; &#233;&nbsp;x 1 < 2"]), 'No address\n\n"q" <b> é x 1 < 2'),
    (7, "https://b.example/1", page("Comments", ["text"], '<form>name<input></form><aside>more</aside><div class="comments"><article>me too</article></div>'), "Comments\n\ntext"),
    (8, "https://b.example/2", page("Cut", ["whole", "half"]).split("half")[0] + "half", "Cut\n\nwhole\n\nhalf"),
    (9, "https://b.example/3", "plain text without tags", "plain text without tags"),
    (10, "https://c.example/1", bare(["alpha", "beta"]), "alpha\n\nbeta"),
    (11, "https://c.example/2", bare(["gamma"]), "gamma"),
    (12, "https://c.example/3", bare(["delta", "eps", "zeta"]), "delta\n\neps\n\nzeta"),
    (13, "https://d.example/1", bare(["only page"]), "Home\n\nonly page\n\nFixed notice of the host"),
    (14, "https://e.example/1", '<main><header>by me</header><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></main>', "by me\n\none\n\ntwo\n\nc1\n\nc2"),
    (15, "https://e.example/2", "<body><p>a<!-- <p>no --> b<script>if (a < b) '</p>'</script> c</p><noscript>n</noscript>", "a b c"),
    (16, "https://f.example/1", page("Long", ["word " * 60_000]), "Long\n\n" + " ".join(["word"] * 60_000)),
]


def table(spark, rows):
    return spark.createDataFrame([(*r[:3], "x", 1) for r in rows], "page_id long, url string, html string, text string, host int")


def test_texts_of_pages(spark):
    got = {r["page_id"]: r["text"] for r in wrappers.main_text(table(spark, PAGES)).collect()}
    assert got == {r[0]: r[3] for r in PAGES}


def test_many_streams_are_aligned_in_parts(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "STREAMS_EACH", 2)
    monkeypatch.setattr(wrappers, "BROADCAST_BYTES", 0)
    got = {r["page_id"]: r["text"] for r in wrappers.main_text(table(spark, PAGES)).collect()}
    assert got == {r[0]: r[3] for r in PAGES}


def test_no_pages_and_repeated_rows(spark):
    assert wrappers.main_text(table(spark, [])).collect() == []
    assert len(wrappers.main_text(table(spark, PAGES[:1] * 3)).collect()) == 3


def test_groups_are_folded():
    assert wrappers.folded(list("abababc")) == [["+", "a", "b"], "c"]
    assert wrappers.folded(["ul", "li", "li", "/ul"] * 3) == [["+", "ul", ["+", "li"], "/ul"]]


def test_mismatches_become_optional_or_repeated():
    one = wrappers.folded(["h1", "p", "#", "/p", "foot"])
    many = wrappers.folded(["h1", "p", "#", "/p", "p", "#", "/p", "hr", "foot"])
    want = ["h1", ["+", "p", "#", "/p"], ["?", "hr"], "foot"]
    assert wrappers.aligned(one, many) == want == wrappers.aligned(many, one)
    assert wrappers.aligned(want, one) == want


def test_slots_of_a_page():
    wrapper = ["h1", ["+", "p", "#", "/p"], ["?", "hr"], "foot"]
    assert wrappers.slots(["h1", "p", "#", "/p", "p", "#", "/p", "foot"], wrapper) == [0, 1, 1, 1, 1, 1, 1, 3]
    assert wrappers.slots(["h1", "new", "hr", "foot"], wrapper) == [0, -1, 2, 3]


def test_one_wrapper_per_host(spark):
    got = {r["host"]: json.loads(r["wrapper"]) for r in wrappers.infer_wrappers(table(spark, [r for r in PAGES if r[2] is not None])).collect()}
    assert set(got) == {"a.example", "b.example", "c.example", "d.example", "e.example", "f.example", ""}
    assert '["+", "<li", "<a", "#x", "</a", "</li"]' in json.dumps(got["a.example"])


def test_fixed_texts_inside_the_article_are_no_text(spark):
    box = '<div class="more-to-read"><p>Readers also liked this</p></div>'
    rows = [(i, f"https://g.example/{i}", page(f"Title {i}", [f"text {i} {j}" for j in range(i)], box)) for i in range(1, 6)]
    rows += [(10 + i, f"https://h.example/{i}", page("Copy", ["the same"])) for i in range(4)]
    got = {r["page_id"]: r["text"] for r in wrappers.main_text(table(spark, rows)).collect()}
    want = {i: "\n\n".join([f"Title {i}"] + [f"text {i} {j}" for j in range(i)]) for i in range(1, 6)}
    assert got == want | {10 + i: "Copy\n\nthe same" for i in range(4)}


def test_text_outside_a_small_article_is_kept(spark):
    html = "<body><article><a>Teaser</a></article><div><h1>Main</h1><p>The long text of this page</p></div></body>"
    small = "<body><article><p>The long text of this page</p></article><div><p>by me</p></div></body>"
    got = {r["page_id"]: r["text"] for r in wrappers.main_text(table(spark, [(1, "http://i.example/", html), (2, "http://j.example/", small)])).collect()}
    assert got == {1: "Teaser\n\nMain\n\nThe long text of this page", 2: "The long text of this page"}


def test_long_wrappers_are_kept_whole():
    items = [f"<t{i}" for i in range(3_000)]
    assert wrappers.aligned(items, items) == items
