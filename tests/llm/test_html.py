from lexispark.llm import html
from pyspark.sql import functions as F

PAGE = """<!DOCTYPE html><html lang="en"><head><title>T &amp; t</title><style>p{margin:0}</style><script>var t="</p><p>no</p>";</script></head>
<body class="no-sidebar"><header class="top"><p>Site</p></header><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy now</div>
<article class="has-comments"><header><h1>Head&nbsp;line &#233;&lt;</h1></header><p><b>One
 two.<br><p>Three <i>in</i>line</p><ul><li>x<li>y</ul><form><input><label>name</label></form><aside>side</aside><div id="comments"><p>nice!</p></div></article>
<div class="cookie-notice">We use cookies</div><footer>&copy; us</footer></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def texts(df):
    return {r.page_id: r.text for r in df.collect()}


def test_article_without_its_surroundings():
    body = [t for p, t in html.blocks(PAGE) if p == html.BODY]
    assert body == ["Head line é<", "One two.", "Three inline", "x", "y"]


def test_open_tags_and_broken_markup():
    assert html.blocks("<article><p>a<p>b<div>c</article>d") == [("body", "a"), ("body", "b"), ("body", "c"), ("open", "d")]
    assert html.blocks("plain < text &amp") == [("open", "plain < text &")]
    assert html.blocks("<script>x") == html.blocks("") == html.blocks(None) == html.blocks("<!-- a") == []
    assert html.blocks("<p hidden>x</p><main>y</main>") == [("body", "y")]


def test_named_pages_keep_repeated_passages(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"http://h.org/{i}", f"<nav>menu</nav><article><p>{passage}</p><p>own {i}</p></article>") for i in range(4)]
    assert texts(html.extract(pages(spark, rows))) == {i: f"{passage}\nown {i}" for i in range(4)}


def test_suffix_array_removes_what_a_host_repeats(spark):
    menu = "home news sport weather travel about us"
    tail = "all rights reserved by the owner of this site since ever"
    page = lambda i: f"<div>{menu}</div><div>story{i} " + " ".join(f"u{i}x{j}" for j in range(20)) + f"</div><div>{tail}</div>"
    rows = [(i, f"http://a.org/{i}", page(i)) for i in range(3)]
    rows += [(7, "http://b.org/7", page(0)), (8, None, page(0)), (9, "http://a.org/0", page(0))]  # other hosts; a copy of page 0
    out = texts(html.extract(pages(spark, rows)))
    for i in range(3):
        assert out[i] == f"story{i} " + " ".join(f"u{i}x{j}" for j in range(20))
    assert out[9] == out[0] and out[7] == out[8] and out[7].startswith(menu) and out[7].endswith(tail)


def test_covered_blocks_against_brute_force(spark):
    import random

    rng = random.Random(4)
    shared = [" ".join(f"s{k}t{j}" for j in range(9)) for k in range(4)]
    pages_of = {i: [" ".join(rng.choice([*shared, f"p{i}q{rng.randrange(50)}", "the"]) for _ in range(rng.randint(1, 3))) for _ in range(9)] for i in range(8)}
    out = texts(html.extract(pages(spark, [(i, f"http://h/{i}", "".join(f"<p>{t}</p>" for t in own)) for i, own in pages_of.items()])))
    stream = {i: " ".join(own).split() for i, own in pages_of.items()}
    grams = {i: {tuple(w[a : a + html.LONG]) for a in range(len(w) - html.LONG + 1)} for i, w in stream.items()}
    lost = 0
    for i, own in pages_of.items():
        w, gone, at, left = stream[i], set(), 0, []
        for a in range(len(w) - html.LONG + 1):
            if sum(tuple(w[a : a + html.LONG]) in g for g in grams.values()) >= html.PAGES:
                gone |= set(range(a, a + html.LONG))
        for block in own:
            n = len(block.split())
            if not gone >= set(range(at, at + n)):
                left.append(block)
            at += n
        lost += len(own) - len(left)
        assert out[i] == "\n".join(left)
    assert lost > 5


def test_quotations_and_passages_of_two_pages_stay(spark):
    quote = "to be or not to be that is the question"
    page = lambda i: f"<div>site menu with links to all of it</div><p>own{i} " + " ".join(f"x{i}y{j}" for j in range(12)) + f" {quote} end{i}</p>"
    rows = [(i, f"http://h/{i}", page(i) + (f"<p>{quote} again and again</p>" if i < 2 else "")) for i in range(5)]
    out = texts(html.extract(pages(spark, rows)))
    assert all(out[i].startswith(f"own{i}") and f"{quote} end{i}" in out[i] for i in range(5))
    assert all(out[i].endswith("again and again") for i in range(2))


def test_attributes_are_read_as_names_and_values():
    body = lambda inner: [t for p, t in html.blocks(f"<article>{inner}</article>") if p == html.BODY]
    assert body('<p title="a hidden gem">kept</p>') == ["kept"]
    assert body("<p data-x=it's>Hello one</p><p>Don't worry</p>") == ["Hello one", "Don't worry"]
    assert body('<p title="x>Hello</p>') == ["Hello"]
    assert body('<p title="a > b">Hello</p><p alt=\'"\'>there</p>') == ["Hello", "there"]
    assert body('<h2 id="related-work">Related work</h2><section id="social-effects"><p>text</p></section>') == ["Related work", "text"]
    assert body('<p>A <span class="share-price">12</span> rise, <i class="ad-hoc">ad hoc</i></p>') == ["A 12 rise, ad hoc"]
    assert body('<h2 id="comments">Comments</h2><p class="section">x</p><div class="post-list">y</div>') == ["Comments", "x", "y"]
    for gone in ("<p hidden>x</p>", '<p HIDDEN="">x</p>', "<p aria-hidden=true>x</p>", '<p style="color:red; display : none">x</p>', '<div id="comments">x</div>', '<div class="social-share buttons">x</div>', '<ul class="related-posts"><li>x</ul>', "<div class='ad'>x</div>"):
        assert body(gone) == [], gone


def test_awkward_pages(spark):
    long = "<article>" + "<p>" + "word " * 200_000 + "</p></article>"
    rows = [(1, None, None), (2, "x", ""), (None, None, "<p>a</p>"), (3, "http://h/3", long), (3, "http://h/3", long), (4, "::", "<article></article>")]
    df = pages(spark, rows).select("*", *[F.lit("z").alias(c) for c in ("host", "blocks", "text", "key", "covers")])
    out = [(r.page_id, r.text, r.n_chars) for r in html.extract(df).collect()]
    assert sorted(out, key=str) == sorted([(1, "", 0), (2, "", 0), (None, "a", 1), (3, ("word " * 200_000).strip(), 999_999), (3, ("word " * 200_000).strip(), 999_999), (4, "", 0)], key=str)
    assert html.extract(pages(spark, [])).count() == 0


def test_mirrors_and_print_views_keep_their_text(spark):
    story = " ".join(f"m{j}" for j in range(40))
    page = lambda menu: f"<nav>{menu}</nav><div>{story}</div>"
    rows = [(1, "http://h/a", page("all of the menu in one line")), (2, "http://h/a?print=1", page("print")), (3, "http://h/mirror/a", page("all of the menu in one line"))]
    rows += [(4, "http://h/s", "<div>short one</div>"), (5, "http://h/s2", "<p>short one</p>"), (6, "http://g/a", rows[0][2])]
    out = texts(html.extract(pages(spark, rows)))
    assert out == {1: story, 2: story, 3: story, 4: "short one", 5: "short one", 6: story}


def test_the_same_html_on_two_hosts_is_judged_on_each(spark):
    note = "this note stands on every page of the first host only"
    page = lambda i: f"<div>{note}</div><div>own{i} " + " ".join(f"x{i}y{j}" for j in range(9)) + "</div>"
    rows = [(1, "http://a/1", page(1)), (2, "http://a/2", page(2)), (3, "http://b/1", page(1))]
    out = texts(html.extract(pages(spark, rows)))
    assert out[1].startswith("own1") and out[2].startswith("own2") and out[3].startswith(note)


def test_what_stands_outside_a_named_main_part_is_judged_too(spark):
    """Open blocks of pages with an article: the host's own go, a text of the
    page stays in its place, as often as the page is copied."""
    line = "this line stands on every page of the host"
    page = lambda i: f"<nav>menu</nav><div>{line}</div><p>lead {i} of the story</p><article><p>body {i}</p><p>{line}</p></article><p>after {i}</p><div>{line}</div>"
    rows = [(i, f"http://h/{i}", page(i)) for i in range(4)] + [(9, "http://h/copy", page(0)), (10, "http://g/10", page(0))]
    rows += [(11, "http://h/11", "<nav>menu</nav><article>marked</article><footer>all of it</footer>")]
    out = texts(html.extract(pages(spark, rows)))
    for i in (0, 1, 2, 3, 9):
        n = i % 9
        assert out[i] == f"lead {n} of the story\nbody {n}\n{line}\nafter {n}", out[i]
    assert out[10] == f"{line}\nlead 0 of the story\nbody 0\n{line}\nafter 0\n{line}"  # no other page of its host
    assert out[11] == "marked"
