import html
import itertools
import random
import re
import time

from starmart.llm.html_extraction import extract, html_extraction, label_blocks, min_cut, op1_html_extraction

SF = "/root/testdata/sf0.001"
LONG = "A sentence of the article that goes on for a while, with a comma and some more words to read. "


def test_min_cut_is_optimal():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randrange(1, 9)
        unary = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(i, j, rng.uniform(0, 3)) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def cost(label):
            return sum(abs(u) for u, x in zip(unary, label) if (u > 0) != x) + sum(w for i, j, w in edges if label[i] != label[j])

        best = min(cost(x) for x in itertools.product([False, True], repeat=n))
        assert abs(cost(min_cut(unary, edges)) - best) < 1e-9


def test_min_cut_of_many_undecided_blocks():
    rng = random.Random(6)
    n = 20_000
    unary = [rng.uniform(-1, 1) for _ in range(n)]
    edges = [(i, i + 1, rng.uniform(0.5, 2)) for i in range(n - 1)]
    start = time.time()
    label = min_cut(unary, edges)
    assert time.time() - start < 20
    best = {True: 0.0, False: 0.0}  # of a chain, by dynamic programming
    for i, u in enumerate(unary):
        tie = edges[i - 1][2] if i else 0.0
        best = {x: min(best[x], best[not x] + tie) + (abs(u) if (u > 0) != x else 0.0) for x in best}
    got = sum(abs(u) for u, x in zip(unary, label) if (u > 0) != x) + sum(w for i, j, w in edges if label[i] != label[j])
    assert abs(got - min(best.values())) < 1e-6


def test_cut_mends_labels_of_single_blocks():
    """Headings, list items and cells say too little by themselves; the blocks around them decide."""
    one = LONG.strip()
    page = f"""<div id=top><a href=1>One</a> <a href=2>Two</a></div><div>
    <h2>Why</h2><p>{LONG * 2}</p><ul><li>first step</li><li>second step</li><li>third step</li></ul>
    <p>{LONG * 2}</p><h2>How</h2><p>{LONG * 2}</p><div>So it ends</div><p>{LONG * 2}</p></div><div><a href=3>Three</a> <a href=4>Four</a></div>"""
    texts, unary, label = label_blocks(page)
    two = f"{one} {one}"
    want = ["Why", two, "first step", "second step", "third step", two, "How", two, "So it ends", two]
    assert [t for t, x in zip(texts, label) if x] == want
    wrong = [t for t, u in zip(texts, unary) if (u > 0) != (t in want)]
    assert {"first step", "second step", "third step"} <= set(wrong) and extract(page)[2] == len(wrong)
    # and the other way: one sentence among links goes with the links
    page = f"<div><p>{LONG * 2}<p>{LONG * 2}</div><ul>" + "<li><a href=x>Some other page</a></li>" * 3 + \
        "<li>One plain line that reads like a short sentence of text.</li>" + "<li><a href=x>Some other page</a></li>" * 3 + "</ul>"
    assert extract(page)[0] == [two, two]


def test_no_single_name_empties_a_page():
    one = LONG.strip()
    body = f"<p>{LONG}</p><p>{LONG}</p><p>{LONG}</p>"
    for page in (f"<form action=x><div>{body}</div></form>",
                 f"<form><nav><ul><li><a href=1>Home</a></li><li><a href=2>All</a></li></ul></nav><div>{body}</div></form>",
                 f"<div class='site-wrapper menu-open'><div class=content>{body}</div></div>",
                 f"<div class='container has-sidebar'><div class=content>{body}</div></div>",
                 f"<div class='page legal'><div class=content>{body}</div></div>",
                 f"<article class='promo-story'>{body}</article>",
                 f"<article class='post comments-open'>{body}</article>",
                 f"<main><p>{LONG}</p><p>{LONG}</p><section class='related-work'><p>{LONG}</p></section></main>"):
        assert extract(f"<body>{page}</body>")[0] == [one] * 3, page


def test_boilerplate_after_an_article():
    one = LONG.strip()
    for after in ("<p>Copyright 2020 Some Paper. All rights reserved, and so are many others in this and that land.</p>",
                  f"<div class='reader-reactions'><p>{LONG}</p></div>", f"<article class='promo-story'><p>{LONG}</p></article>",
                  f"<div><p>{LONG}</p></div>"):
        assert extract(f"<body><article>{f'<p>{LONG}</p>' * 4}</article>{after}</body>")[0] == [one] * 4, after


def test_page_with_all_kinds_of_boilerplate():
    page = f"""<!DOCTYPE html><html><head><title>T</title><script>var a="<p>x</p>";</script><style>p{{}}</style></head>
    <body><header class="site-header"><h1>Site</h1></header><nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav>
    <div class="cookie-notice"><p>{LONG}</p></div>
    <article><header><h1>Fish &amp; chips</h1></header><p>{LONG * 2}<!-- <p>no</p> -->
    <p>Second&nbsp;one: 1 &lt; 2,<br>still the <b>same</b> block.</p><div class="advert">{LONG}</div>
    <blockquote>{LONG}</blockquote><ul><li>{LONG}</li></ul>
    <form action=x><label>Mail</label><input name=m><button>Send</button></form>
    <section id="comments"><article><p>{LONG}</p></article></section></article>
    <aside><p>{LONG}</p></aside><p hidden>{LONG}</p><footer><p>&copy; 2020 {LONG}</p></footer></body></html>"""
    one = LONG.strip()
    kept = extract(page)[0]
    assert kept == ["Fish & chips", f"{one} {one}", "Second one: 1 < 2, still the same block.", one, one]


def test_broken_pages():
    assert extract("") == ([], 0, 0)
    assert extract("<article><p>" + LONG + "<p>" + LONG[:-3] + " a &lt; b <p class='x")[0] == [LONG.strip(), LONG[:-3] + " a < b"]
    assert extract("<nav><ul><li><a href=/>Home</a><article><p>" + LONG)[0] == [LONG.strip()]
    assert extract("<script>if (a<b) {" + LONG)[0] == []
    assert extract("<div title='" + "x" * 100_000)[0] == []
    assert extract("<p>" * 20_000 + LONG)[0] == [LONG.strip()]
    assert len(extract(("<div><p>" + LONG + "</div><div><a href=x>" + LONG + "</a></div>") * 2_000)[0]) == 2_000


def test_plain_page_without_semantic_elements():
    page = "<body><div id=top><a href=1>One</a> <a href=2>Two</a></div><div>" + "".join(f"<p>{LONG}</p>" for _ in range(4)) + "<p>Short.</p></div>"
    assert extract(page)[0] == [LONG.strip()] * 4 + ["Short."]


def test_names_around_an_article():
    one = LONG.strip()
    for around in ("<html class='nav-open'><body>", "<body class='has-sidebar'>", "<body id=x class='comments-open'>",
                   "<div class='page legal'>", "<div id=search-page><div class='overlay'>"):
        for tag in ("article", "main", "article class='has-sidebar'", "div role=main"):
            assert extract(f"{around}<{tag}><p>{LONG}<p>{LONG}")[0] == [one, one], (around, tag)
    assert extract(f"<body class='has-sidebar'><article><p>{LONG}<div class=sidebar><p>{LONG}</div></article>")[0] == [one]
    for held in ("<div class='comments'><article>", "<div class='advert'><article>", "<article class='related-posts'>", "<div role=banner><article>"):
        assert extract(f"<body>{held}<p>{LONG}")[0] == [], held


def test_attribute_names_are_whole():
    for attribute in ("title='a hidden valley'", "data-hidden='false'", 'title="role=banner class=advert"', "data-class=advert",
                      "x-style='display:none'", "aria-hidden=false", "title = 'it is hidden'"):
        assert extract(f"<article><p {attribute}>{LONG}")[0] == [LONG.strip()], attribute
    for attribute in ("hidden", "title='x' hidden", "HIDDEN=''", "aria-hidden='true'", "style='display: none'", "data-x=1 class=advert"):
        assert extract(f"<article><p {attribute}>{LONG}")[0] == [], attribute


def test_hidden_elements_end():
    one = LONG.strip()
    for start in ("<svg class='i'/>", "<svg viewBox='0 0 1/2 2' />", "<math/>", "<p><button>Go</p>", "<p><button class=b>Go",
                  "<div><button>Go</div><div><button>No</button></div>", "<svg><path d='1'/></svg>", "<button><div>Go</div></button>"):
        assert extract(f"<article>{start}<p>{LONG}<p>{LONG}</article>")[0] == [one, one], start
    assert extract(f"<article><p>{LONG}<button>{LONG}")[0] == [one]
    assert extract(f"<article><svg><text>{LONG}</text></svg><p>{LONG}")[0] == [one]


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, "u", None, "a"), (1, "u", "", "b"), (None, None, "<article><p>" + LONG, "c")],
                               "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, r.url, r.text) for r in html_extraction(df).collect()), key=str)
    assert got == sorted([(1, "u", ""), (1, "u", ""), (None, None, LONG.strip())], key=str)
    assert html_extraction(df.limit(0)).collect() == []


def test_query_finds_the_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in op1_html_extraction(spark, SF).collect()}
    assert got.keys() == pages.keys()
    for k, page in pages.items():
        body = re.sub(r"<[^>]*$", "", re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)[1])
        want = [" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert got[k].text == "\n".join(filter(None, want)) and got[k].n_chars == len(got[k].text)
