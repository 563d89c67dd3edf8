import random

import pytest

from hazeframe.llm.html_extraction import Page, align, extract_text, main_text, parse, prune, text_key, tree_of


def text(page):
    return main_text(Page(page))


FURNITURE = [
    "<nav><ul><li><a href=/a>Menu</a></ul></nav>", "<header><a href=/>Site</a></header>", "<footer>&copy; 2024</footer>", "<aside><p>Side</p></aside>",
    "<div class='ad box'>Buy</div>", "<div id=cookie-notice>We use cookies</div>", "<form><label>Mail</label><input></form>", "<script>var t='<p>x</p>'</script>",
    "<style>p{}</style>", "<section class='post-comments'><article class=comment><p>First!</p></article></section>", "<div role=complementary>Links</div>",
    "<div class=sidebar><h2>More</h2></div>", "<noscript>Turn it on</noscript>", "<!-- <p>old</p> -->", "<button>Share</button>", "<div aria-hidden=true>x</div>",
]


def test_furniture_goes_and_the_article_stays():
    body = "".join(FURNITURE)
    page = f"<html><head><title>T</title></head><body>{body}<article><h1>Head &amp; line</h1>{body}<p>One\n  two&nbsp;three<p>Four <b>five</b><i>six</i></article>{body}</body></html>"
    assert text(page) == "Head & line\nOne two three\nFour fivesix"
    assert text(body + "<div><p>Only this</p></div>" + body) == "Only this"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"), ("<div>a<p>b</p>c</div>", "a\nb\nc"), ("a < b & c &lt; d", "a < b & c < d"),
        ("<p><b>x<br><p>y</p>", "x\ny"), ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\nb\nc\nd"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ("<p title='a > b'>x</p><p class=\"y>x</p>", "x\nx"), ("<script>if (a<b) '</p>'", ""), ("<p>x<!-- never closed <p>y", "x"), ("</p></div>x", "x"),
        ("<article class='has-comments'><p>x</p></article>", "x"), ("<form><main><p>x</p></main></form>", "x"), ("<ARTICLE><H1>x</H1></ARTICLE>y", "x"),
        ("<ul><li><a>a</a><li><a>b</a><li><a>c</a></ul><p>x <a>y</a>", "x y"), ("<article><header><h1>x</h1></header><p>y</article>", "x\ny"), ("<p>&#233;&eacute;&#x1F600;", "éé😀"),
    ],
)
def test_markup_of_all_kinds(page, want):
    assert text(page) == want


STORY = "<p>" + "A sentence of some length about the matter at hand. " * 4 + "</p>"
SAID = " ".join(("A sentence of some length about the matter at hand. " * 4).split())


@pytest.mark.parametrize(
    ("page", "want"),
    [
        # Forms around a whole page, and forms to fill in.
        ("<body><form action=x><input type=hidden><div><h1>Head</h1><p>Text of the page.</p></div></form></body>", "Head\nText of the page."),
        ("<form><nav>Menu</nav><h1>Head</h1><div class='share-buttons'><a>Like</a></div><p>Text</p><p>More</p><label>Find</label></form>", "Head\nText\nMore\nFind"),
        ("<h1>Contact</h1><form><p>We answer all letters within a day or two.</p><label>Name</label><label>Mail</label><button>Go</button></form>", "Contact"),
        ("<p>Story of the day.</p><form><p>Mail</p></form>", "Story of the day."),
        # Words that name subjects.
        ("<div class='post social-policy'><p>On pensions.</p></div>", "On pensions."),
        ("<main><p>Intro</p><div class='related work'><p>Others did so before.</p></div></main>", "Intro\nOthers did so before."),
        ("<main><p>Intro of some words</p><section id='share-prices'><h2>Prices</h2><p>They fell.</p></section></main>", "Intro of some words\nPrices\nThey fell."),
        (f"<article><p>Intro</p><div class=related>{STORY}</div></article>", f"Intro\n{SAID}"),
        ("<article><p>Intro of some words</p><div class='related-posts'><ul><li><a>One</a><li><a>Two</a></ul></div></article>", "Intro of some words"),
        ("<article><p>Intro of some words</p><div class='social-links'><p>Follow us</p></div></article>", "Intro of some words"),
        (f"<article><p>Intro</p><div class='related comments'>{STORY}</div></article>", "Intro"),
        (f"<article><p>Intro</p><div class=ad>{STORY}</div></article>", "Intro"),
        # Lists of links at a text's end, and menus.
        ("<div><p>Sources of the text above are these three.</p><ul><li><a>One</a><li><a>Two</a><li><a>Three</a></ul></div>", "Sources of the text above are these three.\nOne\nTwo\nThree"),
        ("<div><ul><li><a>One</a><li><a>Two</a><li><a>Three</a></ul></div><div><p>Text</p></div>", "Text"),
        ("<div><p>Text</p></div><div><ul><li><a>One</a><li><a>Two</a><li><a>Three</a></ul></div>", "Text"),
        # A teaser beside the text, and a short article beside short texts.
        (f"<article><p>Read this too</p></article><div class=content><h1>Head</h1>{STORY}</div>", f"Read this too\nHead\n{SAID}"),
        ("<article><p>Short story</p></article><div><p>Made with care in our own kitchen</p></div>", "Short story"),
        (f"<main><p>Short story</p></main><div>{STORY}</div>", "Short story"),
    ],
)
def test_words_and_forms_are_evidence_only(page, want):
    assert text(page) == want


def test_deep_nesting_and_very_long_pages():
    assert text("<div>" * 20_000 + "x" + "</div>" * 20_000 + "<p>y") == "x\ny"
    long = "".join(f"<p>paragraph {k}</p>" for k in range(20_000))
    assert text(long).count("\n") == 19_999
    assert align(list(range(20_000)), list(range(0, 40_000, 7))) == set(range(0, 20_000, 7))
    assert len(align([k // 2 for k in range(20_000)], [[[1, 2]], 5, [6]] * 10_000)) == 1


def keyed(page):
    return tree_of([text_key(b) for b in page.blocks], page.nesting())


def test_nesting_gives_the_tree_back():
    def plain(tree, page):
        return [text_key(page.blocks[c]) if isinstance(c, int) else plain(c, page) for c in tree[1] if isinstance(c, int) or holds(c)]

    def holds(tree):
        return any(isinstance(c, int) or holds(c) for c in tree[1])

    rng = random.Random(8)

    def markup(depth=0):
        if depth > 4 or rng.random() < 0.3:
            return f"<p>{rng.choice('abc')}</p>" * rng.randint(0, 2)
        return "<div>" + "".join(markup(depth + 1) for _ in range(rng.randint(0, 3))) + "</div>"

    def only(tree, wanted):
        out = [c if isinstance(c, int) else only(c, wanted) for c in tree if isinstance(c, list) or c in wanted]
        return [c for c in out if c != []]

    for _ in range(100):
        page = Page("x" + markup() + markup())
        numbers = list(range(len(page.blocks)))
        assert keyed(page) == plain(page.tree, page)
        some = set(rng.sample(numbers, len(numbers) // 2))
        assert tree_of([n for n in numbers if n in some], prune(page.nesting(), [n in some for n in numbers])) == only(tree_of(numbers, page.nesting()), some)


def test_simple_tree_matching_equals_the_plain_recursion():
    def plain(x, y):
        if isinstance(x, int) or isinstance(y, int):
            return int(x == y)
        m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, c in enumerate(x):
            for j, d in enumerate(y):
                m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + plain(c, d))
        return m[-1][-1]

    rng = random.Random(2)
    for _ in range(300):
        # Every key once on a side, so that aligned keys are as many as aligned texts.
        def tree(keys, depth=0):
            out = []
            while keys:
                n = rng.randint(1, len(keys))
                out.append(tree(keys[:n], depth + 1) if rng.random() < 0.5 and depth < 3 else keys[0])
                keys = keys[n:] if isinstance(out[-1], list) else keys[1:]
            return out

        a, b = (tree(rng.sample(range(10), rng.randint(0, 10))) for _ in range(2))
        want = plain(a, b)
        assert len(align(a, b)) == want
        assert align(a, a) == {k for k in range(10) if str(k) in str(a)}


def test_pages_in_disorder_do_not_hide_a_template(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefgh", k=7))
    rows = []
    for number in range(8):
        plate = [f"<p>{word()}</p>" for _ in range(6)]
        for k in range(12):
            texts = list(plate)
            if k == 5:
                rng.shuffle(texts)
            rows.append((100 * number + k, f"http://h{number}.example/", f"<body><div>{texts[0]}<p>Story {word()} {word()}</p>{''.join(texts[1:])}</div></body>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert all(r["text"].startswith("Story ") and "\n" not in r["text"] for r in extract_text(df).collect())


def test_repeated_texts_are_aligned_once_each():
    # The second list adds no key to the first, which can match one of the two.
    assert align([1, 1, [2, 3], [3, 2], 1], [1, [2], [3], 1]) in ({1, 2}, {1, 3})
    assert align([], [1]) == align([1], [[1]]) == set()


def test_templates_equal_alignment_of_all_pairs(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=7))
    rows, want = [], {}
    for number in range(6):
        plate = [word() + " " + word() for _ in range(5)]
        pages = []
        for k in range(8):
            texts = [f"<p>{t}</p>" for t in plate if rng.random() < 0.75]
            texts.insert(rng.randint(0, len(texts)), f"<p>{' '.join(word() for _ in range(20))}</p>")
            pages.append(f"<body><div>{''.join(texts)}</div></body>")
        parsed = [Page(p) for p in pages]
        keeps = [set().union(*(align(keyed(p), keyed(q)) for q in parsed if q is not p)) for p in parsed]
        constant = {k for k in set().union(*keeps) if sum(k in s for s in keeps) >= max(3, 0.6 * len(pages))}
        for k, p in enumerate(pages):
            rows.append((10 * number + k, f"http://h{number}.example/{k}", p))
            want[10 * number + k] = main_text(parsed[k], constant)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert {r["page_id"]: r["text"] for r in extract_text(df).collect()} == want


def host(n=12):
    return [
        (k, f"http://Shop.example.com:80/{k}", f"<body><div>Welcome to the shop</div><article><p>Story {k} tells {'of ' * k}things</p><p>Follow us on the net</p></article></body>")
        for k in range(n)
    ]


def test_constant_nodes_are_the_template(spark):
    rows = host() + [(100, "http://single.example.com/", host()[0][2]), (101, None, host()[1][2]), (102, "nonsense", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in extract_text(df).collect()}
    assert all(got[k] == f"Story {k} tells {'of ' * k}things" for k in range(12))
    # Without other pages of the host there is no template to learn.
    assert got[100].endswith("\nFollow us on the net") and got[101].endswith("on the net") and got[102] == ""


def test_host_of_copies_keeps_its_text(spark):
    page = "<article><h1>Title</h1><p>" + "the same long story " * 20 + "</p></article>"
    df = spark.createDataFrame([(k, "http://a.example/x", page + f"<p>{k}</p>") for k in range(20)], "page_id long, url string, html string")
    assert {r["n_chars"] for r in extract_text(df).collect()} == {len("Title\n") + len("the same long story " * 20) - 1}


def test_nulls_repeated_rows_clashing_columns_and_empty(spark):
    rows = [(None, None, "<p>a</p>", "h"), (1, "http://a/b", "<p>b</p>", "h"), (1, "http://a/b", "<p>b</p>", "h"), (2, "http://a/c", None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in extract_text(df).collect())
    assert got == [(0, "a", 1), (1, "b", 1), (1, "b", 1), (2, "", 0)]
    assert extract_text(df.limit(0)).count() == 0
    assert parse("").children == []


def test_templates_of_a_host_are_all_found(spark):
    rng = random.Random(5)
    story = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    plate = lambda kind: "".join(f"<p>{kind} {k} {'of the house ' * 20}</p>" for k in range(5))
    rows = []
    for k in range(12):
        # Boilerplate outweighs the article; two templates at half each; one page of a host, at 2 in 12, lacks a constant text.
        rows.append((k, "http://long.example/", f"<body><div class=x><p>{story(100)}</p>{plate('rule')}</div></body>"))
        side = "left" if k % 2 else "right"
        rows.append((100 + k, "http://two.example/", f"<body><div class={side}><p>{story(60)}</p><p>On the {side}</p></div></body>"))
        rows.append((200 + k, "http://most.example/", f"<body><div><p>{story(60)}</p>{'' if k in (3, 7) else '<p>Like us</p>'}</div></body>"))
        # Copies of an article, apart from a number, say nothing.
        rows.append((300 + k, "http://copy.example/", f"<body><div><p>{'the same long story ' * 20}</p><p>{k}</p></div></body>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in extract_text(df).collect()}
    first = {k: text(h).split("\n")[0] for k, _, h in rows}
    assert all(got[k] == first[k] for k in got if k < 300)
    assert all(got[k] == f"{first[k]}\n{k - 300}" for k in range(300, 312))
