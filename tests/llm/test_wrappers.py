from __future__ import annotations

import pyarrow as pa

from ticketmill.llm import wrappers

from .frames_for import rows_of

SHELL = ("<!DOCTYPE html><html><head><title>T {n}</title><script>var a='<p>no</p>'</script></head><body>"
         "<header><h2>Site</h2></header><nav><ul><li><a href=/>Home</a></li><li>About</li></ul></nav>"
         "<div class='cookie-notice'>We use cookies</div>{body}<aside>More news</aside>"
         "<form><input><button>Go</button>Your mail</form><footer>&copy; site</footer></body></html>")
ARTICLE = ("<article><h1>Title &amp; {n}</h1><p>First  <b>bold</b>\n text&nbsp;{n}</p><div class='ad'>Buy</div>"
           "<p>Second<br>line {n}<p>Third &lt;tag&gt; &#233; {n}</p><ul><li>one {n}</li><li>two {n}</li></ul>"
           "<section class='comments'><p>Great post!</p></section></article>")
WANT = "Title & {n}\nFirst bold text {n}\nSecond line {n}\nThird <tag> é {n}\none {n}\ntwo {n}"


def pages_frame(spark, rows):
    ids, urls, htmls = zip(*rows) if rows else ((), (), ())
    return spark.createDataFrame(pa.table({
        "page_id": pa.array(ids, pa.int64()), "url": pa.array(urls, pa.string()),
        "html": pa.array(htmls, pa.string()), "host": pa.array([9] * len(ids), pa.int64()),
        "text": pa.array([9] * len(ids), pa.int64())}))


def test_articles_of_hosts(spark):
    rows, want = [], {}
    for n in range(12):
        rows.append((n, f"https://a.example/{n}", SHELL.format(n=n, body=ARTICLE.format(n=n))))
        want[n] = WANT.format(n=n)
    for n in range(20, 26):  # a host without an article element
        body = f"<div class='page'><div class='text'><p>{'Words of page ' * 9}{n}</p><p>end {n}</p></div></div>"
        rows.append((n, f"http://B.example:80/{n}?x#y", SHELL.format(n=n, body=body)))
        want[n] = f"{('Words of page ' * 9)}{n}\nend {n}"
    odd = [(30, None, None), (31, "https://a.example/e", ""), (32, "not a url", "just  text"),
           (33, "https://a.example/f", SHELL.format(n=1, body="")), (34, "https://c.example/", "<p>cut off <b>he"),
           (0, "https://a.example/0", SHELL.format(n=0, body=ARTICLE.format(n=0))),
           (None, "https://a.example/z", SHELL.format(n=7, body=ARTICLE.format(n=7))),
           (35, "https://a.example/deep", "<div>" * 3000 + "deep" + "</div>" * 3000)]
    want |= {30: "", 31: "", 32: "just text", 33: "", 34: "cut off he", None: WANT.format(n=7), 35: "deep"}
    got = rows_of(wrappers.extract(pages_frame(spark, rows + odd)))
    assert len(got) == len(rows) + len(odd)
    for r in got:
        assert r["text"] == want[r["page_id"]], r["page_id"]
        assert r["n_chars"] == len(r["text"])
    assert wrappers.extract(pages_frame(spark, [])).collect() == []


def test_mismatches_become_optional_repeated_and_slots():
    one = "<body><h1>A</h1><p>x</p><p>y</p></body>"
    two = "<body><h1>B</h1><div>note</div><p>z</p><hr></body>"
    three = "<body><h1>C</h1><p>q</p><p>r</p><p>s</p></body>"
    assert wrappers.infer([one, two, three]).pattern() == \
        "<#root><body><h1>#</>(<div>\"note\"</>)?(<p>#</>)+(<hr></>)?</></>"


def test_aligning_more_pages_never_loses_a_tag():
    pages = [f"<body>{'<p>a</p>' * (n % 3)}{'<ul><li>b</li></ul>' * (n % 2)}<h1>{n}</h1></body>" for n in range(7)]
    pattern = wrappers.infer(pages).pattern()
    for tag in ("<p>", "<ul>", "<li>", "<h1>"):
        assert tag in pattern
    assert "(<p>\"a\"</>)+?" in pattern


def test_names_are_hints_only():
    story = f"<h1>Head</h1><p>{'A long story ' * 20}end</p>"
    want = f"Head\n{'A long story ' * 20}end"
    for before, after in (
            ("<body class='no-sidebar'>", "</body>"), ("<body class='sidebar'>", "</body>"),
            ("<div id='wrap' class='content-with-sidebar'>", "</div>"),
            ("<div class='overflow-hidden'>", "</div>"), ("<div class='hidden'>", "</div>"),
            ("<article class='related'>", "</article>"), ("<main id='banner'>", "</main>")):
        page = f"<html>{before}{story}{after}<div class='ad'>Buy</div></html>"
        assert want in wrappers.main_text(page, None), before
    inside = story.replace("<h1>Head</h1>", "<div class='{}'><h1>Head</h1></div>")
    for name in ("entry-header", "header"):
        assert wrappers.main_text(f"<article>{inside.format(name)}</article>", "article") == want
    for name in ("ad", "ad-slot", "adBox", "cookie-notice", "comments", "comment-list", "ad ad-3"):
        page = f"<article>{story}<div class='{name}'>Buy</div></article>"
        assert wrappers.main_text(page, "article") == want, name


def texts_of(spark, pages):
    rows = [(n, f"https://h.example/{n}", page) for n, page in enumerate(pages)]
    return {r["page_id"]: r["text"] for r in rows_of(wrappers.extract(pages_frame(spark, rows)))}


def story(n, words=30):
    return " ".join(f"w{n * 1000 + k}" for k in range(words))


def test_every_template_of_a_host_has_its_own_wrapper(spark):
    posts = [f"<body><h2>Site</h2><article class='post post-{n}'><h1>T{n}</h1><p>{story(n)}</p></article></body>" for n in range(8)]
    docs = [f"<body><h2>Site</h2><main><p>{story(100 + n)}</p><p>{story(200 + n)}</p></main>"
            f"<article class='post'>teaser only</article></body>" for n in range(3)]
    split = [f"<body><article class='lead'>Lead {n}</article><div>x</div><article class='body'><p>{story(300 + n)}</p></article></body>"
             for n in range(5)]
    plain = [f"<body><div class='wrap'><div class='t'><p>{story(400 + n)}</p></div><div>Site text</div></div></body>" for n in range(5)]
    got = texts_of(spark, [*posts, *docs, *split, *plain])
    for n in range(8):
        assert got[n] == f"T{n}\n{story(n)}"
    for n in range(3):
        assert got[8 + n] == f"{story(100 + n)}\n{story(200 + n)}"
    for n in range(5):
        assert got[11 + n] == f"Lead {n}\n{story(300 + n)}" and got[16 + n] == story(400 + n)


def test_fixed_text_of_the_host_goes_and_copies_stay(spark):
    frame = "<article><p>Filed under News.</p><p>{}</p><p>Again {}</p><div>Read next: the other one</div></article>"
    pages = [frame.format(story(n), n % 3) for n in range(10)]
    # the same page under many urls is one page, and a copy with another menu keeps its text
    pages += [frame.format(story(50), 7)] * 30 + [f"<nav>{n}</nav><article><p>{story(60)}</p></article>" for n in range(2)]
    got = texts_of(spark, pages)
    for n in range(10):
        assert got[n] == f"{story(n)}\nAgain {n % 3}"
    assert got[20] == f"{story(50)}\nAgain 7" and got[41] == story(60)
    copies = [f"<nav>menu {n}</nav><article><h1>One</h1><p>{story(70)}</p></article>" for n in range(9)]
    assert set(texts_of(spark, copies).values()) == {f"One\n{story(70)}"}
    few = [f"<article><p>Filed under News.</p><p>{story(n)}</p></article>" for n in range(3)]  # too few to tell
    assert texts_of(spark, few)[0] == f"Filed under News.\n{story(0)}"


def test_reader_comments_go():
    for name in ("user-comments", "reader-responses", "discussion", "disqus_thread", "commentList", "post-replies"):
        for attribute in ("class", "id"):
            page = f"<article><p>{story(1)}</p><div {attribute}='{name}'><p>So true!</p></div></article>"
            assert wrappers.main_text(page) == story(1), name


def test_wrappers_come_back_from_rows_and_align_in_any_grouping():
    pages = [f"<body><article><h1>{n}</h1>{'<p>a b</p>' * (n % 4)}<ul>{'<li>x</li>' * n}</ul>"
             f"{'<table><tr><td>1' * (n % 2)}</article><p>Foot</p></body>" for n in range(6)]
    one = wrappers.infer(pages)
    assert wrappers._tree(wrappers._rows(one)).pattern() == one.pattern()
    fixed = {m for p in pages for m in wrappers.text_marks(wrappers.parse(p)) if sum(
        m in wrappers.text_marks(wrappers.parse(q)) for q in pages) == 6}
    trees = [wrappers.as_wrapper(wrappers.parse(p), fixed) for p in pages]
    left = wrappers.align(wrappers.align(trees[0], trees[1]), trees[2])
    right = wrappers.align(wrappers.align(trees[3], trees[4]), trees[5])
    both = wrappers.align(left, right)
    assert both.pages == 6 and [n.path for n in wrappers.region(both)] == [n.path for n in wrappers.region(one)]
    assert len(wrappers.fixed_marks(both)) == 1  # the foot


def test_templates_by_named_elements(spark):
    pages = ["<body><MAIN ><article id=1 class='post-12 x'>", "<article class=post-7><main>", "<p>none", None,
             "<article data-x='1'><articles>"]
    frame = pages_frame(spark, [(n, "u", p) for n, p in enumerate(pages)])
    got = {r["page_id"]: r["template"] for r in wrappers.host(frame).collect()}
    assert got == {0: "article.post-0 main", 1: "article.post-0 main", 2: "", 3: "", 4: "article"}


def test_very_deep_and_very_long_pages(spark):
    deep = "<div>" * 40_000 + f"<p>{story(1)}</p>" + "</div>" * 40_000
    long = "<article>" + "".join(f"<p>{story(n)}</p>" for n in range(3000)) + "</article>"
    got = texts_of(spark, [deep, long])
    assert got[0] == story(1) and got[1] == "\n".join(story(n) for n in range(3000))
