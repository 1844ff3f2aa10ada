import random

import pytest

from larkspan.llm import html_extraction as m

PAGE = '<html><head><title>T</title></head><body><header>Top</header><div id="c">Menu one</div><p>Hello &amp; bye<br>x<p>Second  para<div class="ad">no</div><script>var t="</p>"</script><footer>f</footer>'


@pytest.mark.parametrize(
    "html, inside, every",
    [
        ("", [], []),
        ("plain < text", [], ["plain < text"]),
        (PAGE, [], ["Menu one", "Hello & bye x", "Second para"]),
        ("<nav>n</nav><article><h1>T &lt;</h1><p><b>a.<br><p>b\n c</p><aside>s</aside></article><p>out</p>", ["T <", "a.", "b c"], ["T <", "a.", "b c", "out"]),
        ("<article><p>a</p><section class='comments'><p>me too</p></section><!-- x > y --><style>p{}</style></article>", ["a"], ["a"]),
        ('<main><p title="a > b">q</p><div hidden>h</div><form>f</form></main>', ["q"], ["q"]),
        ("<article><p>cut <script>never closed", ["cut"], ["cut"]),
        ("<p>a<p>b</div></p>c", [], ["a", "b", "c"]),
        ("<div class='ad-slot'>x</div><div class='comment-list'>y</div><div class='article-header'>z</div>", [], ["z"]),
        ('<article><svg viewBox="0 0 1 1"/><p>not lost</p></article>', ["not lost"], ["not lost"]),
        ("<article><video-title>cap</video-title><p>rest</p></article>", ["cap", "rest"], ["cap", "rest"]),
        ('<body><div class="content with-sidebar"><p>Main text</p></div></body>', [], ["Main text"]),
        ('<article><div class="post-header"><h1>Title</h1></div><p>b</p></article>', ["Title", "b"], ["Title", "b"]),
        ('<article><p>see <a class="related">this</a> and <span class="search">that</span></p></article>', ["see this and that"], ["see this and that"]),
        ('<div class="menu"><p>Soup of the day</p><p>Bread</p></div><div class="sidebar">x</div>', [], ["Soup of the day", "Bread"]),
        ('<article><p>a</p><div class="comments"><p>a far longer comment</p></div></article>', ["a"], ["a"]),
    ],
)
def test_blocks(html, inside, every):
    assert m.blocks(html) == (inside, every)


def longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("table_bits", [m.TABLE_BITS, 6])
def test_shared_lines_are_longest_common_subsequences(table_bits):
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(14))] for _ in range(2))
        found = sorted(m.shared_lines(a, b, table_bits))
        rest = iter(b)
        assert len(found) == longest(a, b) and all(a[i] in rest for i in found)


def test_very_long_pages_align_in_linear_space():
    n = 20_000
    a = [f"a{i}" if i % 3 else "t" for i in range(n)]
    b = [f"b{i}" if i % 5 else "t" for i in range(n)]
    assert len(m.shared_lines(a, b, 1 << 20)) == min(a.count("t"), b.count("t"))


def test_mates_across_parts(spark):
    rng = random.Random(2)
    keys = [(i, f"h{rng.randrange(3)}" if i else "alone", f"/{rng.choice('ab')}/{rng.randrange(60)}") for i in range(150)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.id: r.mate for r in m.mates(spark.createDataFrame(keys, "id long, host string, path string").repartition(5)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    order = sorted((h, p, i) for i, h, p in keys)
    for k, (h, p, i) in enumerate(order):
        near = [(order[j][2], m._prefix(p, order[j][1])) for j in (k - 1, k + 1) if 0 <= j < len(order) and order[j][0] == h]
        assert got[i] == (max(near, key=lambda x: x[1])[0] if near else None)


def brute(rows):
    """The docstring's rule, page by page."""
    read = []
    for i, url, html in rows:
        inside, every = m.blocks(html or "")
        read.append((*m.place(url), i, url, bool(inside), inside or every))
    hosts = {}
    for r in read:
        for x in r[5]:
            hosts.setdefault(x, set()).add(r[0])
    order = sorted(range(len(read)), key=lambda k: (read[k][0], read[k][1], k))
    out = []
    for at, k in enumerate(order):
        host, path, i, url, marked, lines = read[k]
        near = [order[j] for j in (at - 1, at + 1) if 0 <= j < len(order) and read[order[j]][0] == host]
        gone = set()
        if near:
            mate = max(near, key=lambda j: m._prefix(path, read[j][1]))
            gone = m.shared_lines(lines, read[mate][5])
            if marked and 2 * sum(len(lines[x]) for x in gone) >= sum(map(len, lines)):
                gone = set()
            gone = {x for x in gone if not marked or hosts[lines[x]] == {host}}
        out.append((i, url, "\n".join(x for n, x in enumerate(lines) if n not in gone), len(lines), len(gone)))
    return sorted(out, key=repr)


def test_extract_against_brute_force(docs):
    """Marked and unmarked pages with template lines, phrases of several hosts, near copies; ids repeat, some are null."""
    rng = random.Random(3)
    rows = []
    for i in range(120):
        host = f"h{rng.randrange(4)}.x"
        own = [f"line {rng.randrange(10_000)} of {host}" for _ in range(rng.randrange(2, 7))]
        if i % 7 == 0 and rows:
            own = [f"copied line {k}" for k in range(5)] + own[:1]
        text = [f"Template of {host}", *own, "A phrase that all have", f"Shared by readers of {host}"]
        body = "".join(f"<p>{x}</p>" for x in text)
        rows.append((None if i % 29 == 5 else i // 2, f"http://{host}/{rng.choice('ab')}/{i:03}", f"<article>{body}</article><p>out</p>" if i % 3 else f"<div>{body}</div>"))
    rows += [(900, None, None), (901, "http://[bad", ""), (902, "http://alone.x/", "<p>only</p>"), rows[4]]
    got = m.extract(docs(rows, "page_id long, url string, html string").coalesce(1))
    found = sorted(((r.page_id, r.url, r.text, r.n_lines, r.n_template) for r in got.collect()), key=repr)
    assert found == brute(rows)
    lines = "\n".join(x[2] for x in found)
    assert 0 < lines.count("Template of") < 40 and lines.count("A phrase that all have") > 60  # near copies keep theirs


def test_extract(docs):
    rows = [(1, "http://h.x/a/1", PAGE), (2, "http://h.x/a/2", PAGE.replace("Hello", "Howdy")), (2, "http://h.x/a/2", "<p>only</p>"), (7, "http://g.x/a/1", "<article>" + "word " * 50_000 + "</article>"), (8, "http://g.x/a/2", "<article>" + "<p>x y</p>" * 30_000 + "</article>")]
    got = sorted((r.page_id, r.text) for r in m.extract(docs(rows, "page_id long, url string, html string")).collect())
    # the pages of equal URL are each other's mates, and share nothing
    assert got[:3] == [(1, "Hello & bye x"), (2, "Menu one\nHowdy & bye x\nSecond para"), (2, "only")]
    assert got[3:] == [(7, ("word " * 50_000).strip()), (8, "\n".join(["x y"] * 30_000))]
    assert m.extract(docs([], "page_id long, url string, html string")).count() == 0
