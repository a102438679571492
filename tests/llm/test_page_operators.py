"""Pages, URLs and vectors."""

import random
from collections import Counter
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from junctura.llm import epsgrid, htmltree, queries, urltrie

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x = "</p><p>no</p>";</script></head>
<body class="has-sidebar"><header><h2>Site</h2></header><nav><ul><li><a href="/a">Menu, one</a></li></ul></nav>
<div class="cookie-notice">We use cookies, many, many cookies.</div><div id="wrap"><!-- <p>gone</p> -->
<article><h1>Head &amp; line</h1><p>First, long paragraph, with <b>bold,<br>text</b> and &eacute;&nbsp;&#233;; it goes on, and on.
<p>Second   one, <a href="x">with a link</a>, tail.<div class="ad">Buy, now, this.</div><form><input value="x">Send</form>
<section><h2>Part</h2><p>Third, in a section.</p></section></article>
<aside>Related, things, here.</aside><div class="comments"><p>Reader, says, much, more, than, all.</p></div></div>
<footer>&copy; Foot, note</footer></body></html>"""


def test_article_without_the_rest():
    want = "Head & line First, long paragraph, with bold, text and é é; it goes on, and on. Second one, with a link, tail. Part Third, in a section."
    assert htmltree.extract(PAGE) == want


def test_without_article_element():
    page = "<body><div id=nav><a href=x>One</a> <a href=y>Two</a></div><div class=story><h1>Name</h1><p>Text, that is, long enough to count, really.</p><p>More, of it, follows here.</p></div><div class=footer>Foot</div></body>"
    assert htmltree.extract(page) == "Name Text, that is, long enough to count, really. More, of it, follows here."


def paragraphs(name, n):
    return [f"{name} number {i} is a sentence, with a comma, that goes on for a while." for i in range(n)]


def as_p(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


def test_article_in_several_wrappers():
    one, two = paragraphs("First", 5), paragraphs("Second", 5)
    page = f"<body><nav><a href=x>Menu</a></nav><div class=row><div class=col>{as_p(one)}</div></div><div class=row><div class=col>{as_p(two)}</div></div><footer>Foot</footer></body>"
    assert htmltree.extract(page) == " ".join(one + two)
    lead, body, end = paragraphs("Lead", 1), paragraphs("Body", 12), paragraphs("End", 1)
    page = f"<body><div><div>{as_p(lead)}</div><div>{as_p(body)}</div><section>{end[0]}</section><div><a href=x>More, of, this</a></div></div></body>"
    assert htmltree.extract(page) == " ".join(lead + body + end)


@pytest.mark.parametrize("article", ["<article>{}</article>", "<main><article>{}</article></main>", "<div class=story><h1>Title</h1>{}</div>", "<main><div>{}</div></main>"])
@pytest.mark.parametrize("thread", ["<div class=comments>{}</div>", "<div id=comments><ul><li class=comment><article class=comment-body>{}</article></li></ul></div>", "<section class=related>{}</section>"])
def test_long_threads_go(article, thread):
    own, said = paragraphs("Own", 3), paragraphs("Said", 40)
    want = ("Title " if "Title" in article else "") + " ".join(own)
    assert htmltree.extract(f"<body>{article.format(as_p(own))}{thread.format(as_p(said))}</body>") == want
    if "main" in article:
        inside = article.format(as_p(own)).replace("</main>", thread.format(as_p(said)) + "</main>")
        assert htmltree.extract(f"<body>{inside}</body>") == want


def replies(n, shape="<li class=x><cite>Ann</cite> <time>2024-03-0{k}</time><p>{text}</p><a href=r>Reply</a></li>"):
    return "".join(shape.format(k=k % 9 + 1, text=t) for k, t in enumerate(paragraphs("Said", n)))


@pytest.mark.parametrize("thread", [
    "<ol class=commentlist>{}</ol>", "<div class=discussion-thread>{}</div>", "<div class=user-reviews>{}</div>", "<div id=feedback>{}</div>", "<ul class=xk3>{}</ul>", "<section><h2>What you say</h2><ul class=b>{}</ul></section>",
])
@pytest.mark.parametrize("article", ["<main><article>{}</article>{}</main>", "<main><h1>Title</h1>{}{}</main>", "<div class=story><h1>Title</h1>{}</div>{}"])
def test_comments_go_by_name_and_by_structure(article, thread):
    own = paragraphs("Own", 3)
    want = ("Title " if "Title" in article else "") + " ".join(own)
    got = htmltree.extract(f"<body>{article.format(as_p(own), thread.format(replies(12)))}</body>")
    assert "Said" not in got and got.replace("What you say", "").strip() == want


def test_lists_with_dates_in_an_article_stay():
    items = [f"In version {i}, of 2024-03-0{i + 1}, the parser got faster, and smaller." for i in range(5)]
    page = f"<body><article>{as_p(paragraphs('Own', 2))}<ul>{''.join(f'<li>{t}</li>' for t in items)}</ul></article></body>"
    assert htmltree.extract(page) == " ".join(paragraphs("Own", 2) + items)


def test_notices_in_compound_words_go_and_prose_stays():
    own = paragraphs("Own", 4)
    assert htmltree.extract(f"<body><div class=story>{as_p(own)}</div><div class=cookieconsent><p>{paragraphs('Cookie', 1)[0]}</p></div></body>") == " ".join(own)
    prose = "This sentence, in a span that is named for sharing, belongs to the text."
    assert htmltree.extract(f"<body><article><p>{own[0]} <span class=share>{prose}</span> {own[1]}</p><p>Tail. <span class=share><a href=x>Share, this</a></span></p></article></body>") == f"{own[0]} {prose} {own[1]} Tail."
    loose = "Some loose text stands between the two containers, and it is prose as well."
    page = f"<body><nav><a href=x>Menu</a></nav><div><div>{as_p(own[:2])}</div>{loose}<div>{as_p(own[2:])}</div></div></body>"
    assert htmltree.extract(page) == " ".join([*own[:2], loose, *own[2:]])


def test_many_marked_siblings_take_linear_time():
    import time

    own = paragraphs("Own", 3)
    page = f"<body><article>{as_p(own)}</article>{'<div class=ad>Buy</div>' * 20_000}</body>"
    began = time.process_time()
    assert htmltree.extract(page) == " ".join(own)
    assert time.process_time() - began < 3


def test_pages_null_repeated_and_none(spark):
    rows = spark.createDataFrame([(1, "u", None), (2, None, ""), (3, "v", "<p>a, b</p>"), (3, "v", "<p>a, b</p>")], "page_id long, url string, html string")
    found = htmltree.main_text(rows)
    assert sorted((r.page_id, r.text, r.n_chars) for r in found.collect()) == [(1, "", 0), (2, "", 0), (3, "a, b", 4), (3, "a, b", 4)]
    assert htmltree.main_text(rows.where("false")).collect() == []


@pytest.mark.parametrize("wrapper", ["<div class='layout has-sidebar'>{}</div>", "<div id=menu-page><div class=sidebar-left>{}</div></div>", "<main><div class=with-comments>{}</div></main>"])
def test_layout_wrappers_stay(wrapper):
    own = paragraphs("Own", 6)
    page = f"<body><p>Site</p>{wrapper.format('<article>' + as_p(own) + '<div class=comments>' + as_p(paragraphs('Said', 30)) + '</div></article>')}</body>"
    assert htmltree.extract(page) == " ".join(own)


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("plain, words", "plain, words"), ("<p>cut <b", "cut"), ("<article><p>a &am", "a &am"), ("<script>x", ""), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
    ("</p></div><p>ends</b> early</p>", "ends early"), ("<nav>only</nav>", ""), ("<a title='it>s'>x</a>", "x"),
])
def test_odd_pages(page, text):
    assert htmltree.extract(page) == text


def test_random_markup_never_fails():
    rng = random.Random(1)
    bits = ["<p>", "</p>", "<div class='ad x'>", "</div>", "<b", ">", "text, more", "<li>", "<table><tr><td>", "</table>", "&amp;", "<!--", "-->", "<script>", "</script>", "<article>", "</article>", "'", '"', "<br/>", "</"]
    for _ in range(3000):
        htmltree.extract("".join(rng.choice(bits) for _ in range(rng.randint(0, 40))))


def test_deep_and_long_pages():
    assert htmltree.extract("<div>" * 20_000 + "<p>deep, text</p>") == "deep, text"
    long = "word, " * 50_000
    assert htmltree.extract(f"<article><p>{long}</p></article>") == " ".join(long.split())


def test_pages_of_the_table(spark):
    """The generated pages keep all of their article and nothing else."""
    import re

    got = queries.op3_html(spark, "/root/testdata/sf0.001").toPandas().set_index("page_id")
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    for r in rows:
        body = r.html[r.html.index("<article>") + 9 :].partition("</article>")[0]
        blocks = (" ".join(unescape(re.sub("</?b>", "", x)).split()) for x in re.split("<br>|</?p>|</?h1>", body))
        assert got.loc[r.page_id, "text"] == " ".join(b for b in blocks if b)
        assert got.loc[r.page_id, "n_chars"] == len(got.loc[r.page_id, "text"])


def plain_rule(host, path, rules):
    fits = [(len(h.split(".")), len(p), v == "block", v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[3:] if fits else None


def test_trie_is_the_plain_search():
    rng = random.Random(4)
    label, segment = ["a", "b", "com", "net"], ["", "x", "xy", "7", "78"]
    host = lambda: ".".join(rng.choice(label) for _ in range(rng.randint(1, 4)))
    path = lambda: "".join("/" + rng.choice(segment) for _ in range(rng.randint(0, 4)))
    for _ in range(300):
        rules = list({(h, p): (rng.choice(["allow", "block"]), h, p) for h, p in ((host(), path()) for _ in range(12))}.values())
        trie = urltrie.Trie(rules)
        for _ in range(30):
            h, p = host(), path()
            got = trie.find(h, p)
            assert (got and got[2:]) == plain_rule(h, p, rules)


@pytest.mark.parametrize(("url", "parts"), [
    (None, ("", "")), ("no scheme/x", ("", "")), ("http://A.É.com", ("a.É.com", "")), ("x://h?q=/a", ("h", "")), ("x://h/p/q?r#s", ("h", "/p/q")), ("x://h#/a?b", ("h", "")), ("://", ("", "")), ("a://b://c/d", ("b:", "//c/d")),
])
def test_split_url(url, parts):
    assert urltrie.split_url(url) == parts


def test_many_rules_of_a_host_and_paths_without_a_slash():
    import time

    rules = [("block", "big.org", f"/p{i:x}" + "q" * (i % 50)) for i in range(100_000)] + [("block", "big.org", "en"), ("allow", "big.org", "/p1")]
    trie = urltrie.Trie(rules)
    assert trie.find("big.org", "/zz") is None and trie.find("big.org", "/en") is None
    urls = [f"/p{i:x}" + "q" * (i % 50) + "/rest" for i in range(0, 100_000, 50)]
    began = time.process_time()
    found = [trie.find("x.big.org", u) for u in urls]
    assert (time.process_time() - began) / len(urls) < 0.0005
    assert all(f[3].startswith("big.org/p") and u.startswith(f[3].removeprefix("big.org")) for f, u in zip(found, urls))


def test_rules_beyond_one_trie(spark):
    urls = spark.createDataFrame([(1, "http://a.example.com/en/7817"), (2, "http://x.com/en/9"), (3, None), (4, "http://z.net/de/x")], "page_id long, url string").withColumn("host", F.lit(0))
    want = [tuple(r["__judged"]) for r in urltrie.judge(urls, queries.URL_RULES).orderBy("page_id").collect()]
    got = [tuple(r["__judged"]) for r in urltrie.judge(urls, queries.URL_RULES, max_rules=2).orderBy("page_id").collect()]
    assert got == want and [w[2:] for w in want] == [("example.com/en/7", "allow"), ("com/en/", "block"), (None, "allow"), ("net/de/", "block")]
    assert urltrie.judge(urls, []).where("__judged.verdict <> 'allow'").isEmpty()


def test_verdicts_are_those_of_the_contract(spark, tmp_path):
    want = {
        "http://a.com/en/1": ("com/en/", "block"), "http://example.com/en/7": ("example.com/en/7", "allow"), "http://a.net/de/1": ("net/de/", "allow"),
        "http://example.net/de/7": ("net/de/", "allow"), "http://x.example.net/de/81": ("example.net/de/8", "block"), "http://a.org/es/1": ("org/es/", "block"),
    }
    spark.createDataFrame(list(enumerate(want)), "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.op4_url_filter(spark, str(tmp_path)).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in got] == list(want.values())


def test_urls_of_empty_tables_long_urls_and_clashing_names(spark):
    kind = "page_id long, url string, __found0 string, __next0 string, __judged string, host string, verdict string"
    assert urltrie.judge(spark.createDataFrame([], kind), queries.URL_RULES).collect() == []
    rows = [(1, "http://" + "a." * 50_000 + "com/en/" + "x/" * 50_000, "f", "n", "j", "h", "v"), (None, "http://com/en/", None, None, None, None, None)] * 2
    for most, chars in ((5, 1 << 20), (1, 1 << 20), (5, 1)):
        got = urltrie.judge(spark.createDataFrame(rows, kind), queries.URL_RULES, max_rules=most, max_chars=chars)
        assert got.columns == [c.split()[0] for c in kind.split(", ")]
        assert sorted((r.page_id or 0, r["__found0"], r["__next0"], r["__judged"].rule, r["__judged"].verdict) for r in got.collect() if r.page_id) == [(1, "f", "n", "com/en/", "block")] * 2
        assert got.where("__judged.rule = 'com/en/'").count() == 4


def test_rules_are_cut_by_number_and_by_characters():
    rules = [("block", "h" * n, "/p") for n in (1, 3, 3, 50, 1, 1, 1)]
    assert [[len(h) for _, h, _ in part] for part in urltrie._parts(rules, 2, 10)] == [[1, 3], [3], [50], [1, 1], [1]]
    assert urltrie._parts([], 2, 10) == [[]]


def test_vectors(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((8, 16))
    rows = [(i, (base[i % 8] + 0.15 * rng.standard_normal(16)).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200 + i, rng.standard_normal(16).astype(np.float32).tolist()) for i in range(60)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, [2 * x for x in rows[0][1]]), rows[5], (None, rows[1][1])]
    odd = [(400, None), (401, []), (402, [0.0] * 16), (403, [float("nan")] + [1.0] * 15), (404, [float("inf")] + [1.0] * 15), (405, [None] + [1.0] * 15), (406, [1.0] * 3)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("node", "unit", "n", "label")})
    got = epsgrid.near_vectors(frame.repartition(3)).collect()
    x = np.array([r[1] for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, True)
    label = np.arange(len(rows))
    while not np.array_equal(new := np.array([label[near[i]].min() for i in range(len(rows))]), label):
        label = new
    least = {}
    for (i, _), k in zip(rows, label):
        least[k] = min((v for v in (least.get(k), i) if v is not None), default=None)
    want = Counter((i, int(near[k].sum()) - 1, least[label[k]], i == least[label[k]]) for k, (i, _) in enumerate(rows))
    want.update((i, 0, i, True) for i, _ in odd)
    assert Counter(map(tuple, got)) == want


def test_no_vectors(spark):
    assert epsgrid.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    got = epsgrid.near_vectors(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).collect()
    assert [tuple(r) for r in got] == [(1, 0, 1, True)]


def test_recursion_skips_and_finds():
    rng = np.random.default_rng(7)
    x = np.concatenate([c + 0.05 * rng.standard_normal((700, 8)) for c in np.eye(8)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    pairs = set()
    for a, b in epsgrid._join(x, x, (0, len(x)), (0, len(x)), 0.98, np.sqrt(0.04)):
        pairs |= set(zip(a.tolist(), b.tolist()))
    i, j = np.nonzero(np.triu(x @ x.T >= 0.98, 1))
    assert pairs == set(zip(i.tolist(), j.tolist()))
