from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm import html_text as H
from tidemark.llm.queries import QUERIES

HEAD = "<!DOCTYPE html><html><head><title>x &amp; y</title><style>p{}</style><script>var t='</p>';</script></head><body class='has-sidebar'>"


def text(page: str) -> str:
    found = H.classified(page)
    kinds = np.array([k for k, _, _ in found], np.int64)
    keep = H.kept_blocks(kinds, np.zeros(len(kinds), bool), np.zeros(len(kinds), np.int64))
    return "\n".join(t for (_, _, t), k in zip(found, keep) if k)


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        ("", ""),
        ("just  text &lt;b&gt;", "just text <b>"),
        ("<article><h1>A&amp;B</h1><p><b>one<br> two<br><p>three&nbsp;four</article><footer>f</footer>", "A&B\none two\nthree four"),
        (HEAD + "<nav><a>menu</a></nav><div class='ad'>buy</div><article><p>text</p></article>", "text"),
        (HEAD + "<header>site</header><main><p>text</p><aside>more</aside><form>q<input></form></main>", "text"),
        ("<article><header><h1>T</h1>by someone</header><p>x</p><footer>tags</footer></article>", "T\nx"),
        ("<article><p>x</p><section id='comments'><article><p>first!</p></article></section></article>", "x"),
        ("<div id='sidebar'>s</div><div id='content'><p>x</p><div class='share-buttons'>s</div></div>", "x"),
        ("<div class='layout-with-sidebar'><article><p>x</p></article><div class='widget'>w</div></div>", "x"),
        ("<body><p>x</p><p hidden>h</p><p style='display: none'>h</p><!-- <p>c</p> --><p>y", "x\ny"),
        ("<article><p>x</p><script>a < b; '</article>'</script><p>1 < 2 <3</p><noscript><p>n</p></noscript>", "x\n1 < 2 <3"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>e</ul></article>", "a\nb\nc\nd\ne"),
        ('<article><p title="a > b">x</p><p class="cookie-notice">c</p></article>', "x"),
        ("<article><p>x</p><a title='never closed>y</a></article>", "x\ny"),
    ],
)
def test_markup_says_where_the_article_is(page, wanted):
    assert text(page) == wanted


def test_suffix_array_sorts_by_the_first_tokens():
    rng = np.random.default_rng(5)
    tokens = rng.integers(0, 3, 300)
    order, rank = H.suffix_array(tokens, 8)
    heads = [tuple(tokens[i : i + 8].tolist()) for i in range(len(tokens))]
    assert [heads[i] for i in order] == sorted(heads)
    assert all((rank[i] == rank[j]) == (heads[i] == heads[j]) for i in range(300) for j in range(300))


def test_repeated_substrings_equal_a_plain_search():
    rng = np.random.default_rng(6)
    phrases = [rng.integers(0, 4, n) for n in (7, 8, 9, 20)]
    page = np.sort(rng.integers(0, 12, 900))
    tokens = rng.integers(0, 40, 900)
    for at in range(0, 870, 30):
        phrase = phrases[at // 30 % 4]
        tokens[at : at + len(phrase)] = phrase
    content = page // 2  # pages 0 and 1 have equal text, and so on
    for pages in (2, 3):
        windows: dict = {}
        inside = [i for i in range(len(tokens) - 7) if page[i] == page[i + 7]]
        for i in inside:
            windows.setdefault(tuple(tokens[i : i + 8].tolist()), set()).add(int(content[i]))
        wanted = np.zeros(len(tokens), bool)
        for i in inside:
            if len(windows[tuple(tokens[i : i + 8].tolist())]) >= pages:
                wanted[i : i + 8] = True
        assert wanted.any() and (H.repeated(tokens, page, content, pages) == wanted).all()


def pages_of(spark, *rows):
    return spark.createDataFrame(list(rows), "page_id long, url string, html string, host string, texts string, shard long")


def words(n: int) -> str:
    return " ".join(f"w{n}x{i}" for i in range(30))


def test_a_template_without_labels_goes_by_repetition(spark):
    """Pages without an article: repeated blocks go, unique ones and those of copies stay."""
    top = "<div>Home of all things that anyone could ever want to read about today</div>"
    end = "<div>Written by people for people since the very first day of the world</div>"
    rows = [(i, f"https://one.example/{i}", f"{top}<p>{words(i)}</p>{end}", "h", "t", 1) for i in range(6)]
    rows += [(10 + i, f"https://two.example/{i}", f"<p>{words(99)}</p>", "h", "t", 1) for i in range(3)]
    rows += [(20, None, None, None, None, None), (20, "not a url", "", None, None, None), (None, "https://[", "<p>z</p>", None, None, None)]
    rows += [rows[0]]
    found = [(r.page_id, r.url, r.text, r.n_chars) for r in H.main_text(pages_of(spark, *rows)).collect()]
    wanted = [(i, f"https://one.example/{i}", words(i)) for i in [0, *range(6)]]
    wanted += [(10 + i, f"https://two.example/{i}", words(99)) for i in range(3)]
    wanted += [(20, None, ""), (20, "not a url", ""), (None, "https://[", "z")]
    assert sorted(found, key=str) == sorted([(*w, len(w[2])) for w in wanted], key=str)


def test_articles_keep_what_they_quote_and_lose_unlabelled_furniture(spark):
    quote = "to be or not to be that is the question whether it is nobler in the mind"
    tools = "<div class='x17'>Send this page to a friend or print it for the whole family now</div>"
    rows = [
        (i, f"https://one.example/{i}", f"<article><p>{words(i)}</p><p>{quote}</p>{tools}</article>", None, None, None) for i in range(5)
    ]
    found = {r.page_id: r.text for r in H.main_text(pages_of(spark, *rows)).collect()}
    assert found == {i: f"{words(i)}\n{quote}" for i in range(5)}


def test_a_hot_host_is_cut_into_shards(spark):
    top = "<div>Home of all things that anyone could ever want to read about today</div>"
    rows = [(i, f"https://one.example/{i}", f"{top}<p>{words(i)}</p>", None, None, None) for i in range(200)]
    found = H.main_text(pages_of(spark, *rows), shard_bytes=20_000)
    assert {r.page_id: r.text for r in found.collect()} == {i: words(i) for i in range(200)}


def test_the_size_of_a_shard_changes_no_result(spark):
    """Templates on few of a host's pages, below its share and above it, copies, and a page that is all template."""
    often = "<div>Home of all things that anyone could ever want to read about today</div>"
    seldom = "<div>Written by people for people since the very first day of the world</div>"
    here = lambda i: (often if i % 33 == 0 else "") + (seldom if i in (1, 2, 3) else "")
    rows = [(i, f"https://one.example/{i}", f"{here(i)}<p>{words(i)}</p>", None, None, None) for i in range(200)]
    rows += [(300 + i, f"https://one.example/c{i}", f"{seldom}<p>{words(777)}</p>", None, None, None) for i in range(40)]
    rows += [(400, "https://one.example/t", often, None, None, None), (401, "https://one.example/e", "", None, None, None)]
    rows += [(500, "https://two.example/x", f"{often}<p>{words(5)}</p>", None, None, None)]
    rows += [(None, "https://one.example/0", rows[0][2], None, None, None), rows[33]]
    pages = pages_of(spark, *rows).repartition(4)
    shown = lambda shard_bytes: sorted(map(str, H.main_text(pages, shard_bytes).collect()))
    whole = shown(1 << 30)
    assert whole == shown(4_000) == shown(500)
    by_id = {r.page_id: r.text for r in H.main_text(pages, 4_000).collect()}
    assert by_id[33] == words(33) and by_id[1] == f"{seldom[5:-6]}\n{words(1)}" and by_id[400] == often[5:-6]


def test_empty_table(spark):
    assert H.main_text(pages_of(spark)).collect() == []


def test_query_gives_the_article_of_every_page(spark, data_dir):
    import html
    import re

    pages = spark.read.parquet(f"{data_dir}/pages.parquet").collect()
    found = {r.page_id: r.text for r in QUERIES["op11_html_text"](spark, data_dir).collect()}
    for page in pages:
        inner = page.html[page.html.find("<article>") + 9 : page.html.find("</article>")]
        parts = [re.sub(r"<[^>]*>", " ", x) for x in re.split(r"</?p>|</?h1>", inner)]
        lines = [" ".join(html.unescape(x).split()) for x in parts]
        assert found[page.page_id] == "\n".join(x for x in lines if x)
    assert len(found) == len(pages)
