"""Main text of pages, nearest neighbours, and the pipeline."""

import numpy as np

from lakeloom.llm import ann, html_text

from .conftest import words


def page(body, head="", notice=""):
    return (f"<!DOCTYPE html><html><head><title>t</title>{head}<script>var a='<p>no</p>';</script></head><body><nav><ul><li><a href=/x>Home</a></ul></nav>"
            f"{notice}{body}<footer>&copy; site</footer></body></html>")


def test_blocks_and_entities():
    text = html_text.Page(page("<article><header><h1>A &amp; B</h1></header><p>one<br>two  <b>th</b>ree &nbsp;x<p>four &lt;5&gt;<div class='comments'>no</div>"
                               "<aside>no</aside><form>no</form><!-- no --><div class=ad>no</div><p hidden>no<ul><li>a<li>b</ul><pre>c\n d</pre></article>")).main_text()
    assert text == "A & B\n\none two three x\n\nfour <5>\n\na\n\nb\n\nc d"


def test_odd_markup():
    main = lambda s: html_text.Page(s).main_text()
    assert main("") == "" and main("<<>><a b='") == "<<>><a b='" and main("plain  text") == "plain text"
    assert main("<p>a</div></p></p>b<script>x") == "a\n\nb"
    assert main("<p title='a > b'>x</p>") == "x" and main("<main>in</main>out") == "in"
    assert main("<p>" * 2000 + "deep" + "</p>") == "deep"


def test_templates_go_and_copied_articles_stay(spark):
    rows = []
    for k in range(30):
        notice = "<section><div>We use crumbs.</div></section>"
        article = f"<section><p>{words(20, 1 if k < 12 else k)}</p><p>{words(20, 100 + k)}</p></section>"
        rows.append((k, f"https://a.example/p{k}", page(article, notice=notice)))
    rows += [(90, "http://b.example/", page("<section><div>We use crumbs.</div></section><p>own</p>")), (91, None, None), (91, None, None), (92, "not a url", "text")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as host", "2 as hash")
    for limit in (html_text.MAX_BROADCAST, 0):
        got = {r.page_id: r.text for r in html_text.main_text(df, max_broadcast=limit).collect()}
        for k in range(30):
            assert got[k] == words(20, 1 if k < 12 else k) + "\n\n" + words(20, 100 + k)
        assert got[90] == "We use crumbs.\n\nown" and got[91] == "" and got[92] == "text"
    assert html_text.main_text(df.limit(0)).count() == 0


def test_blocks_inside_articles(spark):
    box = "<div class=x1><b>Get the letter.</b><div>Each week, free.</div></div>"
    rows, want = [], {}

    def add(host, body, text):
        rows.append((len(rows), f"https://{host}/p{len(rows)}", page(body)))
        want[len(rows) - 1] = text

    p = lambda k: f"<p>{words(15, k)}</p>"
    for k in range(100):  # half of a host's pages
        add("half", f"<article><h1>{words(3, k)}</h1>{p(1000 + k)}{box * (k % 2)}{p(2000 + k)}</article>", "\n\n".join([words(3, k), words(15, 1000 + k), words(15, 2000 + k)]))
    for k in range(19):  # all pages of a small host
        add("small", f"<article>{p(3000 + k)}{box}</article>", words(15, 3000 + k))
    for k in range(240):  # some pages without an article
        add("bare", f"<div>{p(4000 + k)}</div>{box if k < 20 else ''}", words(15, 4000 + k))
    copied = "".join(f"<div class=s{j}>{p(5000 + j)}</div>" for j in range(4))
    for k in range(40):  # copies with titles of their own, sections and all
        add("copies", f"<article><h1>{words(3, 6000 + k)}</h1>{copied}</article>", "\n\n".join([words(3, 6000 + k)] + [words(15, 5000 + j) for j in range(4)]))
    for k in range(40):  # a passage that half of the pages quote, as a paragraph and as one of several blocks of a class
        quote = p(7000) + f"<div class=t>{words(9, 7001)}</div>" if k % 2 else ""
        add("quotes", f"<article>{p(8000 + k)}{quote}<div class=t>{words(9, 9000 + k)}</div><div class=t>{words(9, 9500 + k)}</div></article>",
            "\n\n".join([words(15, 8000 + k)] + [words(15, 7000), words(9, 7001)] * (k % 2) + [words(9, 9000 + k), words(9, 9500 + k)]))
    add("few", f"<article>{p(1)}{box}</article>", words(15, 1) + "\n\nGet the letter.\n\nEach week, free.")
    long = "".join(p(20000 + k) for k in range(3000))
    add("small", f"<article>{long}{box}</article>", "\n\n".join(words(15, 20000 + k) for k in range(3000)))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for limit in (html_text.MAX_BROADCAST, 0):
        got = {r.page_id: r.text for r in html_text.main_text(df, max_broadcast=limit).collect()}
        assert {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {}


def test_templates_equal_a_plain_count(spark):
    rng = np.random.default_rng(5)
    parts = [f"<section id=a{j}><p>{words(4, j)}</p></section>" for j in range(12)]
    rows = []
    for k in range(150):
        chosen = "".join(parts[j] for j in sorted(rng.choice(12, rng.integers(0, 6), replace=False)) if rng.random() < 0.7 or j < 3)
        rows.append((k, f"http://h{k % 3}/{k}", page(f"<article><p>{words(int(rng.integers(1, 40)), 300 + k // 2)}</p>{chosen}</article>")))
    pages = {}
    for _, url, source in rows:
        p = html_text.Page(source)
        pages[html_text_host(url), p.main_text()] = p.subtrees()
    count = {}
    for (host, _), found in pages.items():
        for h in found:
            count[host, h] = count.get((host, h), 0) + 1
    votes = {}
    for (host, _), found in pages.items():
        recurring = {h for h in found if count[host, h] >= html_text.MIN_PAGES}
        if 2 * sum(own for h, (own, _) in found.items() if h not in recurring) >= sum(own for own, _ in found.values()):
            for h in recurring:
                if found[h][1] == html_text.CONTAINER and count[host, h] > html_text.TEMPLATE_PAGES:
                    votes[host, h] = votes.get((host, h), 0) + 1
    want = {key for key, n in votes.items() if n > html_text.TEMPLATE_PAGES}
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("url", "xxhash64(html) as _k1", "xxhash64(html, '_') as _k2", "html as _html")
    seen = html_text.subtrees(df.withColumn("_host", html_text.host_of(df["url"])).select("_host", "_k1", "_k2", "_html"))
    got = {(r["_host"], r["hash"]) for r in html_text.templates(seen).collect()}
    assert got == want and 0 < len(want) < len({h for h in count})


def html_text_host(url):
    return url.split("/")[2]


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((600, 16)).astype(np.float32)
    x[100:140] = x[100]
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows += [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] + [1.0] * 15), (1003, [None] + [1.0] * 15), (1004, [1.0] * 3), (None, [1.0] * 16), (0, x[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as id", "2 as x", "3 as rank")
    got = {}
    for r in ann.search(df, df.filter("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    x = x.astype(np.float64)
    hit = 0
    for q in range(0, 600, 20):
        cos = x @ x[q] / (np.linalg.norm(x, axis=1) * np.linalg.norm(x[q]))
        cos[q] = -2
        want = np.lexsort((np.arange(600), -cos))[:5].tolist()
        assert sorted(got[q]) == [1, 2, 3, 4, 5]
        hit += len({v for v, _ in got[q].values()} & set(want))
        assert all(abs(s - cos[v]) < 1e-12 for v, s in got[q].values())
        if 100 <= q < 140:
            assert [got[q][k][0] for k in range(1, 6)] == [v for v in range(100, 107) if v != q][:5]
    assert sorted(got) == list(range(0, 600, 20)) and hit >= 0.9 * 5 * len(got)


def test_few_neighbours(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.1]), (2, [0.0, -3.0])], "vec_id long, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id) for r in ann.search(df, df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 2), (0, 2, 1), (1, 1, 2), (1, 2, 0), (2, 1, 0), (2, 2, 1)]
    assert ann.search(df.limit(0), df.limit(0)).count() == 0


def test_probing_is_the_pigeonhole_search():
    rng = np.random.default_rng(2)
    words_ = rng.integers(0, 1 << 63, (500, 2), dtype=np.uint64)
    words_[::3] = words_[0] ^ (np.uint64(1) << rng.integers(0, 64, (167, 2), dtype=np.uint64))
    index = ann.Index(words_)
    for radius in (0, 1, 2, 5, 17, 60, 128):
        q, c = index.within(words_[:20], radius)
        want = [(a, b) for a in range(20) for b in range(500) if np.bitwise_count(words_[a] ^ words_[b]).sum() <= radius]
        assert list(zip(q.tolist(), c.tolist())) == want


def test_pipeline(spark):
    import corpus_pipeline as pipeline

    docs = pipeline.documents(spark, "/root/testdata/sf0.001")
    kept = docs
    for k, (_, stage) in enumerate(pipeline.STAGES):
        before, kept = kept, pipeline.staged(stage(spark, kept, "/root/testdata/sf0.001"), "test")
        if k < len(pipeline.STAGES) - 1:
            assert kept.columns == pipeline.COLUMNS and 0 < kept.count()
            assert kept.join(before, "doc_id", "left_anti").count() == 0
    assert kept.count() == before.count() and kept.filter("n_tokens > 0").count() > 0


def test_pipeline_of_odd_rows(spark, odd, empty):
    import corpus_pipeline as pipeline

    for docs in (odd, empty):
        for name, stage in pipeline.STAGES[1:]:
            docs = pipeline.staged(stage(spark, docs, ""), "test")
        assert (docs.count() > 0) == (docs.columns[0] == "doc_id" and docs.first() is not None)
