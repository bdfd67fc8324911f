import re

from pressmill.llm.urls import RULES, filter_urls, url_filter


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def ruled(host, path):
    fits = [(h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0]), default=(None, None))


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' as host", "1 as label", "2 as shape")


def test_edges(spark):
    urls = [None, "", "no scheme", "http://", "x://A.ORG", "x://A.ORG/", "http://org/a://b/c", "x://É.Com/de/?q#f", "x://y#z/?",
            "http://example.org/en/12", "http://examples.org/en/12", "http://m.example.org/en/1?x", "a\nb://h\n/p\nq?r",
            "http://h/" + "x/" * 5000]
    rows = list(enumerate(urls)) + [(None, "http://a.com/fr/"), (1, "")]
    got = filter_urls(pages(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {(r.page_id, r.host, r.path, r.rule) for r in got}
    assert by == {(i, *parts(u), ruled(*parts(u))[0]) for i, u in rows}
    assert all(r.verdict == (ruled(r.host, r.path)[1] or "allow") for r in got)
    assert filter_urls(pages(spark, rows).limit(0)).count() == 0


def test_templates_and_purity(spark):
    good = [(i, f"http://h.net/news/a{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}/{i}.html") for i in range(100)]
    bad = [(1000 + i, f"http://h.net/spam/{i}") for i in range(100)]
    new = [(5000, "http://h.net/news/never-seen/77.html"), (5001, "http://h.net/spam/77777"), (5002, "http://h.net/other")]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(None, 0)], "page_id long, label int")
    got = {r.page_id: r for r in filter_urls(pages(spark, good + bad + new), labels).collect()}
    assert got[0].template == "/news/{*}/{n}" and got[5000].template == got[0].template
    assert got[5001].template == "/spam/{n}"
    assert (got[5000].verdict, got[5001].verdict) == ("allow", "block")
    assert got[0].purity > 0.9 and got[5001].purity < 0.1


def test_similar_siblings_share_their_labels(spark):
    rows = [(i, f"http://h.net/{'ab'[i % 2]}/{i}") for i in range(40)]
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(40)], "page_id long, label int")
    assert len({r.purity for r in filter_urls(pages(spark, rows), labels).collect()}) == 1


def test_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()
    got = {r.page_id: r for r in url_filter(spark, sf_dir).collect()}
    assert len(got) == len(table)
    for page, url in table:
        host, path = parts(url)
        rule, verdict = ruled(host, path)
        assert (got[page].host, got[page].path, got[page].rule) == (host, path, rule)
        assert got[page].verdict == verdict if rule else got[page].verdict in ("allow", "block")


def test_deep_paths_are_told_apart(spark):
    rows = [(i, f"http://h.net/a/b/c/d/e/f/{'good' if i % 2 else 'spam'}/page{i}?x") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "page_id long, label int")
    got = {r.page_id: r for r in filter_urls(pages(spark, rows), labels).collect()}
    assert {r.template for r in got.values()} == {"/a/b/c/d/e/f/good/{*}", "/a/b/c/d/e/f/spam/{*}"}
    assert all(r.verdict == ("allow" if i % 2 else "block") for i, r in got.items())
