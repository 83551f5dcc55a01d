from lakelayer.llm import url_filter


def test_cases(spark, no_docs):
    urls = {
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "casino-win.com/x": ("", "", None, "block"),
        "http://WWW.Example.ORG/es/1?x=/y": ("www.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "http://spam-farm.org/a": ("spam-farm.org", "/a", "org/", "allow"),
        "http://a.com/fr/spam-farm": ("a.com", "/fr/spam-farm", "com/fr/", "allow"),
        "http://a.com/de/": ("a.com", "/de/", "com/de/", "block"),
        "http://org": ("org", "", None, "allow"),
        "http://a.net/cheap": ("a.net", "/cheap", None, "allow"),
        "http://a.net/cheap/cheap": ("a.net", "/cheap/cheap", None, "allow"),
        "http://a.net/cheap/PILLS": ("a.net", "/cheap/PILLS", None, "block"),
        "http://a.net/cheaper/pillsbury": ("a.net", "/cheaper/pillsbury", None, "allow"),
        "http://xxx.a.net#f": ("xxx.a.net", "", None, "block"),
        "x://h?q=1/2": ("h", "", None, "allow"),
        "http://a.net/" + "y" * 100_000 + "/porn": ("a.net", "/" + "y" * 100_000 + "/porn", None, "block"),
    }
    rows = [(k, u, "x", "y") for k, u in enumerate(urls)] * 2
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == urls[r["url"]]
    assert url_filter.judge_urls(no_docs.withColumnRenamed("text", "url")).count() == 0


def test_empty_vocabulary(spark):
    pages = spark.createDataFrame([(1, "http://a.net/porn"), (2, "http://a.com/de/")], "page_id long, url string")
    got = {r["page_id"]: (r["verdict"], r["strict_hits"], r["soft_hits"]) for r in url_filter.judge_urls(pages, strict=(), soft=()).collect()}
    assert got == {1: ("allow", 0, 0), 2: ("block", 0, 0)}
    assert url_filter.judge_urls(pages.limit(0), strict=(), soft=()).count() == 0
