from stratavault.llm import url_filter
from stratavault.llm.queries import URL_RULES

RULES = "host string, path string, verdict string"


def judged(spark, pages, rules=URL_RULES, **options):
    found = url_filter.judge(pages, spark.createDataFrame(rules, RULES), **options)
    return sorted(map(tuple, found.collect()), key=repr)


def brute(pages, rules):
    out = []
    for page, url in pages:
        _, mark, rest = (url or "").partition("://")
        ends = [rest.index(c) for c in "/?#" if c in rest]
        host = "".join(c.lower() if c.isascii() else c for c in rest[:min(ends, default=len(rest))]) if mark else ""
        tail = rest[min(ends, default=len(rest)):] if mark else ""
        path = tail[:min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
        fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, None, "allow"))
        out.append((page, host, path, best[2], best[3]))
    return sorted(out, key=repr)


URLS = [(1, "http://a.Example.COM/en/1?q=/fr/"), (2, "https://www.example.com/en/x#y"), (3, "x://net/es/"), (4, "x://a.net/fr"), (5, None), (6, ""),
        (7, "no scheme"), (8, "http://"), (9, "http://com"), (10, "http://com/"), (11, "a://b://c.com/z"), (12, "http://q.net?x=://a.com/"),
        (13, "http://é.net/fr/ü"), (None, "http://k.com/"), (3, "x://net/es/"), (3, "x://net/es/"), (14, "http://notexample.com/en/"),
        (15, "http://" + "a." * 300 + "com/" + "p" * 5000), (16, "http://x\n.com/\n?")]


def test_urls_against_brute_force(spark, clashing):
    pages = clashing(spark.createDataFrame(URLS, "page_id bigint, url string")).repartition(3)
    assert judged(spark, pages) == brute(URLS, URL_RULES)


def test_many_rules_take_the_shuffle_join_with_equal_results(spark):
    pages = spark.createDataFrame(URLS, "page_id bigint, url string")
    assert judged(spark, pages, broadcast_rules=0) == brute(URLS, URL_RULES)


def test_rules_that_end_inside_a_name_and_contradict(spark):
    rules = [("com", "/en", "block"), ("com", "/e", "allow"), ("a.com", "/x", "allow"), ("a.com", "/x", "block"), (None, None, "block")]
    urls = [(1, "h://a.com/enough"), (2, "h://a.com/e"), (3, "h://a.com/xy"), (4, None)]
    found = judged(spark, spark.createDataFrame(urls, "page_id bigint, url string"), rules)
    assert [(r[0], r[3], r[4]) for r in found] == [(1, "com/en", "block"), (2, "com/e", "allow"), (3, "a.com/x", "block"), (4, "", "block")]


def test_no_rows_and_no_rules(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string")
    assert judged(spark, empty) == []
    none = url_filter.judge(spark.createDataFrame([(1, "h://a.com/")], "page_id bigint, url string"), spark.createDataFrame([], RULES), default="block")
    assert [tuple(r) for r in none.collect()] == [(1, "a.com", "/", None, "block")]
