import pytest

from sparkprep.llm import urls
from sparkprep.llm.urls import Rule, UrlTrie, judge_urls, split_url


@pytest.mark.parametrize(
    "url, parts",
    [
        (None, ("", "")), ("", ("", "")), ("a.com/x", ("", "")), ("http://A.Com", ("a.com", "")), ("http://a.com/X?y#z", ("a.com", "/X")),
        ("http://a.com#/x", ("a.com", "")), ("x://a.com?b=/c", ("a.com", "")), ("http://a.com/b#c?d", ("a.com", "/b")), ("://É.com/é", ("É.com", "/é")),
        ("http://a://b/c", ("a:", "//b/c")),
    ],
)
def test_parts(url, parts):
    assert split_url(url) == parts


def fits(rule, host, path):
    return (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path)


def test_the_longest_fitting_rule_wins():
    rules = [Rule(a, h, p) for a, h, p in [("allow", "com", "/"), ("block", "b.com", "/en"), ("allow", "a.b.com", "/en/x/"), ("block", "com", ""), ("allow", "b.com", "/en/x")]]
    trie = UrlTrie(rules)
    for host in ("com", "b.com", "a.b.com", "ab.com", "z.a.b.com", "", "org"):
        for path in ("", "/", "/en", "/english", "/en/x", "/en/x/", "/en/xy", "/e"):
            want = max((r for r in rules if fits(r, host, path)), key=lambda r: len(r.host + r.path), default=None)
            assert trie.find(host, path) == want, (host, path)


def test_block_wins_over_an_equal_allow():
    for pair in ([Rule("allow", "a", "/"), Rule("block", "a", "/")], [Rule("block", "a", "/"), Rule("allow", "a", "/")]):
        assert UrlTrie(pair).find("a", "/").action == "block"


def test_odd_rows(spark, monkeypatch):
    rows = [(1, None, "h"), (2, "http://b.org/", "h"), (2, "http://b.org/", "h"), (None, "x://b.com/", "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    found = judge_urls(pages, [Rule("block", "com", "/")], default="block").collect()
    assert sorted(tuple(r) for r in found if r.page_id) == [(1, "", "", None, "block"), *[(2, "b.org", "/", None, "block")] * 2]
    assert [tuple(r) for r in found if not r.page_id] == [(None, "b.com", "/", "com/", "block")]
    assert judge_urls(pages.limit(0), []).count() == 0
    monkeypatch.setattr(urls, "MAX_RULES", 0)
    with pytest.raises(ValueError):
        judge_urls(pages, [Rule("allow", "a", "/")])


def test_many_rules_below_one_folder():
    rules = [Rule("block", "a.org", f"/d/page{i}") for i in range(2_000)] + [Rule("allow", "a.org", "/d/p"), Rule("allow", "a.org", "/d/page7x")]
    trie = UrlTrie(rules)
    for path, want in (("/d/page1999", "/d/page1999"), ("/d/page7xyz", "/d/page7x"), ("/d/pag", "/d/p"), ("/d/", None), ("/d/page12/e", "/d/page12"), ("/e/page12", None)):
        assert getattr(trie.find("a.org", path), "path", None) == want
