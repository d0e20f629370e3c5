import pytest
from hypothesis import given
from hypothesis import strategies as st

from sparkscan.llm import url_rules
from sparkscan.llm.url_rules import RULES, Trie, UrlRule

MORE = [*RULES, UrlRule("allow", "a.example.org", "/"), UrlRule("block", "org", "/en/"), UrlRule("allow", "org", "/en/"), UrlRule("allow", "com", "/de/x/y")]
HOST = st.lists(st.sampled_from(["a", "example", "org", "com", "", "xorg"]), max_size=4).map(".".join)
PATH = st.lists(st.sampled_from(["/", "en", "es", "de", "1", "x", "y", "fr"]), max_size=7).map("".join)


def plain(rules, host, path):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (r.host.count("."), len(r.path), r.verdict == "block"), default=None)


@given(HOST, PATH)
def test_trie(host, path):
    for rules in (RULES, MORE):
        assert Trie(rules).find(host, path) == plain(rules, host, path)


def test_operator(spark):
    urls = [None, "", "no scheme", "http://", "://x.ORG/", "http://example.org/en/1#f", "https://A.EXAMPLE.org/en/10?q=/es/",
            "http://example.org/es", "http://example.org/es/", "http://n.com/de/", "http://n.com/fr/a", "http://n.com", "http://É.com/DE/",
            "http://n.com?x=/de/", "a://b://c.org/", "http://notexample.org/es/", "http://user@n.com:80/de/"]
    df = spark.createDataFrame([(k, u, "clash") for k, u in enumerate([*urls, *urls])] + [(None, "http://a.org/", "x")], "page_id bigint, url string, host string")
    out = {r.page_id: r for r in url_rules.url_verdicts(df).collect()}
    assert len(out) == 2 * len(urls) + 1
    for k, u in enumerate([*urls, *urls]):
        host, path = url_rules.host_and_path(u)
        rule = plain(RULES, host, path)
        assert tuple(out[k]) == (k, host, path, rule and rule.host + rule.path, rule.verdict if rule else "allow")
    assert url_rules.host_and_path("a://É.COM/X?y#z") == ("É.com", "/X")
    assert url_rules.host_and_path("h://a.b#/c") == ("a.b", "") and url_rules.host_and_path("ab") == ("", "")
    assert url_rules.url_verdicts(df.limit(0)).collect() == []
    with pytest.raises(ValueError, match="path"):
        url_rules.url_verdicts(df, [UrlRule("allow", "org", "x")])
