"""Url rules against a plain scan of all rules."""

import random

import pytest
from conftest import rows

from spoorlens.llm import url_filter as u
from spoorlens.llm.queries import URL_RULES


def brute(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1].split("#")[0].split("?")[0]
        host, slash, path = rest.partition("/")
        host, path = "".join(c.lower() if c.isascii() else c for c in host), slash + path
    fits = [(len(h + p), v == "block", h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


URLS = [
    None, "", "no scheme", "://", "http://", "http://COM", "http://com/", "https://Www.Example.com/en/a?b#c", "http://example.com/en",
    "http://xexample.com/en/", "http://a.net/es/x", "http://net/fr/", "http://a.net/x#/fr/", "http://a.net?/fr/", "ftp://ÄÖ.com/Ä",
    "http://a.b.com:80/", "http://com./", "x://y://com/", "http://user@com/", "http://com/" + "a/" * 3000,
]


def test_given_rules(spark):
    df = spark.createDataFrame([(i, x, "h", "v") for i, x in enumerate(URLS)] + [(0, None, "h", "v")], "page_id long, url string, host string, verdict string")
    got = rows(u.judge_urls(df, URL_RULES), "page_id", "host", "path", "rule", "verdict")
    want = [(i, *brute(x, URL_RULES)) for i, x in enumerate(URLS)]
    assert got == sorted(want + want[:1])
    assert u.judge_urls(df.limit(0), URL_RULES).count() == 0


def test_many_rules():
    rng = random.Random(5)
    hosts = ["com", "a.com", "b.a.com", "net", "a.net"]
    paths = ["", "/", "/x", "/x/", "/x/y", "/xy/", "/x/yz/"]
    rules = [(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(paths)) for _ in range(25)]
    trie = u.Trie(rules)
    for host in [*hosts, "c.b.a.com", "org", ""]:
        for path in [*paths, "/x/yz/1", "/xyz", "//"]:
            _, _, rule, verdict = brute(f"http://{host}{path}", rules)
            assert trie.find(host, path) == (rule and (rule, verdict)), (host, path)


def test_wrong_rules(spark):
    with pytest.raises(ValueError):
        u.Trie([("maybe", "com", "/")])
