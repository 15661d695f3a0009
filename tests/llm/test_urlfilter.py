import random

import pytest

from codeloom.llm import urlfilter
from tests.llm.support import duck_rows, plain_rows

COLUMNS = ("page_id", "host", "path", "rule", "verdict")


def split_url(url):
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]


def brute(url, rules, default):
    host, path = split_url(url)
    fitting = [
        (len(h + p), v == "block", h + p) for h, p, v in rules
        if (not h or host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fitting:
        return host, path, None, default
    size, block, _ = max(fitting)
    return host, path, min(r for n, b, r in fitting if (n, b) == (size, block)), "block" if block else "allow"


URLS = [
    "https://www.example.com/en/1", "https://m.example.com/en/1?x=/fr/", "http://example.com/en", "http://EXAMPLE.COM/EN/", "http://example.com",
    "http://notexample.com/en/", "//example.com/en/", "example.com/en/", None, "", "http://", "http://?q", "http://a.net/es/#x", "ftp://a.net/fr/b/c",
    "http://a.net#://b.com/", "http://x\n.net/es/\ny", "http://com/", "http://.com/", "http://a..com/" + "p/" * 5000, "http://b.com/private",
    "http://b.com/priv", "http://b.com/privateer/x", "http://ü.com/é/",
]
RULES = [*urlfilter.RULES, ("b.com", "/priv", "block"), ("b.com", "/private", "allow"), ("", "/en", "block"), ("b.com", "", "block"),
         ("a.net", "/fr/b", "allow"), ("a.net", "/fr/b", "block"), ("ü.com", "/é/", "block")]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "kept", "v") for i, u in enumerate(urls)], "page_id long, url string, html string, verdict string")


@pytest.mark.parametrize("most", [1000, 3])
def test_against_trying_every_rule(spark, monkeypatch, most):
    monkeypatch.setattr(urlfilter, "TRIE_RULES", most)
    urls = URLS if most > 3 else [u for u in URLS if len(u or "") < 300]
    found = plain_rows(urlfilter.judge_urls(pages(spark, urls), RULES, default="block"), *COLUMNS)
    assert found == sorted(((i, *brute(u, RULES, "block")) for i, u in enumerate(urls)), key=repr)


def test_trie_against_random_rules():
    rng = random.Random(1)
    label, segment = lambda: rng.choice("abc"), lambda: rng.choice(["x", "y", "xy", ""])
    for _ in range(300):
        rules = {
            (".".join(label() for _ in range(rng.randint(0, 3))), "".join("/" + segment() for _ in range(rng.randint(0, 3))), rng.choice(["allow", "block"]))
            for _ in range(8)
        }
        trie = urlfilter.build_trie(sorted(rules))
        for _ in range(10):
            host, path = ".".join(label() for _ in range(rng.randint(1, 4))), "".join("/" + segment() for _ in range(rng.randint(0, 4)))
            rule, verdict = urlfilter.longest_match(trie, host, path)
            assert (rule, verdict or "none") == brute(f"http://{host}{path}", rules, "none")[2:]


def test_other_columns_stay_and_empty_tables(spark):
    found = urlfilter.judge_urls(pages(spark, URLS), urlfilter.RULES)
    assert set(found.columns) == {"page_id", "url", "html", "host", "path", "rule", "verdict"}
    assert urlfilter.judge_urls(pages(spark, []), urlfilter.RULES).collect() == []
    assert {r.verdict for r in urlfilter.judge_urls(pages(spark, URLS), []).collect()} == {"allow"}


def test_query_against_sql(spark, sf):
    assert plain_rows(urlfilter.query(spark, sf), *COLUMNS) == duck_rows(urlfilter.SQL, sf, list(COLUMNS))
