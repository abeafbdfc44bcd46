import random

import pytest

from driftline.llm import url_trie
from driftline.llm.url_trie import Rule

RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
    Rule("block", "org", "/f"),
)


def expected(host, path, rules):
    """Tries every rule; most labels, then the longest path, then block."""
    best = None
    for verdict, rule_host, rule_path in rules:
        inside = not rule_host or host == rule_host or host.endswith("." + rule_host)
        if inside and path.startswith(rule_path):
            labels = len(rule_host.split(".")) if rule_host else 0
            rank = (labels, len(rule_path), verdict == "block")
            if best is None or rank > best[0]:
                best = (rank, rule_host + rule_path, verdict)
    return best and best[1:]


def test_trie_equals_trying_every_rule():
    rng = random.Random(3)
    hosts = ["net", "a.net", "example.net", "x.example.net", "notexample.net", "org", "b.org", ""]
    paths = ["", "/", "/en", "/en/", "/en/x", "/f", "/fr", "/fr/", "/fr/q/", "//", "/enx/"]
    for _ in range(300):
        rules = [
            Rule(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(paths))
            for _ in range(rng.randint(0, 6))
        ]
        trie = url_trie.build_trie(rules)
        for host in hosts:
            for path in paths:
                assert url_trie.match(trie, host, path) == expected(host, path, rules)


def test_urls(spark):
    urls = [
        (1, "https://EXAMPLE.net/en/1?x#y"),
        (2, "https://a.example.net"),
        (3, "http://a.b.example.com/de/"),
        (4, None),
        (5, "no scheme/net/"),
        (6, "http://x.org/fr/a"),
        (7, "http://x.org/from"),
        (8, "a://b.net?c://d/e"),
        (None, "http://q.net/"),
        (1, "https://EXAMPLE.net/en/1?x#y"),
        (9, ""),
    ]
    df = spark.createDataFrame([(i, u, "kept", "h") for i, u in urls], "page_id long, url string, verdict string, extra string")
    out = url_trie.judge(df, RULES)
    assert out.columns == ["page_id", "url", "extra", "host", "path", "rule", "verdict"]
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect()]
    assert got == [
        (1, "example.net", "/en/1", "example.net/en/", "allow"),
        (2, "a.example.net", "", None, "allow"),
        (3, "a.b.example.com", "/de/", "example.com/de/", "block"),
        (4, "", "", None, "allow"),
        (5, "", "", None, "allow"),
        (6, "x.org", "/fr/a", "org/fr/", "allow"),
        (7, "x.org", "/from", "org/f", "block"),
        (8, "b.net", "", None, "allow"),
        (None, "q.net", "/", "net/", "block"),
        (1, "example.net", "/en/1", "example.net/en/", "allow"),
        (9, "", "", None, "allow"),
    ]
    assert url_trie.judge(df.limit(0), RULES).count() == 0


def test_rules_are_checked(monkeypatch):
    with pytest.raises(ValueError):
        url_trie.build_trie([Rule("maybe", "net", "/")])
    monkeypatch.setattr(url_trie, "MAX_RULE_BYTES", 100)
    with pytest.raises(ValueError):
        url_trie.build_trie([Rule("block", "net", "/")] * 2)
