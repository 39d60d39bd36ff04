from __future__ import annotations

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from opticlake.llm import url_filter
from opticlake.llm.url_filter import judge_urls, split_url


def judged(spark, urls, rules, **more):
    pages = spark.createDataFrame([(i, u, "own", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, extra int")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    rows = sorted(judge_urls(pages, frame, **more).collect(), key=lambda r: r["page_id"])
    return [(r["host"], r["path"], r["rule"], r["verdict"]) for r in rows]


def plain(url, rules, default="allow"):
    host, path = split_url(url)
    fits = [(-len(h + p), h + p, v != "block", v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = min(fits, default=None)
    return (host, path, best[1] if best else None, best[3] if best else default)


RULES = [("org", "/", "allow"), ("b.org", "/x", "block"), ("b.org", "/xy", "allow"), ("a.b.org", "", "block"),
         ("net", "/q", "block"), ("net", "/q", "allow"), ("é.de", "/ü", "block")]
URLS = ["http://b.org/xyz", "http://c.a.b.org", "http://a.b.org/x", "HTTP://B.ORG/x?y#z", "ftp://b.org", "x.org/", None, "", "://",
        "http://net/q", "http://net/Q", "http://é.de/üb", "http://org", "http://org/", "http://xb.org/x", "http://b.org:80/x",
        "http://u@b.org/x", "http://b.org#/x", "http://" + "a." * 500 + "b.org/x" * 100, "http://b.org/xyz"]


def test_rules(spark):
    assert judged(spark, URLS, RULES) == [plain(u, RULES) for u in URLS]


def test_colliding_keys_and_many_blocks(spark, monkeypatch):
    class Weak:
        @staticmethod
        def xxh64_intdigest(text: bytes) -> int:
            return len(text) % 3

    texts = [(f"h{i}.org/p".encode(), i % 2) for i in range(50)]
    monkeypatch.setattr(url_filter, "xxhash", Weak)
    data = np.frombuffer(url_filter._block(list(texts)), np.uint8)
    n = len(texts)
    block = (data[: 8 * n].view(np.uint64), data[8 * n : 16 * n].view(np.int64), data[16 * n : 17 * n], data[17 * n :])
    wanted = [t for t, _ in texts] + [b"other.org/p", b""]
    keys = np.array([Weak.xxh64_intdigest(t) for t in wanted], np.uint64)
    assert dict(url_filter._find(block, keys, wanted)) == {i: v for i, (_, v) in enumerate(texts)}
    monkeypatch.undo()
    assert judged(spark, URLS, RULES, most=2) == [plain(u, RULES) for u in URLS]


def test_empty_tables_and_null_rules(spark):
    assert judged(spark, [], RULES) == []
    assert judged(spark, ["http://a.org/"], [(None, "/", "block"), ("org", None, "block"), ("org", "/", "deny")], default="block") == [("a.org", "/", None, "block")]


@given(st.text(alphabet="aB:/?#.é ", max_size=20))
def test_split(url):
    host, path = split_url(url)
    rest = url.split("://", 1)[1] if "://" in url else None
    if rest is None:
        assert (host, path) == ("", "")
    else:
        head = rest.split("?")[0].split("#")[0]
        assert (host + path).lower() == head.lower() and not set(host) & set("/?#B") and (not path or path[0] == "/")
