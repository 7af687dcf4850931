from rankdex.llm import url_filter as uf


def plain(url, rules=uf.RULES):
    """Host, path, rule and verdict by string methods."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, tail = rest[:cut], rest[cut:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    fits = [(len(r), r, v) for r, v in rules for name, _, p in [r.partition("/")]
            if (host == name or host.endswith("." + name)) and path.startswith("/" + p)]
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in url or "")
    words = set("".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in text).split())
    strict, soft = len(words & set(uf.STRICT_TERMS)), len(words & set(uf.SOFT_TERMS))
    rule = max(fits)[1] if fits else None
    verdict = max(fits)[2] if fits else "block" if strict or soft >= uf.SOFT_LIMIT else "allow"
    return host, path, rule, verdict, strict, soft


URLS = [
    None, "", "no scheme", "http://", "HTTP://EXAMPLE.com/en/1", "https://www.example.com/en/x?q#f", "http://a.www.example.com/en/",
    "http://example.com/en", "http://notexample.com/en/", "http://x.net/es/", "http://net/fr/1", "http://x.net/fr", "http://x.org/",
    "http://casino-win.example.org/", "http://casinowin.org/", "http://x.org/free/free-free", "http://x.org/free?bets=1",
    "http://x.org/adult-adult", "http://x.org/#XXX", "http://x.org/xxx2", "http://u:p@h.com:80/en/", "a://b://c.com/", "http://x.com",
    "http://éxxx.org", "http://x.org/" + "a/" * 50_000 + "viagra", "http://x.org?y/z", "http://İ.com/", "line\nhttp://q.com/\nx",
]


def test_every_url_is_judged(frame):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[4]), (4, URLS[4])]
    found = uf.judge_urls(frame(rows, "page_id long, url string")).collect()
    assert len(found) == len(rows)
    for r in found:
        expected = plain(URLS[4] if r.page_id is None else URLS[r.page_id])
        assert (r.host, r.path, r.rule, r.verdict, r.strict_hits, r.soft_hits) == expected, URLS[r.page_id or 0]


def test_other_rules_and_terms(frame):
    rows = [(1, "http://a.b/x/good-bad"), (2, "http://a.b/xy"), (3, "http://q/two words")]
    rules = [("b/x", "block"), ("a.b/x", "allow"), ("b/xy", "block")]
    found = uf.judge_urls(frame(rows, "page_id long, url string"), rules=rules, strict=["two words", ""], soft=[])
    assert {r.page_id: (r.rule, r.verdict) for r in found.collect()} == {
        1: ("a.b/x", "allow"), 2: ("a.b/x", "allow"), 3: (None, "block")
    }
    none = uf.judge_urls(frame(rows, "page_id long, url string"), rules=[], strict=[], soft=[])
    assert {r.verdict for r in none.collect()} == {"allow"}
    assert uf.judge_urls(frame([], "page_id long, url string")).count() == 0
