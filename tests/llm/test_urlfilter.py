import re

import pytest

from millrace.llm import urlfilter

from .odd import clashing, real


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def slow_rule(host, path):
    fits = [(len(rule), rule, verdict) for rule, verdict in urlfilter.RULES for name, slash, rest in [rule.partition("/")] if (host == name or host.endswith("." + name)) and path.startswith(slash + rest)]
    return max(fits)[1:] if fits else None


URLS = [
    None, "", "no scheme", "http://", "https://NET/", "https://net", "https://a.NET/x", "http://planet/x", "http://x.example.net/en/1", "http://x.example.net/en", "http://example.com/de/", "http://badexample.com/de/x",
    "ftp://a.org/fr/://b?c#d", "http://É.Org/fr/é", "a://b://c/d", "http://x.net?/en/", "http://h.com#/de/", "http://www.spam-farm.example.org/de/1", "http://cheap-pills.example.com/", "x" * 100_000 + "://a.net/" + "y" * 100_000,
]


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(3, URLS[3]), (None, "http://a.net/")], "page_id long, url string")
    found = urlfilter.filtered(clashing(pages)).collect()
    assert len(found) == len(URLS) + 2
    for r in found:
        if r.page_id is None:
            continue
        assert (r.host, r.path) == parts(URLS[r.page_id])
        rule = slow_rule(r.host, r.path)
        assert r.rule == (rule and rule[0])
        assert rule or r.verdict in ("allow", "block")
        assert not rule or r.verdict == rule[1]
    scores = {"allow": [0.0], "block": [1.0]}
    for r in found:
        if r.rule is None:
            scores[r.verdict].append(r.score)
            assert r.host or r.path or r.verdict == "allow"
    assert max(scores["allow"]) < min(scores["block"])
    half = urlfilter.filtered(pages, threshold=0.5).where("rule is null").collect()
    assert all((r.verdict == "block") == (r.score >= 0.5) for r in half)


#: The names of hosts in the test pages that a url filter has to block; all others are syllables.
BAD = ("spam-farm", "cheap-pills", "free-bets", "casino-win", "adult-x", "ads-track")


def test_real_pages(spark):
    found = urlfilter.filtered(real(spark, "pages", "0.1")).collect()
    urls = {r.page_id: r.url for r in real(spark, "pages", "0.1").collect()}
    assert all((r.host, r.path) == parts(urls[r.page_id]) for r in found)
    free = [r for r in found if r.rule is None]
    bad = [r for r in free if any(name in r.host for name in BAD)]
    plain = [r for r in free if not any(name in r.host for name in BAD)]
    assert len(bad) > 50 and len(plain) > 1000
    assert sum(r.verdict == "block" for r in bad) >= 0.99 * len(bad)
    assert sum(r.verdict == "allow" for r in plain) >= 0.99 * len(plain)


def test_labelled_urls_are_independent_of_the_pages(spark):
    own = {parts(u)[0] for u, _ in urlfilter.made_urls()}
    assert not own & {parts(r.url)[0] for r in real(spark, "pages", "0.1").collect()}


def encoded(urls):
    return [tuple(x.encode() for x in parts(u)) for u in urls]


def test_unseen_urls():
    made = urlfilter.made_urls()
    model, least = urlfilter.trained(encoded(u for u, _ in made), [y for _, y in made])
    bad = ["http://discount-pills-casino.example.com/en/1", "https://www.cheap-viagra.example.net/buy", "http://m.poker-4u.example.org/"]
    good = ["http://www.botany.example.org/en/articles", "https://news.village.example.com/en/council", "https://m.oriole.example.net/"]
    assert model.scores(encoded(bad)).min() > least > model.scores(encoded(good)).max()
    fresh = urlfilter.made_urls(500, seed=12)
    blocked = model.scores(encoded(u for u, _ in fresh)) >= least
    assert sum(b == bool(y) for b, (_, y) in zip(blocked.tolist(), fresh)) >= 0.97 * len(fresh)


def test_hosts_and_paths_share_no_feature():
    host, path = urlfilter.grams([b"casino"], 1)[1], urlfilter.grams([b"casino"], 2)[1]
    assert not set(host.tolist()) & set(path.tolist())


def test_too_many_rules_or_urls(spark):
    with pytest.raises(ValueError):
        urlfilter.filtered(real(spark, "pages"), labelled=[("http://a.com/", 1)] * (urlfilter.TRAINING_ROWS + 1))


def test_empty_table(spark):
    assert urlfilter.filtered(real(spark, "pages").limit(0)).count() == 0
