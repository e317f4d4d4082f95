"""Url rules against a plain version; character models on made-up hosts."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

from arbor.llm import url_filter

from .helpers import clashing

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
URLS = [None, "", "nohost", "http://A.Example.NET/en/x?y#z", "HTTP://example.net", "http://example.net?x", "http://xnet/", "a://b://c/d",
        "http://www.Example.com/de/", "http://É.org/fr/\nx", "http://example.com/de", "http://notexample.com/de/", "https://x.org/fr/#a?b",
        "http://net/", "http://example.net/en", "://", "http:///p", "http://h#/p?q", "http://example.net/EN/"]


def plain(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", "", None
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1])
    best = None
    for h, p, v in RULES:
        if (host == h or host.endswith("." + h)) and m[2].startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return host, m[2], best


def test_hosts_paths_and_rules(spark):
    df = clashing(spark.createDataFrame(list(enumerate(URLS)) + [(3, URLS[3]), (None, URLS[4])], "page_id long, url string"))
    got = url_filter.filter_urls(df, RULES).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, rule = plain(URLS[r.page_id] if r.page_id is not None else URLS[4])
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[0])
        if rule:
            assert r.verdict == rule[1]
        if not URLS[r.page_id if r.page_id is not None else 4]:
            assert (r.verdict, r.score) == ("allow", 0.0)


def test_of_rules_of_one_length_the_later_wins(spark):
    df = spark.createDataFrame([(1, "http://a.b.example.org/xyz")], "page_id long, url string")
    rules = [("b.example.org", "/", "allow"), ("example.org", "/xy", "block")]
    assert [(r.rule, r.verdict) for r in url_filter.filter_urls(df, rules).collect()] == [("example.org/xy", "block")]
    assert [(r.rule, r.verdict) for r in url_filter.filter_urls(df, rules[::-1]).collect()] == [("b.example.org/", "allow")]


def corpus():
    rng = random.Random(3)
    good = [f"https://{rng.choice(['river', 'garden', 'museum', 'physics'])}{rng.choice(['notes', 'daily', 'forum'])}{rng.randrange(40) * 'x'}"
            f".example.com/en/{i}?page={rng.choice(['next', 'last'])}" for i in range(300)]
    bad = [f"http://{rng.choice(['casino', 'poker', 'free-bets'])}-{rng.choice(['win', 'best', 'top'])}{rng.randrange(40) * 'q'}.example.com/en/{i}"
           for i in range(60)]
    return good, bad, ["http://best-poker.example.com/en/1", "https://riverforum.example.com/en/2", "http://new.example.com/en/1?to=poker-best"]


def test_models_tell_rejected_urls(spark):
    good, bad, unseen = corpus()
    df = spark.createDataFrame(list(enumerate(good + bad + unseen)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(df, []).collect()}
    right = [got[i] == ("allow" if i < 300 else "block") for i in range(360)]
    assert sum(right[:300]) > 290 and sum(right[300:]) > 56
    assert got[360] == "block" and got[361] == "allow" and got[362] == "block"  # the last one by its query alone


def test_scores_are_those_of_plain_models(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "HOT", 50)  # the others are joined
    good, bad, unseen = corpus()
    urls = good[:60] + bad[:20] + unseen + ["nohost", "HTTP://É.Example.org/a?b=Ç😀c#win", "http://long.example.com/" + "ab9" * 20_000]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.score for r in url_filter.filter_urls(df, []).collect()}
    hosts = {plain(u)[0] for u in urls}
    fold = {r.h: r.f % url_filter.FOLDS for r in spark.createDataFrame([(h,) for h in hosts], "h string").selectExpr("h", "xxhash64(h) f").collect()}
    text = {u: re.sub("[0-9]+", "0", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in u)) for u in urls}
    rejected = {t: bool(set(re.split("[^a-z]+", t)) & set(url_filter.REJECTED_TERMS)) for t in text.values()}
    own = {text[u]: fold[plain(u)[0]] for u in urls}
    symbols = len(set("".join(own)))
    for f in range(url_filter.FOLDS):
        seen = [defaultdict(Counter), defaultdict(Counter)]
        for t, mine in own.items():
            if mine != f:
                padded = url_filter.START * 5 + t
                for i, c in enumerate(t):
                    for k in range(6):
                        seen[not rejected[t]][padded[i + 5 - k:i + 5]][c] += 1

        def log_p(model, before, c):
            p = 1 / symbols
            for k in range(6):
                after = model.get(before[5 - k:])
                if after:
                    p = (after[c] + len(after) * p) / (sum(after.values()) + len(after))
            return math.log(p)

        known = {}
        for i, u in enumerate(urls):
            t = text[u]
            if own[t] == f:
                padded, total = url_filter.START * 5 + t, 0.0
                for j, c in enumerate(t):
                    run = padded[j:j + 5], c
                    if run not in known:
                        known[run] = log_p(seen[1], *run) - log_p(seen[0], *run)
                    total += known[run]
                assert abs(got[i] - total / len(t)) < 1e-5, u


def test_one_class_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://a.example.com/x")], "page_id long, url string")
    assert [r.verdict for r in url_filter.filter_urls(df, []).collect()] == ["allow"]
    assert url_filter.filter_urls(df.where("false"), RULES).collect() == []
