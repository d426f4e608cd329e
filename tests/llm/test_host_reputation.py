"""URL filters: host and path, rules, and the beta-binomial reputation against a plain Python reckoning."""

import math

from articlelake.llm import host_reputation as hr
from tests.conftest import rows

PAGES = "page_id long, url string, host string, verdict int"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    after = url.split("://", 1)[1]
    end = min([after.index(c) for c in "/?#" if c in after] + [len(after)])
    host, rest = after[:end], after[end:]
    end = min([rest.index(c) for c in "?#" if c in rest] + [len(rest)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def rule_of(host, path, rules=hr.RULES):
    fits = [(h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    fits.sort(key=lambda f: (-len(f[0]), f[1] != "block", f[0]))
    return fits[0] if fits else (None, None)


def strength(groups):
    """groups: (n, k, prior_mean) with n > 0."""
    if not groups:
        return 1000.0
    excess = sum((k / n - m) ** 2 - m * (1 - m) / n for n, k, m in groups) / len(groups)
    if excess <= 0:
        return 1000.0
    return min(max(sum(m * (1 - m) for _, _, m in groups) / len(groups) / excess - 1, 1.0), 1000.0)


def brute(pages, outcomes):
    count = {}
    for url, bad in outcomes:
        if bad in (0, 1):
            n, k = count.get(parts(url)[0], (0, 0))
            count[parts(url)[0]] = (n + 1, k + bad)
    hosts = {parts(u)[0] for _, u in pages} | set(count)
    domain = {h: ".".join(h.split(".")[-2:]) for h in hosts}
    suffix = {h: h.split(".")[-1] for h in hosts}

    def sums(key):
        out = {}
        for h in hosts:
            n, k = count.get(h, (0, 0))
            a, b = out.get(key[h], (0, 0))
            out[key[h]] = (a + n, b + k)
        return out

    by_suffix, by_domain = sums(suffix), sums(domain)
    total_n, total_k = sum(n for n, _ in by_suffix.values()), sum(k for _, k in by_suffix.values())
    prior = (total_k + 1) / (total_n + 2)

    def level(groups, prior_of):
        s = strength([(n, k, prior_of(g)) for g, (n, k) in groups.items() if n > 0])
        return {g: (k + s * prior_of(g), n - k + s * (1 - prior_of(g))) for g, (n, k) in groups.items()}

    post_s = level(by_suffix, lambda g: prior)
    mean = lambda ab: ab[0] / (ab[0] + ab[1])
    post_d = level(by_domain, lambda d: mean(post_s[d.split(".")[-1]]))
    post_h = level({h: count.get(h, (0, 0)) for h in hosts}, lambda h: mean(post_d[domain[h]]))
    out = {}
    for page_id, url in pages:
        host, path = parts(url)
        a, b = post_h[host]
        lower = a / (a + b) - hr.Z * math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))
        rule, verdict = rule_of(host, path)
        out.setdefault(page_id, []).append((host, path, rule, verdict or ("block" if lower >= hr.BLOCK_AT else "allow")))
    return out


URLS = [
    "http://www.Example.ORG/es/x", "https://example.org/en/12", "https://a.example.org/en/2?q=/es/", "http://x.org",
    "http://x.org/", "ftp://sub.example.com/fr/a#/de/", "http://b.com/de/", "HTTP://SHOP.COM:8080/DE/", None, "", "no scheme",
    "http://ÄBC.Example.net/Path?x#y", "http://host?x", "http://host#frag/x", "a://b://c/d", "http://spam.example.net/p",
    "http://spam.example.net/q", "http://spam.example.net/r", "http://spam.example.net/s", "http://ok.example.net/a",
    "http://.org/", "http://org./", "http://ORG/",
]


def table(spark):
    pages = [(i, u, "old host", 3) for i, u in enumerate(URLS)] + [(3, URLS[3], "again", 1), (99, URLS[0], None, None)]
    pages += [(1000 + i, "http://hot.example.com/p", None, None) for i in range(300)]  # a third of all rows
    outcomes = [(u, 1) for u in URLS[15:19]] * 5 + [(URLS[19], 0)] * 3 + [(URLS[0], 1), (URLS[1], 0), (None, 1),
                                                                          ("http://hot.example.com/x", 0), (URLS[2], 7)]
    return pages, outcomes


def test_equals_python_reckoning(spark):
    pages, outcomes = table(spark)
    df = spark.createDataFrame(pages, PAGES)
    out = hr.judge(df, spark.createDataFrame(outcomes, "url string, bad int"))
    assert out.columns[:2] == ["page_id", "url"] and "verdict" in out.columns and out.count() == len(pages)
    found = {}
    for r in out.collect():
        found.setdefault(r.page_id, []).append((r.host, r.path, r.rule, r.verdict))
    want = brute([(p, u) for p, u, _, _ in pages], outcomes)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    spam = out.where("host = 'spam.example.net'").select("verdict").distinct().collect()
    assert [r.verdict for r in spam] == ["block"]  # twenty bad pages, none good
    assert rows(out.where("page_id = 6").select("rule", "verdict")) == [("com/de/", "block")]
    assert rows(out.where("page_id = 7").select("host", "path", "rule")) == [("shop.com:8080", "/DE/", None)]
    assert rows(out.where("page_id = 0").select("rule", "verdict")) == [("example.org/es/", "block")]
    assert rows(out.where("page_id = 2").select("rule", "verdict")) == [("org/", "allow")]


def test_parts_of_urls(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    host, path = hr.host_and_path(df.url)
    got = {r.page_id: (r.h, r.p) for r in df.select("page_id", host.alias("h"), path.alias("p")).collect()}
    assert got == {i: parts(u) for i, u in enumerate(URLS)}
    assert got[11] == ("Äbc.example.net", "/Path")


def test_no_outcomes_and_empty_pages(spark):
    none = spark.createDataFrame([], "url string, bad int")
    pages = spark.createDataFrame([(1, "http://a.net/x"), (2, None)], "page_id long, url string")
    assert sorted(r.verdict for r in hr.judge(pages, none).collect()) == ["allow", "allow"]
    assert hr.judge(spark.createDataFrame([], "page_id long, url string"), none).count() == 0
