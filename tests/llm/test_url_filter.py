import pytest

from skeinwork.llm.url_filter import ALLOW, BLOCK, DAMPING, THRESHOLD, judge_urls, longest_rules, rule_table

SCHEMA = "page_id long, url string, html string, host string, rule int"
RULES = [(BLOCK, "net/"), (ALLOW, "example.net/en/"), (BLOCK, "example.com/de/"), (ALLOW, "org/fr/")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host):].split("?", 1)[0].split("#", 1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    best = None
    for verdict, rule in RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return best or (None, None)


def brute(rows, links, family, rounds=12, threshold=THRESHOLD):
    hosts, edges = {}, {}
    for _, url, *_ in rows:
        h, p = parts(url)
        if h:
            got = hosts.setdefault(h, {"n": 0, ALLOW: 0, BLOCK: 0})
            got["n"] += 1
            if rule_of(h, p)[0]:
                got[rule_of(h, p)[0]] += 1
    for (_, url, *_), targets in zip(rows, links):
        h = parts(url)[0]
        for t in set(targets):
            if h and t and t != h:
                edges[h, t] = edges.get((h, t), 0) + 1
    if family:
        pairs = set()
        for h in set(hosts) | {d for _, d in edges}:
            while h.count(".") > 1:
                up = h.split(".", 1)[1]
                pairs |= {(h, up), (up, h)}
                h = up
        for e in pairs:
            edges[e] = edges.get(e, 0) + 1
    mass = {}
    for kind, es in ((ALLOW, edges), (BLOCK, {(b, a): w for (a, b), w in edges.items()})):
        total = sum(v[kind] for v in hosts.values())
        seed = {h: v[kind] / total for h, v in hosts.items() if v[kind]}
        out = {}
        for (a, _), w in es.items():
            out[a] = out.get(a, 0) + w
        now = dict(seed)
        for _ in range(rounds):
            new = {h: (1 - DAMPING) * m for h, m in seed.items()}
            for (a, b), w in es.items():
                new[b] = new.get(b, 0) + DAMPING * now.get(a, 0) * w / out[a]
            for h, m in now.items():
                if h not in out:
                    new[h] = new.get(h, 0) + DAMPING * m
            now = new
        mass[kind] = now
    everything, result = sum(v["n"] for v in hosts.values()), []
    for i, url, *_ in rows:
        h, p = parts(url)
        trust, distrust = mass[ALLOW].get(h, 0.0), mass[BLOCK].get(h, 0.0)
        verdict, rule = rule_of(h, p)
        verdict = verdict or (BLOCK if h and distrust - trust > threshold * hosts[h]["n"] / everything else ALLOW)
        result.append((i, h, p, rule, verdict, trust, distrust))
    return sorted(result, key=repr)


@pytest.mark.parametrize("family", [True, False])
def test_against_brute_force(spark, family):
    urls = [
        "http://A.Example.NET/en/1?x#y", "https://a.example.net/de/2", "http://example.com/de/", "http://m.example.com/de/x", "http://m.example.com/en/x",
        "http://b.org/fr/1", "http://b.org/en/1", "ftp://far.test?q=1", "http://far.test#z", "x://y://z/", "no host", None, "", "://", "http://notexample.com/de/1",
        "http://shop.test/en/", "http://shop.test/en/", "http://example.net/en", "http://net/", "http://b.org",
    ]
    links = [["b.org"], ["shop.test", "shop.test"], [], ["shop.test"], [], ["far.test", "b.org"], [], [], [], [], ["b.org"], [], [], [], ["example.com"], ["m.example.com"], ["m.example.com"], [], ["shop.test"], ["far.test"]]
    html = ["".join(f"<a HREF = 'https://{t.upper()}/p?q'>x</a><a href=/own>" for t in ts) + '<a href="//%s/x">' % ts[0] if ts else None for ts in links]
    rows = [(i, u, h, "clash", 1) for i, (u, h) in enumerate(zip(urls, html))] + [(None, "http://b.org/fr/2", None, None, None), (4, urls[4], html[4], None, 1)]
    got = judge_urls(spark.createDataFrame(rows, SCHEMA), RULES, family=family)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "trust", "distrust"]
    found = sorted((tuple(r) for r in got.collect()), key=repr)
    for a, b in zip(found, brute(rows, [*links, [], []], family), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-12)


def test_empty(spark):
    assert judge_urls(spark.createDataFrame([], SCHEMA), RULES).count() == 0


def test_links_between_hosts_decide(spark):
    """Hosts that link to blocked ones are blocked, those that allowed ones link to are not; no family edges are needed."""
    page = lambda host, *targets: (host, "".join(f'<a href="https://{t}/x">' for t in targets))
    pages = [page("http://good.org/fr/1", "friend.test", "friend.test"), page("http://good.org/fr/2", "friend.test"), page("http://bad.net/1"), page("http://bad.net/2"),
             page("http://farm.test/1", "bad.net"), page("http://farm.test/2", "bad.net"), page("http://friend.test/1", "good.org"), page("http://alone.test/1")]
    df = spark.createDataFrame([(i, u, h, None, None) for i, (u, h) in enumerate(pages)], SCHEMA)
    got = {r["host"]: r["verdict"] for r in judge_urls(df, RULES, family=False).collect()}
    assert got == {"good.org": ALLOW, "bad.net": BLOCK, "farm.test": BLOCK, "friend.test": ALLOW, "alone.test": ALLOW}


def test_a_hundred_thousand_rules(spark, rows):
    rules = [(BLOCK if i % 3 else ALLOW, f"h{i % 40_000}.example/{'abc'[i % 3]}/{'x' * (i // 40_000)}") for i in range(100_000)] + RULES
    urls = [(f"www.h{i}.example", f"/{'abc'[i % 3]}/xx") for i in range(300)] + [("a.example.net", "/en/q"), ("a.example.net", "/q"), ("nothing.test", "/")]
    found = longest_rules(spark.createDataFrame(urls, "host string, path string"), rule_table(spark, rules))
    want = []
    for host, path in urls:
        fits = [(len(r), r, n, v) for n, (v, r) in enumerate(rules) if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
        if fits:
            want.append((host, path, max(fits)[1], max(fits)[3]))
    assert rows(found) == sorted(want, key=repr) and len(want) > 250


def test_public_suffixes_are_no_family(spark):
    """Two firms below co.uk do not vouch for each other."""
    pages = [("http://a.firm.co.uk/1", None), ("http://firm.co.uk/en/1", None), ("http://other.co.uk/1", None)]
    df = spark.createDataFrame([(i, u, h, None, None) for i, (u, h) in enumerate(pages)], SCHEMA)
    got = {r["host"]: (r["verdict"], r["distrust"] > 0) for r in judge_urls(df, [(BLOCK, "firm.co.uk/en/")]).collect()}
    assert got["other.co.uk"] == (ALLOW, False) and got["a.firm.co.uk"][1]
