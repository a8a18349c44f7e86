import collections

from llm_fixtures import shipped  # noqa: F401

from bucketlens.llm.url_filters import RULES, url_filter

SCHEMA = "page_id long, url string, html string"


def brute(pages, rules=RULES, rounds=10, threshold=0.5):
    def split(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:cut], rest[cut:]
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        return low, tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]

    edges, allowed, blocked, out = collections.Counter(), collections.Counter(), collections.Counter(), []
    for page, url, html, links in pages:
        host, path = split(url)
        best = None
        for verdict, rule in rules:
            own, rest = rule.split("/", 1)
            if (host == own or host.endswith("." + own)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[1])):
                best = (verdict, rule)
        if best:
            (allowed if best[0] == "allow" else blocked)[host] += 1
        for link in links:
            to = split(link if "://" in link else "http:" + link)[0]
            if host and to and to != host:
                edges[host, to] += 1
        out.append((page, host, path, best))

    def rank(seeds, flip):
        e = {((b, a) if flip else (a, b)): n for (a, b), n in edges.items()}
        total = collections.Counter()
        for (a, _), n in e.items():
            total[a] += n
        mass = sum(seeds.values())
        start = {h: n / mass for h, n in seeds.items()}
        r = dict(start)
        for _ in range(rounds):
            new = collections.Counter({h: 0.15 * x for h, x in start.items()})
            for (a, b), n in e.items():
                if a in r:
                    new[b] += 0.85 * r[a] * n / total[a]
            r = new
        return r

    trust, distrust = rank(allowed, False), rank(blocked, True)
    rows = []
    for page, host, path, best in out:
        t, d = trust.get(host, 0), distrust.get(host, 0)
        own = "block" if t + d and d / (t + d) > threshold else "allow"
        rows.append((page, host, path, best[1] if best else None, best[0] if best else own))
    return rows


def test_rules_and_propagation(spark):
    pages = [
        (1, "https://Good.ORG/a?x=1#y", ["http://friend.net/x", "//friend.net/y", "https://good.org/self"]),
        (2, "http://www.example.com/de/1", ["http://bad.net/"]),
        (3, "http://spam.net/", ["http://www.example.com/de/1", "http://friend.net/"]),
        (4, "http://friend.net/p", []),
        (5, "http://other.net/p", ["http://spam.net/z"]),
        (6, "http://a.example.org/es/q", []),
        (7, "http://example.org/en/1x", []),
        (8, "http://notorg/x", []),
        (9, "http://org", []),
        (10, "no url", []),
        (11, None, ["http://friend.net/"]),
        (12, "x://h1://h2/p", []),
        (12, "x://h1://h2/p", []),
    ]
    full = [(p, u, "".join(f'<a href="{x}">' for x in links), links) for p, u, links in pages]
    df = spark.createDataFrame([r[:3] for r in full] + [(13, "http://nul.net/", None)], SCHEMA)
    got = [tuple(r) for r in url_filter(df).drop("trust", "distrust").orderBy("page_id").collect()]
    assert got == brute([*full, (13, "http://nul.net/", None, [])])
    by_page = {r[0]: r[4] for r in got}
    assert by_page[3] == "block" and by_page[5] == "block" and by_page[4] == "allow" and by_page[13] == "allow"


def test_empty_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "http://a.org/x", "", "h", 1.0)], SCHEMA + ", host string, rank double")
    assert [tuple(r)[:5] for r in url_filter(df).collect()] == [(1, "a.org", "/x", "org/", "allow")]
    assert url_filter(df.limit(0)).count() == 0
