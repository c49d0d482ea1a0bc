import random
import re

from llm_data import no_python

from vigil.llm import url_filter

RULES = url_filter.RULES


def host_path(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (m[1].translate(low), m[2]) if m else ("", "")


def rule_by_hand(host, path):
    fits = []
    for verdict, rule in RULES:
        h, p = rule[:rule.index("/")], rule[rule.index("/"):]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(rule), len(h), verdict == "block", rule, verdict))
    return max(fits)[3:] if fits else (None, None)


def by_hand(pages, damping=0.7, threshold=0.5):
    hosts = {}
    for _, url, html in pages:
        h, p = host_path(url)
        hosts.setdefault(h, []).append((rule_by_hand(h, p)[1], html))
    edges = {}
    for h, rows in hosts.items():
        for _, html in rows:
            for x in {x.lower() for x in re.findall(r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s>]+)""", html or "")}:
                edges[h, x] = edges.get((h, x), 0) + 1
        up = h.partition(".")[2] if "." in h else h
        if up != h and up in hosts:
            edges[h, up], edges[up, h] = edges.get((h, up), 0) + 1, edges.get((up, h), 0) + 1
    edges = {(a, b): w for (a, b), w in edges.items() if a != b and a and b}
    nodes = set(hosts) | {x for e in edges for x in e}
    share = {v: {h: sum(r == v for r, _ in hosts.get(h, [])) / max(1, len(hosts.get(h, []))) for h in nodes} for v in ("allow", "block")}
    out, into = {}, {}
    for (a, b), w in edges.items():
        out[a], into[b] = out.get(a, 0) + w, into.get(b, 0) + w
    t, d = dict(share["allow"]), dict(share["block"])
    for _ in range(100):
        t2, d2 = dict(share["allow"]), dict(share["block"])
        for (a, b), w in edges.items():
            t2[b] += damping * t[a] * w / out[a]
            d2[a] += damping * d[b] * w / into[b]
        t, d = t2, d2
    res = []
    for i, url, _ in pages:
        h, p = host_path(url)
        rule, verdict = rule_by_hand(h, p)
        res.append((i, h, p, rule, verdict or ("block" if d[h] >= threshold and d[h] > t[h] else "allow")))
    return res, t, d


def web(seed=1):
    rng = random.Random(seed)
    names = ["a.example.org", "www.a.example.org", "b.example.net", "c.example.com", "www.example.com", "x.org", "spam.net", "farm.org", "deep.farm.org", "Blog.X.org"]
    pages = []
    for i in range(300):
        h = rng.choice(names)
        url = rng.choice(["http://", "HTTPS://", "ftp://"]) + h + rng.choice(["", "/", "/en/1", "/es/2", "/fr/3?x=/en/", "/de/4#t", "?q"])
        if h == "spam.net":
            url = "http://spam.net/es/" + str(i)
        links = ["spam.net"] * (h in ("farm.org", "x.org")) + ["farm.org"] * (h == "deep.farm.org") + rng.sample(names, 1) * (rng.random() < 0.2)
        pages.append((i, url, "".join(f"<a href='http://{x}/p'>x</a><a HREF=//{x.upper()}>" for x in links) + '<a href="/en/">in</a>'))
    return pages + [(300, None, None), (301, "no scheme", ""), (301, "no scheme", ""), (None, "x://:b@h:1/a://c", None), (302, "http://spam.net", None), (303, "http://farm.org/q", None)]


def test_verdicts_equal_plain_python(spark, monkeypatch):
    pages = web()
    df = spark.createDataFrame([(*p, 1, "x") for p in pages], "page_id long, url string, html string, trust int, rules_x string")
    want, trust, distrust = by_hand(pages)
    assert {v for *_, r, v in want if r is None} == {"allow", "block"}
    for limit in (1 << 25, 0):
        monkeypatch.setattr("vigil.llm._jobs.BROADCAST_BYTES", limit)
        got = url_filter.judge_urls(df, tolerance=1e-3)
        assert no_python(got) and "html" not in got.columns and "rules_x" in got.columns
        rows = got.collect()
        assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in rows), key=str) == sorted(want, key=str)
        assert all(abs(r.trust - trust[r.host]) < 1e-2 and abs(r.distrust - distrust[r.host]) < 1e-2 for r in rows)


def test_no_rows(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filter.judge_urls(none).collect() == []
