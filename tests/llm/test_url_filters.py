import re

import pandas as pd

from sitewatts.llm import url_filters as uf
from tests.llm import helpers as h


def parsed(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule(host, path, rules=uf.RULES):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def token(segment):
    m = re.fullmatch(r"(.*?)(\.[A-Za-z]{1,5})?", segment, re.S)
    stem, ending = m[1], m[2] or ""
    for name, pattern in (
        ("{date}", r"[0-9]{4}-[0-9]{2}-[0-9]{2}"), ("{n}", r"[0-9]+"),
        ("{uuid}", r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"), ("{hex}", r"(?=.*[0-9])[0-9A-Fa-f]{8,}"),
    ):
        if re.fullmatch(pattern, stem):
            return name + ending
    return segment


def brute(urls, rules=uf.RULES):
    """Verdicts by the method's definition, going up the tree level by level, on plain Python lists."""
    rows = [parsed(u) for u in urls]
    rows = [(host, path, rule(host, path, rules)) for host, path in rows]
    names = {(host, path): [token(x) for x in path.removeprefix("/").split("/")] for host, path, _ in rows}
    marks = [(r is not None and r.verdict == "block", r is not None) for _, _, r in rows]
    smooth = lambda b, n, above: (b + uf.SMOOTHING * above) / (n + uf.SMOOTHING)

    def sums(key):
        out = {}
        for row, m in zip(rows, marks, strict=True):
            k = key(row)
            if k is not None:
                b, n = out.get(k, (0, 0))
                out[k] = (b + m[0], n + m[1])
        return out

    hosts = {h: b / n if n else 0.0 for h, (b, n) in sums(lambda r: r[0]).items()}
    for level in reversed(range(max(map(len, names.values()), default=0))):
        deep = lambda r, level=level: len(names[r[:2]]) > level
        nodes = sums(lambda r: (r[0], *names[r[:2]][:level]) if deep(r) else None)
        alike = {}
        for (host, *way), (b, n) in sums(lambda r: (r[0], *names[r[:2]][: level + 1]) if deep(r) else None).items():
            share = smooth(*nodes[host, *way[:-1]], hosts[host])
            error = (max(share * (1 - share), 1e-4) / max(n, 1)) ** 0.5
            if way[-1] and not way[-1].startswith("{") and not (n and abs(b / n - share) > uf.SIGNIFICANT * error):
                alike.setdefault((host, *way[:-1]), set()).add(way[-1])
        for (host, _), way in names.items():
            if len(way) > level and way[level] in alike.get((host, *way[:level]), ()) and len(alike[host, *way[:level]]) > 1:
                way[level] = "*"
    total = [sum(m[k] for m in marks) for k in (0, 1)]
    overall = total[0] / total[1] if total[1] else 0.0
    prefixes = {}
    for level in range(1 + max(map(len, names.values()), default=0)):
        prefixes |= sums(lambda r, level=level: (r[0], *names[r[:2]][:level]) if len(names[r[:2]]) >= level else None)
    out = []
    for host, path, r in rows:
        p, way = overall, names[host, path]
        for level in range(len(way) + 1):
            p = smooth(*prefixes[host, *way[:level]], p)
        verdict = r.verdict if r else "block" if p >= uf.REJECT else "allow"
        out.append((host, path, r.text if r else None, verdict, "/" + "/".join(way), p))
    return out


def check(urls, out, rules=uf.RULES):
    want = dict(enumerate(brute(urls, rules)))
    assert len(out) == len(urls)
    for r in out:
        host, path, text, verdict, template, purity = want[r.page_id]
        assert (r.host, r.path, r.rule, r.template) == (host, path, text, template)
        assert abs(r.purity - purity) < 1e-9 and (r.verdict == verdict or abs(purity - uf.REJECT) < 1e-9)


def test_whole_table_matches_brute_force(spark):
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet")
    out = {r.page_id: r for r in uf.op8_url_filter(spark, "/root/testdata/sf0.01").collect()}
    want = brute(pages.url.tolist())
    assert len(out) == len(pages)
    for page, (host, path, text, verdict, template, purity) in zip(pages.page_id, want, strict=True):
        r = out[page]
        assert (r.host, r.path, r.rule, r.verdict, r.template) == (host, path, text, verdict, template) and abs(r.purity - purity) < 1e-9


def test_odd_urls_and_trees(spark, extra):
    urls = [None, "", "no scheme", "http://", "HTTP://A.COM", "http://x.COM/DE/a", "https://org", "https://org/", "https://Sub.Org?x=/y",
            "http://corg/", "http://example.org/en/1x", "http://example.org/es/", "a://b://c/d", "http://h.com/fr/#f", "http://h.com" + "/s" * 30]
    urls += [f"http://shop.com/p/item-{k}x/{k}.html" for k in range(40)] + ["http://shop.com/p/best/1.html"] * 20
    urls += [f"http://bad.com/de/{k}" for k in range(30)] + [f"http://bad.com/en/{k}" for k in range(5)]
    urls += [f"http://bad.com/2024-01-0{k}/deadbeef0{k}" for k in range(1, 5)] + ["http://bad.com/123e4567-e89b-12d3-a456-426614174000"]
    urls += ["http://bad.com/en/1"] * 3
    df = extra(h.frame(spark, list(enumerate(urls)), "page_id long, url string"))
    out = uf.url_filter(df).collect()
    check(urls, out)
    by = {r.page_id: r for r in out}
    assert {r.template for r in by.values() if r.host == "shop.com"} == {"/p/*/{n}.html"}
    assert any(r.template == "/*" + "/s" * 29 for r in by.values())
    assert [r.verdict for r in by.values() if r.host == "bad.com" and r.path.startswith("/en/")] == ["block"] * 8
    assert uf.url_filter(h.frame(spark, [], "page_id long, url string")).count() == 0


def test_branches_are_told_apart_at_any_depth(spark):
    """What lies below the ninth segment, and siblings from two on, whatever their number."""
    deep = "/a/b/c/d/e/f/g/h"
    rules = (uf.Rule("block", "x.com", f"{deep}/bad/old"), uf.Rule("allow", "x.com", f"{deep}/good/old"), uf.Rule("block", "y.com", "/s1/"),
             uf.Rule("allow", "y.com", "/s2/a"))
    urls = [f"http://x.com{deep}/{kind}/{age}/{k}" for kind in ("bad", "good", "none") for age in ("old", "new") for k in range(10)]
    urls += [f"http://y.com/s{k}/{age}/{j}" for k in range(1, 20) for age in "ab" for j in range(6)]
    out = uf.url_filter(h.frame(spark, list(enumerate(urls)), "page_id long, url string"), rules).collect()
    check(urls, out, rules)
    verdicts = {}
    for r in out:
        verdicts.setdefault((r.host, r.path.split("/")[-3]), set()).add(r.verdict)
    assert verdicts["x.com", "bad"] == {"block"} and verdicts["x.com", "good"] == {"allow"} == verdicts["x.com", "none"]
    assert {r.template for r in out if "/none/" in r.path} == {f"{deep}/none/*/{{n}}"}
    assert {r.template for r in out if r.host == "y.com"} == {"/s1/*/{n}", "/s2/*/{n}", "/*/*/{n}"}


def test_a_very_deep_path(spark):
    urls = ["http://x.com" + "/s" * 3000, "http://x.com" + "/s" * 2000 + "/t" * 1000]
    got = {r.page_id: r.template for r in uf.url_filter(h.frame(spark, list(enumerate(urls)), "page_id long, url string")).collect()}
    assert got[0] == "/s" * 2000 + "/*" + "/s" * 999 and got[1] == "/s" * 2000 + "/*" + "/t" * 999
