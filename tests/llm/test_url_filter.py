import re

import numpy as np
import pytest

from skein.llm import op7_url_filter as U
from skein.llm.op7_url_filter import RULES, filter_urls, host_edges, host_verdicts, judged_by_rules, op7_url_filter
from tests.conftest import SF001

SCHEMA = "page_id bigint, url string, html string, host string, verdict int, kind string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "k") for r in rows], SCHEMA)


def plain(url, rules=RULES):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fit = []
    for text, verdict in rules:
        h, p = text.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fit.append((len(text), text, verdict))
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


URLS = [None, "", "nourl", "http://", "http:///p", "http://A.Example.ORG/en/1?x#y", "https://example.org/es/", "https://example.org/es",
        "http://x.com/de/1", "http://x.com/fr", "http://x.com/fr/", "http://com/fr/a", "http://xcom/fr/a", "http://org", "http://org/", "http://a.org?x/",
        "ftp://b.net/z://c.org/", "http://É.ORG/a", "http://u@a.org:80/x", "http://a.net\n/x", "a://b://c/d", "http://example.org/en/12", "http://m.example.org/en/2"]


def test_rules_equal_the_plain_definition(spark):
    got = {r.page_id: r for r in judged_by_rules(pages(spark, [(i, u, None) for i, u in enumerate(URLS)]), RULES).collect()}
    for i, u in enumerate(URLS):
        assert (got[i].host, got[i].path, got[i].rule, got[i].decided) == plain(u), u


def link(*hosts):
    return "".join(f'<a href="http://{h}/x">y</a>' for h in hosts)


WEB = [(1, "http://good.org/", link("friend.net", "friend.net", "Other.net")), (2, "http://friend.net/a", link("pal.net")),
       (3, "http://bad.com/de/1", None), (4, "http://feeder.net/", link("bad.com")), (5, "http://pal.net/", ""),
       (6, "http://loner.net/", link("loner.net")), (7, "http://other.net/z", "<img src='//feeder.net/i'>"), (8, None, link("x.net")),
       (9, "http://sub.bad.com/en/", None)]


def test_edges(spark):
    got = {(r.src, r.dst): r.weight for r in host_edges(pages(spark, WEB)).collect()}
    assert got[("good.org", "friend.net")] == 2 and got[("good.org", "other.net")] == 1
    assert got[("other.net", "feeder.net")] == 1 and ("loner.net", "loner.net") not in got
    assert got[("sub.bad.com", "bad.com")] == 1 and got[("bad.com", "sub.bad.com")] == 1
    assert not any("x.net" in e for e in got)


def test_ranks_equal_power_iteration(spark):
    p = pages(spark, WEB)
    edges = {(r.src, r.dst): r.weight for r in host_edges(p).collect()}
    judged = judged_by_rules(p, RULES)
    seeds = [(r.decided, r.host) for r in judged.collect() if r.decided]
    hosts = sorted({h for e in edges for h in e} | {h for _, h in seeds})
    at = {h: i for i, h in enumerate(hosts)}
    want = {}
    for kind, verdict in (("trust", "allow"), ("distrust", "block")):
        a = np.zeros((len(hosts),) * 2)
        for (s, d), w in edges.items():
            s, d = (s, d) if kind == "trust" else (d, s)
            a[at[s], at[d]] += w
        out = a.sum(1, keepdims=True)
        a = np.divide(a, out, out=np.zeros_like(a), where=out > 0)
        seed = np.zeros(len(hosts))
        for v, h in seeds:
            seed[at[h]] += (v == verdict) / len(seeds)
        r = seed.copy()
        for _ in range(10):
            r = 0.85 * r @ a + 0.15 * seed
        want[kind] = r
    got = {r.host: r for r in host_verdicts(p, judged).collect()}
    for h, i in at.items():
        if h in got:
            assert got[h].trust == pytest.approx(want["trust"][i]) and got[h].distrust == pytest.approx(want["distrust"][i])
        else:
            assert want["trust"][i] == want["distrust"][i] == 0


def test_verdicts(spark):
    rows = WEB + [(3, "http://bad.com/de/1", None), (20, "http://new.net/", None)]
    got = filter_urls(pages(spark, rows)).collect()
    assert len(got) == len(rows)
    v = {r.page_id: r.verdict for r in got}
    assert v[3] == "block" and v[4] == "block"
    assert v[1] == v[2] == v[5] == v[6] == v[8] == v[20] == "allow"
    assert filter_urls(pages(spark, rows).limit(0)).count() == 0
    assert {r.verdict for r in filter_urls(pages(spark, [(1, "http://a.net/", None)])).collect()} == {"allow"}


def test_query_on_the_table(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    out = op7_url_filter(spark, SF001).collect()
    assert len(out) == len(urls)
    for r in out:
        host, path, rule, verdict = plain(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and (rule is None or r.verdict == verdict)


CHAIN = [(100 + i, f"http://c{i}.net/", link(f"c{i - 1}.net" if i else "bad.com")) for i in range(25)]


@pytest.mark.parametrize("more, blocked", [([], [3, 4, 9]), (CHAIN, [3, 4, *range(100, 125)])])
def test_ranks_are_the_converged_solution(spark, more, blocked):
    rows = WEB + [(3, "http://bad.com/de/1", None)] + more
    p = pages(spark, rows)
    edges = {(r.src, r.dst): r.weight for r in host_edges(p).collect()}
    seeds = [(r.decided, r.host) for r in judged_by_rules(p, RULES).collect() if r.decided]
    hosts = sorted({h for e in edges for h in e} | {h for _, h in seeds})
    at = {h: i for i, h in enumerate(hosts)}
    got = {r.host: r for r in filter_urls(p).collect()}  # one page per host
    for kind, verdict in (("trust", "allow"), ("distrust", "block")):
        a = np.zeros((len(hosts),) * 2)
        for (s, d), w in edges.items():
            s, d = (s, d) if kind == "trust" else (d, s)
            a[at[s], at[d]] += w
        out = a.sum(1, keepdims=True)
        a = np.divide(a, out, out=np.zeros_like(a), where=out > 0)
        seed = np.zeros(len(hosts))
        for v, h in seeds:
            seed[at[h]] += (v == verdict) / len(seeds)
        want = np.linalg.solve(np.eye(len(hosts)) - 0.85 * a.T, 0.15 * seed)
        for h, r in got.items():
            if h in at:
                assert (getattr(r, kind) or 0) == pytest.approx(want[at[h]], rel=1e-5)
        if kind == "trust":
            v = {r.page_id: r.verdict for r in got.values()}
            assert set(blocked) <= set(v)
            assert all(v[k] == "block" for k in blocked)
