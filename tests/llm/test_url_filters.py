from __future__ import annotations

from gondola.llm import url_filters
from gondola.llm.components import components
from gondola.llm.queries import RULES


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, tail = rest[:cut], rest[cut:]
    path = tail[: next((i for i, c in enumerate(tail) if c in "?#"), len(tail))]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_for(host, path):
    fits = [r for r in RULES if (host == (h := r.partition("/")[0]) or host.endswith("." + h)) and path.startswith("/" + r.partition("/")[2])]
    return max(fits, key=len, default=None)


def test_hosts_paths_and_rules(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://Ex.Example.NET/en/a?b#c", "x://a://b/c", "https://a.example.net", "https://a.example.net?x/", "http://net/", "http://internet/", "http://a.org/fr/", "http://a.org/f", "http://example.com/de/x", "http://É.net/\n", "http://a.example.net/EN/", "://net/x", "http://user@b.net:80/y"]
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate([*urls, *urls])], "page_id long, url string, host string")
    edges = spark.createDataFrame([], "a string, b string")
    got = {(r.page_id): r for r in url_filters.judge(pages, url_filters.rules_table(spark, RULES), edges).collect()}
    assert len(got) == 2 * len(urls)
    for k, u in enumerate([*urls, *urls]):
        host, path = plain(u)
        rule = rule_for(host, path)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule), u
        assert got[k].verdict == (RULES[rule] if rule else "allow")


def test_aliases_take_decisions(spark):
    edges = [("http://x.io/1", "http://x.io/2"), ("http://x.io/2", "http://bad.net/"), ("http://y.io/1", "http://bad.net/2"), ("http://y.io/1", "http://good.example.net/en/"), ("http://z.io/1", "http://z.io/2"), (None, "http://z.io/1"), ("http://bad.net/3", "http://bad.net/3")]
    urls = ["http://x.io/1", "http://x.io/2", "http://y.io/1", "http://bad.net/2", "http://z.io/1", "http://bad.net/3"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = url_filters.judge(pages, url_filters.rules_table(spark, RULES), spark.createDataFrame(edges, "a string, b string"))
    assert [r.verdict for r in out.orderBy("page_id").collect()] == ["block", "block", "allow", "block", "allow", "block"]


def test_links_in_pages(spark):
    html = {
        "http://a.io/d/e?x#y": '<LINK href="/c?a=1&amp;b=2" rel="canonical"><link rel=canonical href=f><a rel="canonical" href="/no">',
        "http://a.io": "<link rel='canonical' href='g'>",
        "https://b.io/p": '<meta content="0; url=//c.io/q" http-equiv="Refresh"><meta http-equiv="refresh" content="5">',
        "https://b.io/p?old": '<link rel="canonical" href="?new"><link rel="stylesheet" href="s">',
        None: '<link rel="canonical" href="/x">',
        "http://n.io": None,
    }
    pages = spark.createDataFrame(list(html.items()), "url string, html string")
    assert {tuple(r) for r in url_filters.link_edges(pages).collect()} == {
        ("http://a.io/d/e?x#y", "http://a.io/c?a=1&b=2"), ("http://a.io/d/e?x#y", "http://a.io/d/f"), ("http://a.io", "http://a.io/g"),
        ("https://b.io/p", "https://c.io/q"), ("https://b.io/p?old", "https://b.io/p?new"),
    }


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(k, k + 1) for k in range(200)]
    star = [(1000, 1000 + k) for k in range(300)]
    edges = [*chain, *star, (5, 5), (7, 3), (None, 1), (2000, 2001), (2001, 2000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1300), 1000), 2000: 2000, 2001: 2000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_addresses_meet_however_written(spark):
    ways = [
        ("HTTP://X.IO/a", "http://x.io/a"), ("http://x.io/a#top", "http://x.io/a"), ("http://x.io:80", "http://x.io/"), ("https://x.io:443/?q#f", "https://x.io/?q"), ("https://x.io:80/", "https://x.io:80/"),
        ("http://x.io./A", "http://x.io/A"), ("http://x.io.:8080/A", "http://x.io:8080/A"), ("no scheme#x", "no scheme"), ("", ""), (None, None), ("http://x.io?Q", "http://x.io/?Q"), ("http://x.io/" + "p" * 200_000 + "#z", "http://x.io/" + "p" * 200_000),
    ]
    pages = spark.createDataFrame(list(enumerate(a for a, _ in ways)), "page_id long, url string")
    got = pages.select("page_id", url_filters.address(pages.url).alias("a")).collect()
    assert [r.a for r in sorted(got)] == [b for _, b in ways]
    html = '<link rel="canonical" href="HTTP://Alias.IO:80/a">'
    table = spark.createDataFrame([(1, "http://bad.net/x", html), (2, "http://alias.io/a#top", ""), (2, "http://ALIAS.io/a", ""), (3, "http://alias.io/A", "")], "page_id long, url string, html string")
    out = url_filters.judge(table, url_filters.rules_table(spark, RULES), url_filters.link_edges(table)).collect()
    assert sorted((r.page_id, r.verdict) for r in out) == [(1, "block"), (2, "block"), (2, "block"), (3, "allow")]


def test_generated_graph_equals_union_find(spark):
    """Chains, cycles, stars and conflicting decisions, over pages and addresses that are none."""
    import random

    rng = random.Random(6)
    sites = ["http://p{}.io/x", "http://p{}.bad.net/x", "http://p{}.example.net/en/", "http://p{}.org/fr/", "http://p{}.example.com/de/y", "http://p{}.org/z"]
    nodes = [sites[min(rng.randrange(12), 5) if rng.random() < 0.5 else 0].format(k) for k in range(600)]
    edges = [(nodes[a], nodes[a + 1]) for a in range(0, 90)] + [(nodes[a], nodes[100 + (a - 99) % 60]) for a in range(100, 160)] + [(nodes[200], nodes[b]) for b in range(201, 260)]
    edges += [(rng.choice(nodes[300:]), rng.choice(nodes[300:])) for _ in range(120)]
    pages = [(k, n) for k, n in enumerate(nodes) if k % 5] + [(7, nodes[8])]
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in edges:
        parent[find(a)] = find(b)
    linked, voices = {n for e in edges for n in e}, {}
    for n in linked:
        rule = rule_for(*plain(n))
        if rule:
            voices.setdefault(find(n), set()).add(RULES[rule])
    want = []
    for k, n in pages:
        rule, heard = rule_for(*plain(n)), voices.get(find(n), set()) if n in linked else set()
        want.append((k, RULES[rule] if rule else "allow" if "allow" in heard or not heard else "block"))
    table = spark.createDataFrame(pages, "page_id long, url string")
    out = url_filters.judge(table, url_filters.rules_table(spark, RULES), spark.createDataFrame(edges, "a string, b string"))
    assert sorted((r.page_id, r.verdict) for r in out.collect()) == sorted(want)
    assert {v for _, v in want} == {"allow", "block"}


def test_query_on_linked_pages_equals_its_sql(spark, tmp_path):
    """The registered query and its SQL on pages that hold links, repeated ids among them."""
    import duckdb

    from gondola.llm.queries import QUERIES, SQL

    rows = [(k, f"http://s{k}.{'net' if k % 7 == 0 else 'org/fr' if k > 40 and k % 11 == 0 else 'io'}/p", f'<link rel="canonical" href="HTTP://S{k + 1}.IO/p">' if k % 3 else f'<meta http-equiv="refresh" content="0;url=http://s{5 + k // 30 * 30}.io/p">' if k % 30 else '') for k in range(60) if k != 29]
    rows += [(3, "http://s10.io/p#x", ""), (3, "http://s10.io/p#x", ""), (4, "http://s10.io/p#y", "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    database = duckdb.connect()
    database.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = database.sql(SQL["op4_url_filters"])
    got = QUERIES["op4_url_filters"](spark, str(tmp_path)).select(*want.columns)
    found = sorted(map(str, map(tuple, got.collect())))
    assert found == sorted(map(str, want.fetchall())) and len(found) == len(rows)
    assert {r.verdict for r in got.collect() if r.rule is None} == {"allow", "block"}
