import numpy as np
import pytest

from orderlens.llm import queries, url_filter as U

SF = "/root/testdata/sf0.001"
URLS = ["http://example.org/es/x", "https://WWW.Example.ORG/es/", "http://example.org/en/17?q=1", "http://example.org/en/2", "http://notexample.org/es/",
        "http://a.b.fr.com/fr/x", "http://x.com/de/1#f", "http://x.com/defoo", "http://x.com", "http://x.com?a=/de/", "noscheme/x.com/de/", None, "",
        "ftp://user@x.com:80/de/", "http://org/x", "http://x.org.", "http://", "a://b://com/de/", "http://é.com/de/é", "http://x.com/de/" + "y" * 50_000]


def brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for r, a in rules:
        rh, slash, rp = r.partition("/")
        if host and (host == rh or host.endswith("." + rh)) and path.startswith(slash + rp) and (best is None or len(r) > len(best[0])):
            best = (r, a)
    return host, path, best[0] if best else None, best[1] if best else default


@pytest.mark.parametrize("most", [U.MAX_ARRAY_RULES, 0])
def test_against_brute_force(spark, most):
    rows = [(i, u, "clash", "clash") for i, u in enumerate(URLS)] + [(None, URLS[0], None, None), (0, URLS[0], "clash", "clash")]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string, _key string").repartition(3)
    got = U.filter_urls(df, queries.URL_RULES, keep=("page_id",), max_array_rules=most).collect()
    want = sorted(((r[0], *brute(r[1], queries.URL_RULES)) for r in rows), key=repr)
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=repr) == want
    assert U.filter_urls(df.limit(0), queries.URL_RULES, max_array_rules=most).count() == 0
    assert {r.verdict for r in U.filter_urls(df, []).collect()} == {"allow"}


def test_colliding_keys_are_told_apart(spark, tmp_path):
    packed = U._pack([("a.com/", "block"), ("b.com/", "allow"), ("c.com/", "block")])
    n = int(packed[:8].view(np.int64)[0])
    packed[8:8 + 8 * n].view(np.int64)[:] = 5                      # all keys collide
    path = tmp_path / "rules"
    path.write_bytes(packed.tobytes())
    import pyarrow as pa
    hits = U.RuleArray(str(path)).probe(np.array([5, 5, 5, 6]), pa.array(["b.com/", "x.com/", "c.com/", "a.com/"]))
    assert hits == [(0, "allow", "b.com/"), (2, "block", "c.com/")]


def test_many_rules(spark):
    rules = [(f"h{i}.net/p{i % 7}", "block" if i % 2 else "allow") for i in range(3000)]
    urls = [(i, f"http://www.h{i % 4000}.net/p{i % 7}/z") for i in range(500, 8000, 3)]
    got = U.filter_urls(spark.createDataFrame(urls, "page_id long, url string"), rules, keep=("page_id",)).collect()
    table = dict(rules)
    for r in got:
        want = f"h{r.page_id % 4000}.net/p{r.page_id % 7}"
        assert r.rule == (want if want in table else None) and r.verdict == table.get(want, "allow")


def test_query(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in queries.QUERIES["op6_url_filter"](spark, SF).collect()}
    assert got == {i: brute(u, queries.URL_RULES) for i, u in pages.items()}
