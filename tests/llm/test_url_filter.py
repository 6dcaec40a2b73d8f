import random

from jobtide.llm import url_filter


def brute(url, rules):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_matches_brute_force(table, python_free):
    random.seed(1)
    hosts = ["com", "a.com", "b.a.com", "x.org", "org", "", "xcom", "a.com:80"]
    paths = ["", "/", "/en/", "/en/a", "/e", "/fr/?q=/en/", "/fr#/"]
    rules = list({(random.choice(hosts), random.choice(["", "/", "/en/", "/e", "/fr/"]), random.choice(["allow", "block"])) for _ in range(9)})
    urls = [random.choice(["http://", "HTTPS://", "", "x://y://"]) + random.choice(hosts).upper() + random.choice(paths) for _ in range(150)] + [None, "", "://", "no url"]
    pages = table("page_id long, url string", [{"page_id": i, "url": u} for i, u in enumerate(urls)])
    listed = table("host string, path string, verdict string", [dict(zip(("host", "path", "verdict"), r)) for r in rules])
    for limit in (1 << 20, 0):
        found = url_filter.judge(pages, listed, ["page_id"], broadcast_bytes=limit)
        for row in found.collect():
            assert tuple(row)[1:] == brute(urls[row["page_id"]], rules), urls[row["page_id"]]


def test_false_positives_are_removed(spark):
    # every block is full, so that all candidates pass the filter
    rules = spark.range(40).selectExpr("concat('h', id, '.net') AS host", "'/' AS path", "'block' AS verdict")
    full = url_filter.bloom_filter(rules, 1)
    assert full.count() == 1
    pages = spark.range(200).selectExpr("id AS page_id", "concat('http://h', id, '.net/') AS url")
    found = url_filter.judge(pages, rules, ["page_id"])
    assert found.where("verdict = 'block'").count() == 40 and found.where("rule IS NULL AND verdict = 'allow'").count() == 160


def test_odd_rows(table, spark):
    pages = table("page_id long, url string", [{"page_id": 1, "url": "http://a.net/"}, {"page_id": 1, "url": "http://a.net/"}, {"page_id": None, "url": None}, {"page_id": 2, "url": "http://a.net/" + "x" * 50_000}], clashing=True)
    rules = spark.sql("SELECT * FROM VALUES ('net', '/', 'allow'), ('net', '/', 'block'), (null, '/', 'block'), ('net', null, 'block') AS t(host, path, verdict)")
    rows = url_filter.judge(pages, rules, ["page_id"]).collect()
    assert sorted((str(r["page_id"]), r["rule"], r["verdict"]) for r in rows if r["page_id"]) == [("1", "net/", "block"), ("1", "net/", "block"), ("2", "net/", "block")]
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in rows if r["page_id"] is None] == [("", "", None, "allow")]
    assert url_filter.judge(pages, rules.where("false"), ["page_id"]).where("verdict = 'allow'").count() == 4
    assert url_filter.judge(pages.where("false"), rules, ["page_id"]).count() == 0


def test_no_python_runs(spark, python_free):
    pages = spark.range(5).selectExpr("id AS page_id", "'http://a.net/' AS url")
    rules = spark.sql("SELECT * FROM VALUES ('net', '/', 'block') AS t(host, path, verdict)")
    python_free(url_filter.judge(pages, rules, ["page_id"]))
