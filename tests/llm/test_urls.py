import random
import re

import pytest

from nameledger.llm import urls

SCHEMA = "page_id bigint, url string, html string, host int, rule string, salt string, block string, w0 int"


def lowered(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)


def parts(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = lowered(re.match(r"[^/?#]*", rest)[0])
    after = rest[len(host) :]
    path = re.match(r"[^?#]*", after)[0]
    query = after[len(path) :].split("#")[0][1:]
    short = host.split("@", 1)[-1]
    short = short.removeprefix("www.")
    short = re.sub(r"\.?(:(80|443)?)?\Z", "", short, count=1)
    bare = re.sub(r"(/index\.html?)?/*\Z", "", path, count=1)
    kept = sorted(p for p in query.split("&") if p and not re.match(r"(utm_[^=]*|gclid|fbclid|ref)=", p))
    return host, path, short + bare + ("?" + "&".join(kept) if kept else "")


def plain(pages, listed):
    known = {parts(u)[2] for u in listed} - {None, ""}
    out = []
    for page, url, *_ in pages:
        host, path, canonical = parts(url)
        fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        if fits:
            _, rule, verdict = max(fits)
        else:
            rule, verdict = None, "block" if canonical in known else "allow"
        out.append((page, host, path, canonical, rule, verdict))
    return sorted(out, key=repr)


def some_pages():
    draw = random.Random(4)
    hosts = ["a.example.com", "WWW.a.Example.com", "b.org", "example.net", "x.example.net", "net", "notexample.net", "org", "me@a.example.com", "a.example.com:80", "a.example.com."]
    paths = ["", "/", "/en/1", "/de/2", "/fr/", "/fr", "/x/index.html", "/x/", "/x", "/xé//"]
    ends = ["", "?utm_source=f", "?b=1&a=2", "?a=2&b=1&ref=x", "#top", "?#x?y", "?a=2&&b=1#://"]
    pages = [(i, f"{draw.choice(['http', 'HTTPS'])}://{draw.choice(hosts)}{draw.choice(paths)}{draw.choice(ends)}") for i in range(900)]
    pages += [(1000, None), (1001, ""), (1002, "no url"), (1003, "://"), (1004, "http://"), (1005, "http://a.example.com/q\n/r?x"), (None, "http://b.org/x"), (7, "http://b.org/x"), (7, "http://b.org/x")]
    pages += [(2000 + i, "http://a.example.com/x") for i in range(300)]
    pages.append((3000, "http://b.org/" + "long/" * 20_000))
    return [(i, u, "<p>", 1, "r", "s", "b", 2) for i, u in pages]


def test_against_plain_python(rows):
    pages = some_pages()
    draw = random.Random(5)
    listed = [p[1] for p in draw.sample(pages, 40)] + [None, "", "http://", "https://www.a.example.com/x/#z", "http://b.org/" + "long/" * 20_000]
    got = urls.judge_urls(rows(pages, SCHEMA), rows([(u, 1) for u in listed], "url string, n int"))
    assert got.columns == ["page_id", "url", "html", "salt", "block", "w0", "host", "path", "canonical", "rule", "verdict"]
    found = [tuple(r[c] for c in ("page_id", "host", "path", "canonical", "rule", "verdict")) for r in got.collect()]
    assert sorted(found, key=repr) == plain(pages, listed)
    assert {v for *_, r, v in found if r is None} == {"allow", "block"}
    kept = urls.keep_allowed(rows(pages, SCHEMA), rows([(u, 1) for u in listed], "url string, n int"))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert kept.count() == sum(f[-1] == "allow" for f in found)


@pytest.mark.parametrize("most", [1, 1 << 20])
def test_filter_passes_all_listed_and_few_others(spark, monkeypatch, most):
    monkeypatch.setattr(urls, "MOST_BLOCKS", most)
    listed = spark.range(3000).selectExpr("concat('http://h.com/', id) AS url")
    pages = spark.range(20000).selectExpr("id AS page_id", "concat('https://h.com/', id, '/') AS url")
    assert urls.judge_urls(pages, listed, []).where("verdict = 'block'").count() == 3000  # whatever the filter lets through
    bloom, blocks = urls.blocked_bloom(listed.select(urls.canonical_url(listed.url).alias("canonical")))
    assert blocks == min(most, 256) and bloom.count() <= blocks


def test_empty_tables(rows):
    none, some = rows([], SCHEMA), rows(some_pages(), SCHEMA)
    assert urls.judge_urls(none, none).count() == 0
    got = urls.judge_urls(some, none)
    assert got.count() == some.count() and got.where("rule IS NULL AND verdict = 'block'").count() == 0


def test_no_python_in_the_plan(rows):
    some = rows([(1, "http://a.com/")], "page_id bigint, url string")
    plan = urls.judge_urls(some, some)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
