import random

from ledgerframe.llm import url_filter as U
from ledgerframe.llm.queries import URL_RULES

from .conftest import rows_of


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    end = min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))
    return host, path[:end]


def rule_of(host, path):
    best = None
    for action, rule in URL_RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            if best is None or len(rule) > len(best[0]):
                best = rule, action
    return best


def test_rules_equal_brute_force(spark):
    rng = random.Random(3)
    parts = ["http://", "https://", "://", "a", "www.", "Example.ORG", "example.org", "org", "com", ".", "/", "/es/",
             "/en/1", "/fr/", "/de/", "?", "#", "x=1&y", "é", "xexample.org", "\n"]
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.org/es/x", "http://org/a", "http://a.org"]
    urls += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 8))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r for r in rows_of(U.judge_urls(df, URL_RULES))}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        host, path = split(url)
        best = rule_of(host, path)
        assert (got[i]["host"], got[i]["path"]) == (host, path), url
        assert got[i]["rule"] == (best[0] if best else None), url
        assert got[i]["verdict"] in ("allow", "block") and (not best or got[i]["verdict"] == best[1])


def test_trees_learn_from_labelled_urls(spark):
    rng = random.Random(4)
    rows = []
    for i in range(1500):
        bad = i % 3 == 0
        host = f"{'x-1-' if bad else ''}{rng.choice(['alpha', 'beta', 'gamma'])}.example.net"
        rows.append((i, f"http://{host}/{'9' * rng.randint(4, 9) if bad else 'page'}/{rng.randint(0, 99)}",
                     "block" if bad else "allow"))
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    got = rows_of(U.judge_urls(pages.drop("verdict"), [], labelled=pages.where("page_id % 2 = 0")))
    right = {i: v for i, _, v in rows}
    held = [r["verdict"] == right[r["page_id"]] for r in got if r["page_id"] % 2]
    assert sum(held) / len(held) > 0.97


def test_one_label_no_label_repeats_and_empty(spark):
    rows = [(1, "http://a.org/x", 5), (1, "http://a.org/x", 5), (2, "http://b.net/", 5), (None, None, 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, host int")
    assert {r["verdict"] for r in rows_of(U.judge_urls(df, URL_RULES))} == {"allow"}
    assert {r["verdict"] for r in rows_of(U.judge_urls(df, [("block", "org/")]))} == {"block"}
    assert {r["verdict"] for r in rows_of(U.judge_urls(df, []))} == {"allow"}
    assert U.judge_urls(df.limit(0), URL_RULES).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = U.judge_urls(df, URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_training_sample_has_each_url_once_and_every_label(spark):
    urls = [f"http://h{i}.example.net/" for i in range(60)]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    low, *rest = [r["url"] for r in rows_of(pages.orderBy(U.F.xxhash64("url")))]
    rows = [(low, 1.0)] * 200 + [(u, 1.0) for u in rest[:50]] + [(u, 0.0) for u in rest[50:]]
    got = rows_of(U.training_sample(spark.createDataFrame(rows, "url string, label double"), 20))
    assert len(got) == len({r["url"] for r in got}) == 20
    assert [sum(r["label"] == x for r in got) for x in (0.0, 1.0)] == [9, 11]
    assert {r["url"]: round(r["weight"], 6) for r in got}[low] == round(200 * 51 / 11, 6)
    assert rows_of(U.training_sample(spark.createDataFrame(rows[:1], "url string, label double").limit(0))) == []
