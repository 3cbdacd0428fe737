"""Source mixing, URL verdicts, the registered queries with SQL twins, and the pipeline."""

import os
import re
import sys
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.llm import source_mix, url_filter
from strata.llm.queries import ORACLE, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from check_oracle import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_sainte_lague_gives_highest_quotients(spark):
    claims = {"a": 53.0, "b": 24.0, "c": 23.0, "d": 0.0, "e": 24.0}
    for seats in (0, 1, 2, 7, 50, 131):
        parts = spark.createDataFrame([(k, v, seats, 10**6) for k, v in claims.items()], "k STRING, claim DOUBLE, seats BIGINT, cap BIGINT")
        got = {r.k: r.quota for r in source_mix.sainte_lague(parts, [], "claim", "seats", "cap", "k").collect()}
        bids = sorted(((-v / (2 * n + 1), k, n) for k, v in claims.items() if v for n in range(seats + 1)))[:seats]
        assert got == {k: sum(b[1] == k for b in bids) for k in claims}


def mixed(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    return docs, source_mix.mix(docs, block_words=8)


def test_mix_reaches_targets_and_reruns_agree(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 90)), "en", ["a", "b", "c", "é", None][0 if i % 3 else i % 5], 0) for i in range(900)]
    rows += [(5000, "tiny words here", "en", "small", 0), (5001, None, "en", "none", 0), (5002, "", "en", "none", 0),
             (5003, "long " * 20000, "en", "b", 0), (7, rows[7][1], "en", rows[7][3], 0)]
    docs, got = mixed(spark, rows)
    r = got.collect()
    assert len(r) == len(rows)
    size = Counter()
    for x in r:
        size[x.source] += x.size
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight, total, target = {s: i % 3 + 1 for i, s in enumerate(names)}, sum(size.values()), {}
    free = set(names)
    while free:
        per = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * per >= 3 * size[s]]
        if not over:
            break
        for s in over:
            target[s] = 3.0 * size[s]
            free.discard(s)
    target |= {s: weight[s] * per for s in free}
    taken = Counter()
    for x in r:
        assert 0 <= x.taken <= 3 * x.size and x.source_size == size[x.source]
        assert x.target == pytest.approx(target[x.source])
        taken[x.source] += x.taken
    assert all(abs(taken[s] - target[s]) <= 8 for s in names)
    again = source_mix.mix(docs.repartition(7), block_words=8)
    pick = ["doc_id", "size", "source", "target", "taken"]
    assert sorted(map(str, got.select(pick).collect())) == sorted(map(str, again.select(pick).collect()))


def test_mixture_holds_the_words_taken(spark):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(1 + i * 5 % 40)), "en", "ab"[i % 7 == 0], 0) for i in range(120)]
    docs, got = mixed(spark, rows)
    taken = {x.doc_id: x.taken for x in got.collect()}
    out = source_mix.mixture(docs, block_words=8)
    assert out.columns == docs.columns
    words, text = Counter(), {i: t for i, t, *_ in rows}
    for x in out.collect():
        words[x.doc_id] += len(x.text.split())
        assert x.text in text[x.doc_id] and x.n_chars == len(x.text)
    assert {k: v for k, v in taken.items() if v} == dict(words)
    assert source_mix.mixture(docs.limit(0)).count() == 0


def test_url_verdicts_and_aliases(spark):
    link = '<link rel="canonical" href="{}">'
    pages = [
        (1, "http://a.example.com/de/x?q=1#f", ""), (2, "http://A.Example.COM/en/", ""), (3, "https://sub.site.net/p", ""),
        (4, "https://www.example.net/en/1", ""), (5, "http://x.org/fr/", ""), (6, "http://x.org", ""), (7, None, None), (8, "no scheme", ""),
        (9, "ftp://notnet/", ""), (10, "http://net/", ""), (11, "http://x.net", ""), (12, "", ""),
        # aliases: 13 -> 14 -> a blocked host that no page has; 15 redirects to 13
        (13, "http://one.com/a", link.format("http://two.com/b")), (14, "http://two.com/b", "<link href='//evil.net/z' rel=canonical />"),
        (15, "http://three.com/c", '<META http-equiv="Refresh" content="0; URL=http://one.com/a#top">'),
        (16, "http://q.org/fr/ok", link.format("http://evil.net/z")),  # an allow rule of its own wins
        (17, "http://four.com/d", "<!--" + link.format("http://evil.net/z") + "--><script>'" + link.format("http://evil.net/z") + "'</script>"),
        (18, "http://five.com/e", link.format("/root?a=1&amp;b=2")), (13, "http://one.com/a", ""),
    ]
    df = spark.createDataFrame([(i, u, h, "z") for i, u, h in pages], "page_id BIGINT, url STRING, html STRING, rule STRING")
    rules = spark.createDataFrame(url_filter.RULES, "action string, rule string")
    edges = url_filter.link_edges(df)
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, rules, edges).collect()]
    assert len(got) == len(pages)
    want = {
        1: ("a.example.com", "/de/x", "example.com/de/", "block"), 2: ("a.example.com", "/en/", None, "allow"),
        3: ("sub.site.net", "/p", "net/", "block"), 4: ("www.example.net", "/en/1", "example.net/en/", "allow"),
        5: ("x.org", "/fr/", "org/fr/", "allow"), 6: ("x.org", "", None, "allow"), 7: ("", "", None, "allow"), 8: ("", "", None, "allow"),
        9: ("notnet", "/", None, "allow"), 10: ("net", "/", "net/", "block"), 11: ("x.net", "", None, "allow"), 12: ("", "", None, "allow"),
        13: ("one.com", "/a", None, "block"), 14: ("two.com", "/b", None, "block"), 15: ("three.com", "/c", None, "block"),
        16: ("q.org", "/fr/ok", "org/fr/", "allow"), 17: ("four.com", "/d", None, "allow"), 18: ("five.com", "/e", None, "allow")}
    assert {g[0]: g[1:] for g in got} == want
    assert ("http://five.com/e", "http://five.com/root?a=1&b=2") in {(r.src, r.dst) for r in edges.collect()}
    assert url_filter.judge(df.limit(0), rules, edges.limit(0)).count() == 0
    assert {r.verdict for r in url_filter.judge(df, rules.limit(0), edges).collect()} == {"allow"}


LINKED = [  # page, html, where its link leads (None: nowhere)
    ("http://a.org/x/y.html", "<link rel=canonical href='q'>", "http://a.org/x/q"),
    ("http://a.org/x/y.html?z=1#f", "<link href=\"?id=3&amp;b=2\" rel='canonical'>", "http://a.org/x/y.html?id=3&b=2"),
    ("http://a.org/x/y", "<link title='a>b' rel=\"canonical\" href='../../../up/./one/..'>", "http://a.org/up/"),
    ("http://a.org", "<link rel='canonical' href='page'>", "http://a.org/page"),
    ("http://a.org/x/", "<base href='http://www.example.com/de/'><link rel='canonical' href='q'>", "http://www.example.com/de/q"),
    ("http://a.org/x/", "<link rel=\"next canonical\" href='q'/><base target=_top href='../b/'><base href='http://c.org/'>", "http://a.org/b/q"),
    ("http://a.org/x/", "<meta http-equiv='refresh' content='0; url=./r?u=http://z.org/'>", "http://a.org/x/r?u=http://z.org/"),
    ("https://a.org/x/", "<link rel=canonical href='//b.org/../m'>", "https://b.org/../m"),
    ("http://a.org/x/", "<link rel=canonical href='/p/../q/#top'>", "http://a.org/q/"),
    ("http://a.org/x/", "<link rel=canonical href='mailto:x@y'>", None), ("http://a.org/x/", "<link rel=canonical href='#top'>", None),
    ("http://a.org/x/", "<link rel=canonical href=''>", None), ("http://a.org/x/", "<link rel=canonicalise href=q>", None),
    ("http://a.org/x/", "<!-- <link rel=canonical href=q> --><script><link rel=canonical href=q></script>", None),
    (None, "<link rel=canonical href=q>", None), ("http://a.org/x/", None, None)]


def test_links_are_resolved_and_the_sql_agrees(spark):
    rows = [(i, u and u.replace("a.org", f"a{i}.org"), h) for i, (u, h, _) in enumerate(LINKED)]
    df = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    got = {r.src: r.dst for r in url_filter.link_edges(df).collect()}
    want = {url.split("#")[0]: to.replace("a.org", f"a{i}.org") for (i, url, _), (_, _, to) in zip(rows, LINKED) if to}
    assert got == want
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    rules = spark.createDataFrame(url_filter.RULES, "action string, rule string")
    judged = url_filter.judge(df, rules, url_filter.link_edges(df)).select("page_id", "host", "path", "rule", "verdict")
    assert sorted(map(str, map(tuple, judged.collect()))) == sorted(map(str, con.execute(ORACLE["op8_url_filter"]).fetchall()))
    assert {r.page_id: r.verdict for r in judged.collect()}[4] == "block"  # through the base href


@needs_data
@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_its_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[key](spark, SF)
    rows, res = [tuple(r) for r in df.collect()], con.execute(ORACLE[key])
    names = [d[0] for d in res.description]
    assert digest(df.columns, rows)[0] == digest(names, res.fetchall())[0] and sorted(names) == sorted(df.columns)


@needs_data
def test_queries_without_sql(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    r = QUERIES["op3_source_mix"](spark, SF).collect()
    assert {x.doc_id: x.size for x in r} == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs.items()}
    r = QUERIES["op2_html_text"](spark, SF).collect()
    pages = {x.page_id: x.html for x in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(r) == len(pages)
    for x in r:  # in these pages the article element is the main text
        words = re.sub(r"<[^>]*>", " ", re.search(r"<article>(.*?)</article>", pages[x.page_id], re.S).group(1))
        assert set(re.findall(r"[a-z]{4,}", x.text)) >= set(re.findall(r"[a-z]{4,}", words)) - {"quot"}


@needs_data
def test_pipeline_stages(spark):
    import corpus_pipeline as cp
    from strata.llm.common import staged

    raw = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10**6 + i, None if i else "", "en", "srcx", 0) for i in range(2)], DOCS)
    docs = raw.unionByName(extra).unionByName(raw.limit(3)).withColumn("score", F.lit(1))
    counts = []
    for name, stage in cp.STAGES:
        docs = staged(stage(spark, docs, SF), "test-stage")
        counts.append(docs.count())
        if name != cp.STAGES[-1][0]:
            assert docs.columns == cp.COLUMNS
    assert counts[0] <= raw.count() + 5 and counts[1] == counts[0] and counts[2] < counts[1]
    assert all(r.n_tokens == len(r.ids) for r in docs.collect())
    # a stage on nothing gives nothing
    for _, stage in cp.STAGES:
        assert stage(spark, raw.limit(0), SF).count() == 0


def test_mixture_keeps_columns_of_any_name(spark):
    rows = [(i % 4 or None, f"w{i} " * (5 + i), "s", 6, 3, "h") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING, size INT, passes INT, h STRING")
    got = source_mix.mixture(docs, block_words=4)
    assert got.columns == docs.columns
    assert {(r.size, r.passes, r.h) for r in got.collect()} == {(6, 3, "h")} and got.count() >= 12
    whole = {t for _, t, *_ in rows}
    assert all(any(t.startswith(r.text) or r.text in t for t in whole) for r in got.collect())
