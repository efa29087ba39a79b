"""The URL filter, the quality classifier and the pipeline."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

import corpus_pipeline
from ledgerline.llm import quality, queries, url_filter

RULES = queries.RULES


def judged(url):
    """Host, path, rule and its verdict, by the letter of the contract."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :], re.S)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(rule), rule, verdict) for rule, verdict in RULES if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0])) and path.startswith("/" + rule.split("/", 1)[1])]
    return host, path, *(max(fits)[1:] if fits else (None, None))


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?q#f", "http://a.com", "x://h?y/en/", "http://b.net/fr/", "http://b.net/de/#/fr/", "http://example.com/en", "http://notexample.com/en/", "a://b://c.com/", "http://É.com/é\n/x", "http://com/", "http://x.com:80/en/", "http://net/es/a", "http://w.example.com/en/"]


def test_urls_are_judged_by_the_longest_rule(spark):
    rows = [(i, u, None, "x", 0.0) for i, u in enumerate(URLS)] + [(0, None, "<a href=''>", "x", 0.0)]
    found = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string, host string, trust double"), RULES).collect()
    assert len(found) == len(rows)
    for r in found:
        host, path, rule, verdict = judged(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), URLS[r["page_id"]]
        assert r["verdict"] in ("allow", "block") and r["verdict"] == (verdict or r["verdict"])
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string, html string"), RULES).count() == 0


def test_propagation_is_personalised_pagerank(spark):
    rnd = random.Random(2)
    n = 25
    edges = sorted({(rnd.randrange(n), rnd.randrange(n)) for _ in range(90)})
    weight = {e: rnd.randint(1, 4) for e in edges}
    trusted, blocked = [0.5 if i < 2 else 0.0 for i in range(n)], [1.0 if i == 9 else 0.0 for i in range(n)]
    hosts = spark.createDataFrame([(f"h{i}", trusted[i], blocked[i]) for i in range(n)], "host string, trusted double, blocked double")
    table = spark.createDataFrame([(f"h{a}", f"h{b}", float(w)) for (a, b), w in weight.items()], "src string, dst string, weight double")
    found = {r["host"]: (r["trust"], r["distrust"]) for r in url_filter.propagate(hosts, table, rounds=6).collect()}
    m = np.zeros((n, n))
    for (a, b), w in weight.items():
        m[a, b] = w
    along = m / np.maximum(m.sum(1, keepdims=True), 1e-300)
    against = m.T / np.maximum(m.T.sum(1, keepdims=True), 1e-300)
    t, d = np.array(trusted), np.array(blocked)
    for _ in range(6):
        t, d = 0.15 * np.array(trusted) + 0.85 * t @ along, 0.15 * np.array(blocked) + 0.85 * d @ against
    assert np.allclose([found[f"h{i}"] for i in range(n)], np.column_stack([t, d]))


def test_distrust_reaches_hosts_that_link_to_blocked_ones(spark):
    pages = [(i, f"http://bad.net/fr/{i}", None) for i in range(3)] + [(10, "http://fan.org/", "<a href='http://bad.net/x'>x</a><A HREF=//bad.net/y>"), (11, "http://calm.org/", "<a href='/own'>x</a>"), (12, "http://good.com/", None)]
    found = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), RULES).collect()}
    assert found == {0: "block", 1: "block", 2: "block", 10: "block", 11: "allow", 12: "allow"}


def test_hosts_of_many_labels_and_long_chains_are_reached(spark):
    deep = ".".join(f"l{i}" for i in range(11)) + ".bad.net"
    pages = [(i, f"http://bad.net/fr/{i}", None) for i in range(3)] + [(10, f"http://{deep}/", None), (11, "http://good.org/", None), (12, "http://" + "a." * 4000 + "net/", None)]
    pages += [(20 + i, f"http://c{i}.org/", f"<a href='http://c{i - 1}.org/'>" if i else "<a href='//bad.net/'>") for i in range(12)]
    found = {r["page_id"]: r for r in url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), RULES).collect()}
    assert len(found) == len(pages) and found[10]["distrust"] > 0 and found[31]["distrust"] > 0 and found[11]["distrust"] == 0
    assert found[20]["verdict"] == "block" and found[11]["verdict"] == "allow" and found[12]["verdict"] == "allow"
    assert abs(sum({r["host"]: r["distrust"] or 0.0 for r in found.values()}.values()) - 1) < 0.5


def test_verdicts_of_unruled_hosts_follow_from_dense_scores(spark):
    rnd = random.Random(5)
    names = [f"h{i}.org" for i in range(14)] + ["bad.net", "worse.net", "fine.com", "x.fine.com"]
    links = {k: [rnd.choice(names) for _ in range(3)] for k in names}
    pages = [(i, f"http://{k}/" + ("fr/a" if k.endswith("net") else ""), "".join(f"<a href='http://{x}/'>" for x in links[k])) for i, k in enumerate(names)]
    found = {r["host"]: r for r in url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), RULES).collect()}
    n, m = len(names), np.zeros((len(names), len(names)))
    for k in names:
        for x in set(links[k]) - {k}:
            m[names.index(k), names.index(x)] += 1
    m[names.index("x.fine.com"), names.index("fine.com")] += url_filter.SITE_WEIGHT
    m[names.index("fine.com"), names.index("x.fine.com")] += url_filter.SITE_WEIGHT
    seeds = np.array([[k.endswith(".com") / 2, k.endswith(".net") / 2] for k in names])
    along, against = m / np.maximum(m.sum(1, keepdims=True), 1e-300), m.T / np.maximum(m.T.sum(1, keepdims=True), 1e-300)
    t, d = seeds.T
    for _ in range(200):
        t, d = 0.15 * seeds[:, 0] + 0.85 * t @ along, 0.15 * seeds[:, 1] + 0.85 * d @ against
    t, d = t / t.sum(), d / d.sum()
    for i, k in enumerate(names):
        assert abs(found[k]["trust"] - t[i]) < 0.01 and abs(found[k]["distrust"] - d[i]) < 0.01
        gap = d[i] - t[i] - url_filter.MARGIN / n
        if k.endswith(".org") and abs(gap) > 0.01:
            assert found[k]["verdict"] == ("block" if gap > 0 else "allow")


def test_url_query(spark, sf_dir):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = queries.op4_url_filter(spark, sf_dir).collect()
    assert {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in found} == {k: judged(u)[:3] for k, u in urls.items()} and len(found) == len(urls)


def bad_labels(spark, sf_dir):
    return {r["doc_id"]: r["quality"] == 0 or r["toxic"] == 1 for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}


def test_held_out_documents_are_told_apart(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = {r["doc_id"]: r["keep"] for r in quality.judge(docs, labels.where("doc_id % 3 <> 0")).collect()}
    bad = {k: b for k, b in bad_labels(spark, sf_dir).items() if k % 3 == 0 and k in found}
    right = [found[k] != b for k, b in bad.items()]
    assert len(found) == docs.count() and np.mean(right) > 0.97
    assert np.mean([found[k] for k, b in bad.items() if not b]) > 0.98 and np.mean([not found[k] for k, b in bad.items() if b]) > 0.93


def test_sparse_sites_shrink_and_bad_sites_count(spark):
    rnd = random.Random(4)
    words = lambda bad: " ".join(rnd.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(30)) + (" rotten" if bad else "")
    rows, labels = [], []
    for k in range(900):
        host = "bad" if k % 3 == 0 else "good"
        bad = rnd.random() < (0.8 if host == "bad" else 0.05)
        rows.append((k, words(bad), host, "a"))
        labels.append((k, 1, int(bad)))
    rows += [(9000, words(True), "tiny", "a"), (9001, None, None, None), (9001, "", "good", None), (None, "alpha", "good", "a")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, source string, lang string, score double")
    found = quality.judge(docs, spark.createDataFrame(labels + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")).collect()
    site = {r["doc_id"]: r["site"] for r in found}
    assert len(found) == len(rows)
    assert site[0] > 0.5 and site[1] < -0.5 and abs(site[9000]) < abs(site[0])


def test_posteriors_are_those_of_the_formula(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id % 7 = 0"))
    found = quality.judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = found.join(docs.select("doc_id", "source", "lang").distinct(), "doc_id").collect()
    assert len(rows) == docs.count()
    bad = {id(r): 1 / (1 + np.exp(-r["evidence"])) for r in rows}
    paths, hosts = {}, {}
    for r in rows:
        for groups, key in ((paths, (r["source"], r["lang"])), (hosts, r["source"])):
            n, total = groups.get(key, (0, 0.0))
            groups[key] = n + 1, total + bad[id(r)]
    rate = sum(bad.values()) / len(rows)

    def strength(cells):
        excess = sum(n * (own - around) ** 2 - around * (1 - around) for n, own, around in cells)
        return min(max(np.mean([a * (1 - a) for *_, a in cells]) / max(excess / sum(n for n, *_ in cells), 1e-6), 1.0), 1e6)

    prior = strength([(n, b / n, rate) for n, b in hosts.values()])
    host_rate = {k: (b + prior * rate) / (n + prior) for k, (n, b) in hosts.items()}
    prior = strength([(n, b / n, host_rate[k[0]]) for k, (n, b) in paths.items()])
    site = {k: (b + prior * host_rate[k[0]]) / (n + prior) for k, (n, b) in paths.items()}
    odds = lambda x: np.log(x / (1 - x))
    for r in rows:
        own = odds(site[r["source"], r["lang"]]) - odds(rate)
        assert abs(r["site"] - own) < 1e-6 and abs(r["score"] - 1 / (1 + np.exp(-(r["evidence"] + own)))) < 1e-6
        assert r["keep"] == (r["score"] <= quality.REJECT_ABOVE)


def test_without_labels_everything_stays(spark):
    docs = spark.createDataFrame([(1, "a", "s", "en"), (2, None, None, None)], "doc_id long, text string, source string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["keep"] for r in quality.judge(docs, none).collect()] == [True, True]
    assert quality.judge(docs.limit(0), none).count() == 0


def test_stages_take_effect_one_after_the_other(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes, current = [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES:
        current = stage(spark, current, sf_dir)
        rows = current.collect()
        if name != "packing":
            assert current.columns == docs.columns
            current = spark.createDataFrame(rows, docs.schema)
        sizes.append(len(rows))
        if name == "quality":
            kept = {r["doc_id"] for r in rows}
            bad = bad_labels(spark, sf_dir)
            assert np.mean([k not in kept for k, b in bad.items() if b]) > 0.8 and np.mean([k in kept for k, b in bad.items() if not b]) > 0.9
        if name == "near_dedup":
            texts = [r["text"] for r in rows if r["text"]]
            assert len(texts) == len(set(texts))
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] <= sizes[4]
    assert queries.pipeline(spark, sf_dir).count() == sizes[4]


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_of_awkward_documents(spark, sf_dir, stage):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (None, "x", "en", "s", 1), (2, "", "en", "s", 0)], spark.read.parquet(f"{sf_dir}/documents.parquet").schema)
    assert stage(spark, docs, sf_dir).count() >= 1
    assert stage(spark, docs.limit(0), sf_dir).count() == 0
