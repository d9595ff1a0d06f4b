"""Ranked lexical search, URL filters and centroid clustering against plain versions."""

import hashlib
import math
import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from conftest import SF_DIR  # noqa: E402

import __spark_entry__  # noqa: E402, F401
from fleet_engine.llm import clusters, lexical, url_filter  # noqa: E402
from fleet_engine.workspace import stage  # noqa: E402

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 100 - 75 + (75 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, rank, None if unnamed else i, -s) for rank, (s, unnamed, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def awkward_docs():
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 4))) for _ in range(60)] + ["Straße", "éé", "日本語", "x1"]
    docs = [(i, rnd.choice([" ", "-", ", ", "\n"]).join(rnd.choice(words) for _ in range(rnd.randint(1, 60)))) for i in range(150)]
    docs += [(1000 + i, docs[3][1]) for i in range(40)]                                  # copies: ties by id
    docs += [(900, None), (901, ""), (902, " .,!\t"), (903, "É é É"), (904, "A-B_c`d{e"), (None, docs[3][1]), (None, docs[4][1]), (5, docs[5][1]), (5, docs[6][1])]
    docs += [(905, " ".join(rnd.choice(words) for _ in range(40_000))), (906, "q" * 50_000), (907, "rep " * 400)]
    items = [(i, " ".join(rnd.choice(words + ["nowhere"]) for _ in range(rnd.randint(1, 12)))) for i in range(25)]
    items += [(90, None), (91, ""), (92, "?!"), (93, docs[3][1]), (94, "REP rep Rep"), (95, "q" * 50_000), (7, items[7][1]), (7, items[8][1])]
    return docs, items


@pytest.fixture(scope="module")
def searchable(spark):
    docs, items = awkward_docs()
    table = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id bigint, text string, terms string, _text string").repartition(4)
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id bigint, text string, doc_id int, rank int")
    return docs, items, table, asked


def found(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=repr)


def test_search_equals_plain(searchable):
    docs, items, table, asked = searchable
    assert found(lexical.lexical_search(table, asked)) == plain_search(docs, items)


def test_search_in_blocks_of_queries(searchable):
    docs, items, table, asked = searchable
    index = stage(lexical.build_index(table), "index")
    assert found(lexical.ranked_search(index, asked, 3, query_bytes=3000)) == plain_search(docs, items, 3)


@pytest.mark.parametrize("width", [1, 64])
def test_search_with_any_sketch_width(searchable, monkeypatch, width):
    """Bounds may be loose, results are the same; small slices meet several tasks' floors."""
    docs, items, table, asked = searchable
    monkeypatch.setattr(lexical, "CELLS", 2000)
    index = stage(lexical.build_index(table, width=width), "index")
    assert found(lexical.ranked_search(index, asked)) == plain_search(docs, items)


def test_bounds_hold_and_spare_exact_scores(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    index = stage(lexical.build_index(docs), "index")
    work = lexical.ranked_search(index, spark.read.parquet(f"{SF_DIR}/benchmark.parquet"), with_work=True).select("looked", "scored").first()
    assert 0 < work["scored"] < work["looked"]
    batch = lexical._Batch.of(["the of and tion", "ha ea"])
    weights = np.array([5 + i for i in range(len(batch.terms))])
    for rows in index.toArrow().to_batches():
        part = lexical._Slice(rows.select(["doc_id", "n_terms", "terms", "counts", "sketch"]), 200, 100_000)
        bound = part.bounds(batch, batch.matrix(weights))
        doc, query = np.nonzero(np.ones_like(bound))
        assert (bound[doc, query] >= part.exact(doc, query, batch, weights)).all()


def test_search_on_empty_tables(spark, searchable):
    _, _, table, asked = searchable
    for docs, items in ((table.limit(0), asked), (table, asked.limit(0)), (table.filter("text IS NULL"), asked), (table, asked.filter("item_id IN (90, 92)"))):
        out = lexical.lexical_search(docs, items)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


# ---- URL filters

def plain_rule(host, path):
    best = None
    for kind, rule in url_filter.RULES:
        own, start = rule[:rule.index("/")], rule[rule.index("/"):]
        if (host == own or host.endswith("." + own)) and path.startswith(start) and (best is None or len(rule) > len(best[1])):
            best = (kind, rule)
    return best


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest, re.S).group()
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host):], re.S).group()


class PlainModel:
    """Counts of whole grams, without hashing."""

    def __init__(self, urls):
        self.grams, self.symbols = Counter(), 0
        for u in urls:
            s = bytes([2]) + (u or "").encode() + bytes([3])
            self.symbols += len(s) - 1
            for k in range(1, url_filter.ORDER + 1):
                self.grams.update(s[i:i + k] for i in range(len(s) - k + 1))

    def log_likelihood(self, url, prior):
        s, total = bytes([2]) + (url or "").encode() + bytes([3]), 0.0
        for i in range(1, len(s)):
            p = 1 / 256
            for k in range(1, min(i + 1, url_filter.ORDER) + 1):
                seen = self.symbols if k == 1 else self.grams[s[i - k + 1:i]]
                p = (min(self.grams[s[i - k + 1:i + 1]], seen) + prior * p) / (seen + prior)
            total += math.log(p)
        return total / (len(s) - 1)


def plain_filter(urls):
    import zlib
    parts = [plain_parts(u) for u in urls]
    rules = [plain_rule(*p) for p in parts]
    sides = {(kind, held): [u for u, (h, _), r in zip(urls, parts, rules) if r and r[0] == kind and (zlib.crc32(h.encode()) % 5 == 0) == held]
             for kind in ("allow", "block") for held in (False, True)}
    limit, prior = 0.0, 8.0
    if all(sides.values()):
        a, b = PlainModel(sides["allow", False]), PlainModel(sides["block", False])
        prior = max(url_filter.PRIORS, key=lambda p: sum(m.log_likelihood(u, p) for m, kind in ((a, "allow"), (b, "block")) for u in sides[kind, True]))
        scored = [(math.floor((a.log_likelihood(u, prior) - b.log_likelihood(u, prior)) * 64), kind) for kind in ("allow", "block") for u in sides[kind, True]]
        count = Counter(kind for _, kind in scored)
        edges = range(min(scored)[0], max(scored)[0] + 2)
        cost = lambda e: round(sum(k == "allow" and x < e for x, k in scored) / count["allow"] + sum(k == "block" and x >= e for x, k in scored) / count["block"], 12)
        limit = min(edges, key=lambda e: (cost(e), abs(e), e)) / 64
    a, b = (PlainModel(sides[kind, False] + sides[kind, True]) for kind in ("allow", "block"))
    out = []
    for u, (host, path), rule in zip(urls, parts, rules):
        score = a.log_likelihood(u, prior) - b.log_likelihood(u, prior)
        out.append((host, path, rule and rule[1], rule[0] if rule else "allow" if score >= limit else "block", round(score, 9), limit))
    return out


def test_urls_equal_plain(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BITS", 23)           # so many buckets that hardly any grams of this test share one
    rnd = random.Random(8)
    urls = [r.url for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()]
    urls += ["http://EXAMPLE.org/es/A?x=/en/1", "https://a.Example.ORG/en/1x", "http://badexample.org/es/", "ftp://x.com", "http://x.com/de", "http://x.com/de/?q#f", "x.com/fr/", "",
             None, "://", "http://org/", "http://.org/a", "a://b://c.com/fr/", "http://ü.com/fr/é", "http://x.org", "http://x.org?/", "http://x.com/\n/fr/", "http://x.net/" + "a/" * 30_000]
    urls += [rnd.choice(urls[:50]) for _ in range(20)]
    df = spark.createDataFrame([(i if i % 9 else None, u, "h", "v", i) for i, u in enumerate(urls)], "page_id bigint, url string, host string, verdict string, n int").repartition(3)
    rows = url_filter.url_filter(df).collect()
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, round(r.score, 9), r.threshold) for r in rows), key=repr)
    want = sorted(((i if i % 9 else None, *w) for i, w in enumerate(plain_filter(urls))), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want] and got[0][6] == want[0][6]
    assert sum(abs(g[5] - w[5]) < 1e-6 for g, w in zip(got, want)) >= 0.95 * len(want)


def test_counts_grow_with_the_input(spark):
    urls = spark.createDataFrame([(f"http://a{i}.org/x", i % 2) for i in range(40)], "url string, side int")
    once, twice = (df.repartition(3).transform(url_filter.count_grams).agg({"n": "sum"}).first()[0] for df in (urls, urls.unionAll(urls)))
    assert twice == 2 * once


def test_learnt_verdicts_follow_the_rules(spark):
    """Unseen hosts without a rule, with paths like accepted or rejected ones."""
    rnd = random.Random(2)
    name = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    rows = [f"http://{name()}.com/{kind}/{name()}" for kind in ("fr", "de") for _ in range(150)]
    asked = [(f"http://{name()}.net/{kind}/{name()}", verdict) for kind, verdict in (("fr", "allow"), ("de", "block")) for _ in range(40)]
    out = {r.url: r.verdict for r in url_filter.url_filter(spark.createDataFrame([(u, u) for u in rows + [u for u, _ in asked]], "url string, page string"), id_col="url").collect()}
    assert sum(out[u] == v for u, v in asked) >= 76


def test_urls_without_two_classes(spark):
    df = spark.createDataFrame([(1, "http://a.org/x"), (2, "http://a.net/x"), (3, None)], "page_id bigint, url string")
    assert sorted((r.page_id, r.rule, r.verdict, r.score, r.threshold) for r in url_filter.url_filter(df).collect()) == [
        (1, "org/", "allow", None, None), (2, None, "allow", None, None), (3, None, "allow", None, None)]
    assert url_filter.url_filter(df.limit(0)).count() == 0


# ---- clusters

def plain_clusters(rows, dims, k, rounds, scale=256):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    centroids = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [min((distance(v, c), n) for n, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        groups = [[v for (_, v), (_, n) in zip(kept, found) if n == c] for found in [assign()] for c in range(len(centroids))]
        centroids = [[sum(x) // len(g) for x in zip(*g)] if g else old for g, old in zip(groups, centroids)]
    return sorted(((i, n, d) for (i, _), (d, n) in zip(kept, assign())), key=repr), centroids


@pytest.mark.parametrize("k, rounds, spreadness", [(7, 5, 0.2), (3, 2, 5.0), (60, 6, 0.05), (1, 2, 1.0), (500, 3, 0.3)])
def test_clusters_equal_plain(spark, k, rounds, spreadness):
    rnd = random.Random(k)
    mids = [[rnd.gauss(0, 1) for _ in range(4)] for _ in range(6)]
    rows = [(i, [m + rnd.gauss(0, spreadness) for m in rnd.choice(mids)]) for i in range(250)]
    rows += [(i, rows[0][1]) for i in range(300, 380)]                        # a third are copies
    rows += [(400, None), (401, []), (402, [1.0, 2.0, 3.0]), (403, [1.0, None, 2.0, 3.0]), (404, [float("nan"), 0.0, 0.0, 0.0]), (405, [float("inf"), 0.0, 0.0, 0.0]),
             (None, [0.5, 0.5, 0.5, 0.5]), (None, None), (5, rows[9][1]), (5, rows[5][1]), (406, [0.0, -0.0, 1e-300, -1e-300]), (407, [9000.5, -9000.5, 0.0, 1.0])]
    df = spark.createDataFrame([(i, v, "c", 1.0, "o") for i, v in rows], "vec_id bigint, embedding array<double>, cluster string, key double, _id string").repartition(3)
    out = clusters.cluster_vectors(df, dims=4, k=k, rounds=rounds, count_scans=True)
    want, centroids = plain_clusters(rows, 4, k, rounds)
    assert out.centroids == centroids
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in out.rows.collect()), key=repr) == want
    assert out.scanned[0] == len(want) and len(out.scanned) == rounds + 1
    inertia = clusters.with_inertia(out).collect()
    assert all(r.inertia == sum(w[2] for w in want) and r.cluster_inertia == sum(w[2] for w in want if w[1] == r.cluster)
               and r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest() for r in inertia)


def test_separate_clusters_are_hardly_scanned_again(spark):
    rnd = random.Random(1)
    rows = [(i, [100.0 * (i % 5) + rnd.random(), rnd.random()]) for i in range(400)]
    out = clusters.cluster_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), dims=2, k=5, rounds=5, count_scans=True)
    assert out.scanned[0] == 400 and out.scanned[-1] < 200


def test_popped_rows_are_a_predicate_of_the_scan(spark):
    segment = clusters._Segment(stage(spark.range(100).selectExpr("id AS _id", "array(1) AS v", "int(id % 3) AS cluster", "double(id) AS key", "int(null) AS old"), "heap"), "")
    popped = clusters._popped(segment, np.zeros(3), np.array([10.0, 20.0, 30.0]))
    plan = popped._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "EqualTo(cluster,0)" in pushed and "LessThanOrEqual(key,10.001)" in pushed
    assert sorted(r["_id"] for r in popped.collect()) == sorted(i for i in range(1, 100) if i <= (10, 20, 30)[i % 3])


def test_clusters_of_huge_components_and_empty_tables(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [0.0, 0.0])], "vec_id bigint, embedding array<double>")
    out = clusters.cluster_vectors(df, dims=2, k=2, rounds=1)
    assert out.rows.count() == 3 and max(abs(x) for c in out.centroids for x in c) <= 1 << 27
    empty = clusters.with_inertia(clusters.cluster_vectors(df, dims=3))
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
