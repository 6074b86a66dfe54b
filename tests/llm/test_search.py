"""Vector search and url judgements against plain versions."""

from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from chainstrata.llm import QUERIES, SQL, ann, topk, url_trust


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)], "q", 1) for i in range(160)]
    same = [(200 + i, rows[0][1], None, None) for i in range(60)]
    odd = [(300, None, "", 0), (400, [1.0, None] + [0.0] * 6, "", 0), (500, [float("nan")] * 8, "", 0), (600, [float("inf")] * 8, "", 0),
           (700, [0.0] * 8, "", 0), (None, rows[1][1], "", 0), (800, [1.0, 2.0], "", 0), (900, [2.0, 1.0], "", 0), (1000, [], "", 0), rows[20], rows[20]]
    return spark.createDataFrame([*rows, *same, *odd], "vec_id bigint, embedding array<float>, rank string, score int").repartition(3)


def _plain(vectors, step, measure, k, zero):
    given = [(r.vec_id, [float(x) for x in r.embedding]) for r in vectors.collect()
             if r.vec_id is not None and r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding)
             and (zero or any(r.embedding))]
    out = []
    for q, a in given:
        if q % step == 0:
            found = [(-measure(a, b), v) for v, b in given if v != q and len(a) == len(b)]
            out.append((q, sorted(found)))
    want = {}
    for q, found in out:
        want.setdefault(q, []).extend(found)
    return {q: sorted(found)[:k] for q, found in want.items()}


def test_top_k_is_exact(vectors):
    def measure(a, b):
        return sum(int(np.floor(256 * x)) * int(np.floor(256 * y)) for x, y in zip(a, b))
    want = _plain(vectors, 50, measure, 5, True)
    got = {}
    for r in sorted(topk.top_k(vectors, F.col("vec_id") % 50 == 0).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert got == {q: f for q, f in want.items() if f}
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_whole_scores_beyond_doubles():
    a, b = np.array([[3.0e9, 1.0]]), np.array([[3.0e9, 7.0], [1e300, 1.0]])
    assert topk.scores(a, b).tolist() == [[9 * 10**18 + 7, 2**63 - 1]]


def test_one_bit_codes_find_the_nearest(vectors):
    want = _plain(vectors, 20, lambda a, b: float(np.dot(a, b)), 20, False)
    got = {}
    for r in sorted(ann.nearest(vectors, F.col("vec_id") % 20 == 0).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert set(got) == {q for q, f in want.items() if f}
    hits = [sum(abs(g[0] - w[0]) < 1e-9 for g, w in zip(got[q], want[q])) / len(want[q]) for q in got]
    assert np.mean(hits) >= 0.9 and all(len(got[q]) == len(want[q]) for q in got)
    assert ann.nearest(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_hold_for_most_estimates():
    rng = np.random.default_rng(1)
    rows, queries, turn = rng.normal(size=(2000, 64)), rng.normal(size=(20, 64)), ann.rotation(64)
    near, wide = ann.estimates(queries, *ann.encode(rows, turn), turn)
    assert np.mean(np.abs(near - queries @ rows.T) <= wide) > 0.98


def test_repeated_queries_and_huge_components(spark):
    schema = "vec_id bigint, embedding array<double>"
    rows = [(0, [2.0, 1.0]), (0, [2.0, 1.0]), (1, [3.0, 1.0]), (2, [1e200, 1.0]), (3, [-1e300, 2.0]), (4, [1e-200, 0.0]), (100, [1e200, 1e200]), (5, [1.7e308, 0.0])]
    frame = spark.createDataFrame(rows, schema).repartition(2)
    found = ann.nearest(frame, F.col("vec_id") % 20 == 0, k=4)
    got = {q: [r.vec_id for r in sorted(found.collect(), key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 100)}
    assert got[0] == [5, 100, 2, 1] and got[100] == [2, 5, 1, 0]  # infinite products tie
    every = ann.nearest(frame, F.col("vec_id") == 100, k=10).collect()
    assert sorted(r.vec_id for r in every) == [0, 0, 1, 2, 3, 4, 5]
    best = topk.top_k(frame, F.col("vec_id") % 50 == 0, k=3)
    got = {q: [r.vec_id for r in sorted(best.collect(), key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 100)}
    assert got == {0: [2, 5, 100], 100: [0, 0, 1]}


def test_recall_on_clustered_vectors_over_several_blocks(spark, monkeypatch):
    """64 dimensions, 6,000 rows around 40 centres, in blocks of 512: at least 0.9 of the true neighbours."""
    monkeypatch.setattr(ann, "ROW_BLOCK", 512)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 64))
    rows = (centres[rng.integers(0, 40, 6000)] + 0.4 * rng.normal(size=(6000, 64))).astype(np.float32)
    frame = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rows)], "vec_id bigint, embedding array<float>").repartition(3)
    found = {}
    for r in ann.nearest(frame, F.col("vec_id") % 200 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    wide = rows.astype(float)
    recalls = []
    for q in range(0, 6000, 200):
        score = wide @ wide[q]
        score[q] = -np.inf
        recalls.append(len(found[q] & set(np.argsort(-score)[:20].tolist())) / 20)
    assert np.mean(recalls) >= 0.9


PAGES = [
    (1, "https://Good.ORG/x?q#f", '<a href="http://Middle.net/">m</a> <a href="/own">o</a>'),
    (2, "http://middle.net/a", "<a href='//far.net/z'>f</a><a href=http://bad.com/de/>b</a>"),
    (3, "http://far.net", None), (4, "http://bad.com/de/9", ""), (5, "http://pusher.net/", '<a href="https://bad.com/x">1</a>'),
    (6, "http://bad.com/xx", ""), (7, "http://www.example.org/en/12", ""), (8, "http://example.org/es/", ""), (9, "http://notexample.org/es/1", ""),
    (10, None, "<a href='http://bad.com'>"), (11, "no scheme", None), (12, "", ""), (13, "x://", ""), (14, "http://a.com/fr/1", ""),
    (14, "http://a.com/fr/1", ""), (None, "http://lone.net\n/p?x", ""), (15, "http://org/", ""), (16, "http://x.org", ""),
]


def test_urls_follow_rules_and_links(spark):
    pages = spark.createDataFrame([(*p, "clash", 1) for p in PAGES], "page_id bigint, url string, html string, host string, trust int")
    got = url_trust.judge(pages).collect()
    assert len(got) == len(PAGES)
    by = {r.page_id: r for r in got}
    assert (by[1].host, by[1].path, by[1].rule, by[1].verdict) == ("good.org", "/x", "org/", "allow")
    assert [by[i].rule for i in (4, 7, 8, 9, 14, 15, 16)] == [
        "com/de/", "example.org/en/1", "example.org/es/", "org/", "com/fr/", "org/", None]
    assert [by[i].verdict for i in (4, 7, 8, 9, 14)] == ["block", "block", "block", "allow", "allow"]
    assert (by[3].verdict, by[3].trust > 0) == ("allow", True)     # two steps from a trusted host
    assert (by[5].rule, by[5].verdict) == (None, "block")          # links to a blocked host only
    assert by[6].verdict == "block" and (by[None].host, by[None].path) == ("lone.net\n", "/p")
    assert all((by[i].host, by[i].path, by[i].verdict) == ("", "", "allow") for i in (10, 11, 12, 13))
    assert url_trust.judge(pages.limit(0)).count() == 0


def test_propagation_matches_a_plain_loop(spark):
    edges = [("a", "b", 0.5), ("a", "c", 0.5), ("b", "c", 1.0), ("c", "a", 1.0)]
    got = {r.host: r.score for r in url_trust.propagate(
        spark.createDataFrame([("a", 1.0)], "host string, seed double"),
        spark.createDataFrame(edges, "source string, target string, weight double")).collect()}
    score = {"a": 0.15, "b": 0.0, "c": 0.0}
    for _ in range(200):
        score = {h: 0.15 * (h == "a") + 0.85 * sum(w * score[s] for s, t, w in edges if t == h) for h in score}
    assert got == pytest.approx(score, abs=1e-6)


def test_tiny_and_late_distrust_still_blocks(spark):
    # 3,000 hosts link to c0, from which 26 links lead to one of 2,000 blocked hosts: distrust comes late and is tiny.
    blocked = [(i, f"https://s{i}.com/de/", "") for i in range(2000)]
    chain = [(3000 + i, f"https://c{i}.net/", f'<a href="https://c{i + 1}.net/">x</a>') for i in range(25)]
    last = [(4000, "https://c25.net/", '<a href="https://s0.com/">x</a>')]
    crowd = [(5000 + i, f"https://m{i}.net/", '<a href="https://c0.net/">x</a>') for i in range(3000)]
    by = {r.page_id: r for r in url_trust.judge(spark.createDataFrame([*blocked, *chain, *last, *crowd], "page_id bigint, url string, html string")).collect()}
    assert 0 < by[5000].distrust < 5e-9 and {by[i].verdict for i in (3000, 4000, 5000, 5001)} == {"block"}


def test_sql_twin_agrees_where_links_carry_scores(spark, tmp_path):
    """Rules, chains and branches, with scores that decide verdicts."""
    branches = [(100 + i, f"https://r{i}.net/", f'<a href="https://r{i + 1}.net/">x</a><a href="//p{i}.com/">y</a>') for i in range(7)]
    into = [(200 + i, f"https://p{i}.com/{'de/' if i % 3 else 'fr/'}", f'<a href="https://c{i}.net/">x</a>') for i in range(7)]
    chain = [(300 + i, f"https://c{i}.net/", f'<a href="https://c{i + 1}.net/">x</a>') for i in range(12)]
    last = [(400, "https://c12.net/", '<a href="https://end.com/">x</a>'), (401, "https://end.com/de/", "")]
    rows = [p for p in PAGES if p[0] is not None] + branches + into + chain + last
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = Counter(map(tuple, QUERIES["op1_url_trust"](spark, str(tmp_path)).collect()))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == Counter(connection.execute(SQL["op1_url_trust"]).fetchall())
    assert {"block", "allow"} == {verdict for _, _, _, rule, verdict, _, _ in got if rule is None}
    assert sum(trust > 0 and distrust > 0 for *_, trust, distrust in got) > 5
