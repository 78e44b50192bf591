"""SimHash, URL reputation, neighbours and the pipeline against brute force."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from fieldcast.llm import neighbours, queries, simhash, url_reputation
from tests.llm.test_near_copies import check as check_near_copies
from tests.llm.conftest import pairs, prose

BIG = "/root/testdata/sf0.01"


def slow_fingerprint(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in low.replace("\t", " ").replace("\n", " ").replace("\r", " ")
             .replace("\v", " ").replace("\f", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for bit in range(64):
            ones[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * ones[bit] > len(shingles))


def classes(fps, radius=4):
    """Position of the first member of each fingerprint's class, by all pairs."""
    up = list(range(len(fps)))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def expected(docs):
    """doc_id, fingerprint, component of each document."""
    fps = [slow_fingerprint(t) for _, t in docs]
    distinct = sorted(set(fps))
    place = dict(zip(distinct, classes(distinct)))
    lowest = defaultdict(lambda: None)
    for (d, _), fp in zip(docs, fps):
        k = place[fp]
        if d is not None and (lowest[k] is None or d < lowest[k]):
            lowest[k] = d
    return sorted(((d, f"{fp:016x}", lowest[place[fp]]) for (d, _), fp in zip(docs, fps)), key=repr)


def test_simhash_query(spark):
    docs = [(d["doc_id"], d["text"]) for d in
            pq.read_table(f"{BIG}/documents.parquet").to_pylist()]
    assert pairs(queries.op8_simhash(spark, BIG), "doc_id", "fingerprint",
                 "component_id") == expected(docs)


def test_simhash_edges(edge_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = simhash.near_duplicates(edge_docs).select(
        "doc_id", simhash.hex_digits(F.col("fp")).alias("fp"), "component_id")
    assert pairs(got, "doc_id", "fp", "component_id") == expected(docs)
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.keep_first(edge_docs)
    assert kept.columns == edge_docs.columns
    want = expected(docs)
    # one row per class; the two texts with id 7 are classes of one name
    assert kept.count() == len(set(classes(sorted({slow_fingerprint(t) for _, t in docs}))))
    assert {r.doc_id for r in kept.collect()} == {c for _, _, c in want}
    assert simhash.keep_first(no_docs).count() == 0


def test_null_ids_only(spark):
    frame = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, "x y z")],
                                  "doc_id long, text string")
    assert pairs(simhash.near_duplicates(frame), "component_id") == [(None,)] * 3
    assert simhash.keep_first(frame).count() == 2


@pytest.mark.parametrize("tile,group_rows", [(4096, 2048), (16, 2048), (16, 1), (7, 20)])
def test_every_link_is_found(spark, tile, group_rows):
    chance = random.Random(11)
    fps = {chance.getrandbits(64) for _ in range(300)}
    for fp in list(fps)[:60]:  # neighbours at exactly 4 and 5 bits, chains and a crowd
        for bits in (4, 5, 4):
            for bit in chance.sample(range(64), bits):
                fp ^= 1 << bit
            fps.add(fp)
    crowd = chance.getrandbits(64)
    fps |= {crowd ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20, 28)}
    fps = sorted(fps)
    want = classes(fps)
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    edges = simhash.links(frame, tile=tile, group_rows=group_rows)
    rows = edges.collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 4 for r in rows)
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    got = [roots.get(signed(f), signed(f)) for f in fps]
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


@pytest.mark.parametrize("task_links", [0, 10, 500_000])
def test_components_of_chains_and_stars(spark, task_links):
    links = [(i, i + 1) for i in range(40)] + [(1000, i) for i in range(1001, 1100)]
    links += [(5, 5), (3000, 3001), (3001, 3000)]
    frame = spark.createDataFrame(links, "a long, b long")
    roots = {r.node: r.root for r in simhash.components(frame, task_links).collect()}
    name = lambda x: roots.get(x, x)
    assert len({name(i) for i in range(41)}) == 1
    assert len({name(i) for i in range(1000, 1100)}) == 1 and name(3000) == name(3001)
    assert len({name(i) for i in (0, 1000, 3000)}) == 3
    assert simhash.components(frame.limit(0)).count() == 0


def test_more_blocks_for_more_fingerprints():
    assert simhash.plan_blocks(1000, 4) == (5, 1)
    sizes = [simhash.plan_blocks(n, 4)[1] for n in (10**6, 10**8, 10**10, 10**11)]
    assert sizes == sorted(sizes) and sizes[-1] > 1


# URLs

def slow_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    at = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:at])
    end = min([rest.index(c, at) for c in "?#" if c in rest[at:]], default=len(rest))
    return host, rest[at:end]


def slow_rule(host, path):
    fits = [(len(rule), rule, verdict) for verdict, rule in url_reputation.RULES
            for name, _, prefix in [rule.partition("/")]
            if (host == name or host.endswith("." + name)) and path.startswith("/" + prefix)]
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no url", "http://", "http://ORG/", "http://www.Example.ORG/es/1", "://x.org",
        "http://example.org/en/1", "http://example.org/en/2?a=/en/1", "http://badexample.org/es/",
        "http://a.com/fr/x#y", "http://a.com/de/", "http://a.com?q=/de/", "ftp://É.com/de/ü",
        "http://a.com/x://b.org/es/", "http://a.com/de", "http://xcom/de/",
        "http://a.net/" + "p" * 50_000]


def test_rules_and_parts(spark):
    rows = [(i, u, 1, "clash", "clash") for i, u in enumerate(URLS)] + [
        (None, "http://a.net/1", None, None, None), (3, "http://a.net/1", 0, "x", "y")]
    frame = spark.createDataFrame(rows, "page_id long, url string, bad int, host string, "
                                        "rule string")
    got = url_reputation.judge(frame).collect()
    assert len(got) == len(rows)
    found = {(r.page_id, r.host, r.path): r for r in got}
    for number, url, *_ in rows:
        host, path = slow_parts(url)
        rule, verdict = slow_rule(host, path)
        r = found[number, host, path]
        assert r.rule == rule and (verdict is None or r.verdict == verdict)
    assert url_reputation.judge(frame.limit(0)).count() == 0


def slow_reputation(counts):
    """counts: host -> (n, bad); the shrinkage chain in plain Python."""
    def weight(groups):
        groups = [g for g in groups if g[0] > 0]
        g, t = len(groups), sum(n for n, _, _ in groups)
        if not g:
            return 10000.0
        msb = sum(n * (b / n - p) ** 2 for n, b, p in groups) / max(g - 1, 1)
        msw = sum(n * (b / n) * (1 - b / n) for n, b, _ in groups) / max(t - g, 1)
        n0 = (t - sum(n * n for n, _, _ in groups) / t) / max(g - 1, 1)
        total = msb + (n0 - 1) * msw
        rho = (msb - msw) / total if total > 0 else 0
        return min(10000.0, max(1.0, 1 / rho - 1)) if rho > 0 else 10000.0

    parts = {h: (".".join(h.split(".")[-2:]), h.split(".")[-1]) for h in counts}
    levels = [defaultdict(lambda: [0, 0]) for _ in range(2)]
    for h, (n, b) in counts.items():
        for at in range(2):
            levels[at][parts[h][at]][0] += n
            levels[at][parts[h][at]][1] += b
    n, b = (sum(v[i] for v in counts.values()) for i in range(2))
    prior = b / n if n else 0.0
    m = weight([(n, b, prior) for n, b in levels[1].values()])
    suffix = {k: (b + m * prior) / (n + m) for k, (n, b) in levels[1].items()}
    of = {d: s for d, s in parts.values()}
    m = weight([(n, b, suffix[of[k]]) for k, (n, b) in levels[0].items()])
    domain = {k: (b + m * suffix[of[k]]) / (n + m) for k, (n, b) in levels[0].items()}
    m = weight([(n, b, domain[parts[h][0]]) for h, (n, b) in counts.items()])
    out = {}
    for h, (n, b) in counts.items():
        mean = (b + m * domain[parts[h][0]]) / (n + m)
        out[h] = mean, max(0.0, mean - url_reputation.Z * (mean * (1 - mean) / (n + m + 1)) ** .5)
    return out


def test_bad_hosts_are_blocked_and_unknown_ones_shrunk(spark):
    rows, number = [], 0
    for host, n, bad in (("bad.spam.net", 60, 57), ("good.fine.net", 80, 2), ("new.spam.net", 0, 0),
                         ("other.spam.net", 30, 27), ("x.fine.net", 50, 3), ("y.info", 40, 4),
                         ("one.fine.net", 1, 1)):
        for i in range(max(n, 2)):
            rows.append((number, f"http://{host}/{i}", (1 if i < bad else 0) if i < n else None))
            number += 1
    frame = spark.createDataFrame(rows, "page_id long, url string, bad int")
    got = {r.host: r for r in url_reputation.judge(frame).collect()}
    counts = defaultdict(lambda: [0, 0])
    for _, url, bad in rows:
        counts[slow_parts(url)[0]][0] += bad is not None
        counts[slow_parts(url)[0]][1] += bad or 0
    want = slow_reputation(counts)
    for host, r in got.items():
        assert r.bad_rate == pytest.approx(want[host][0], abs=2e-6)
        assert r.bad_rate_low == pytest.approx(want[host][1], abs=2e-6)
    assert got["bad.spam.net"].verdict == got["other.spam.net"].verdict == "block"
    assert got["good.fine.net"].verdict == got["one.fine.net"].verdict == "allow"
    assert got["new.spam.net"].bad_rate > got["one.fine.net"].bad_rate
    assert url_reputation.allowed(frame).where("host = 'bad.spam.net'").count() == 0


def test_url_query(spark, sf):
    pages = pq.read_table(f"{sf}/pages.parquet").to_pylist()
    got = {r.page_id: r for r in queries.op9_url_filters(spark, sf).collect()}
    assert len(got) == len(pages)
    for page in pages:
        host, path = slow_parts(page["url"])
        r = got[page["page_id"]]
        rule, verdict = slow_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.bad_rate_low > url_reputation.LIMIT
                                         else "allow"))


# neighbours

def slow_neighbours(rows, k=5):
    fine = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, v in fine:
        if q % 50 == 0:
            scored = sorted((-float((v * w).sum() / np.sqrt((v * v).sum() * (w * w).sum())), i)
                            for i, w in fine if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


@pytest.mark.parametrize("shard_rows", [8192, 300])
def test_recall(spark, shard_rows):
    sf = "/root/testdata/sf0.1"
    frame = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in
            pq.read_table(f"{sf}/embeddings.parquet").to_pylist()]
    got = neighbours.search(frame, frame.where("vec_id % 50 = 0"), shard_rows=shard_rows,
                            block_rows=30).collect()
    want = slow_neighbours(rows)
    exact = {(q, i): s for q, near in want.items() for i, s in near}
    assert len(got) == 5 * len(want)
    hits = [exact[r.query_id, r.vec_id] for r in got if (r.query_id, r.vec_id) in exact]
    assert len(hits) >= 0.9 * len(exact)
    for r in got:
        if (r.query_id, r.vec_id) in exact:
            assert r.score == pytest.approx(exact[r.query_id, r.vec_id], abs=1e-12)


def test_neighbour_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, None),
            (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 0.0]), (8, []), (None, [1.0, 0.0]),
            (9, [3.0, 0.0]), (9, [3.0, 0.0]), (10, [1e200, 1e200]), (11, [1.0, 0.0, 0.0]),
            (50, [0.0, 0.0]), (100, [-1.0, 0.0]), (150, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame([(*r, 1.0, 2, 3) for r in rows],
                                  "vec_id long, embedding array<double>, score double, "
                                  "rank int, size int")
    got = defaultdict(list)
    for r in neighbours.search(frame, frame.where("vec_id % 50 = 0")).orderBy("rank").collect():
        got[r.query_id].append((r.vec_id, round(r.score, 9)))
    want = {q: [(i, round(s, 9)) for i, s in near] for q, near in slow_neighbours(
        [(i, v if v is None or None not in v else None) for i, v in rows if i != 10]).items()}
    assert [i for i, _ in got[0]] == [1, 9, 9, 2, 10] and got[150] == want[150]
    assert set(got) == {0, 100, 150}
    assert neighbours.search(frame.limit(0), frame.limit(0)).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(300)],
                                 "vec_id long, embedding array<double>")
    for r in neighbours.search(same, same.where("vec_id % 50 = 0"), shard_rows=40).collect():
        assert r.vec_id == [i for i in range(300) if i != r.query_id][r.rank - 1]


def test_repeated_queries_and_a_hot_id(spark):
    rows = [(i, [float(i % 7 + 1), float(i % 11), 1.0]) for i in range(1, 60)]
    rows += [(50, rows[49][1])] * 200 + [(100, [1.0, 2.0, 3.0]), (100, [3.0, 2.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in neighbours.search(frame, frame.where("vec_id % 50 = 0"), shard_rows=20,
                               budget=1.0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, round(r.score, 9)))

    def near(own, vector, k=5):
        v = np.array(vector)
        score = sorted((-round(float((v * w).sum() / np.sqrt((v * v).sum() * (w * w).sum())), 9), i)
                       for i, w in ((i, np.array(x)) for i, x in rows) if i != own)
        return [(at + 1, i, -s) for at, (s, i) in enumerate(score[:k])]

    assert got[50] == near(50, rows[49][1])
    assert sorted(got[100]) == sorted(near(100, [1.0, 2.0, 3.0]) + near(100, [3.0, 2.0, 1.0]))
    assert set(got) == {50, 100}


# pipeline

def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    marks = {r["doc_id"]: r for r in pq.read_table(f"{BIG}/labels.parquet").to_pylist()}
    (_, toxic), (_, rules), (_, copies), (_, pack) = corpus_pipeline.STAGES
    calm = toxic(spark, docs, BIG)
    assert calm.columns == docs.columns
    kept = {r.doc_id for r in calm.collect()}
    clean = [d for d, m in marks.items() if not m["toxic"]]
    assert sum(d in kept for d in clean) >= 0.97 * len(clean)
    good = rules(spark, calm, BIG)
    assert good.columns == docs.columns
    judged = {r.doc_id for r in queries.quality_rules.judge(calm).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == judged
    single = copies(spark, good, BIG)
    assert single.columns == docs.columns
    stay = [r.doc_id for r in single.collect()]
    check_near_copies([(r.doc_id, r.text) for r in good.collect()], stay)
    want = set(stay)
    pieces = pack(spark, single, BIG).collect()
    assert {r.doc_id for r in pieces} == want
    for r in pieces:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    whole = corpus_pipeline.run(spark, BIG)
    assert whole.agg(F.sum("length")).first()[0] == sum(r.length for r in pieces)
    assert {r.doc_id for r in whole.select("doc_id").distinct().collect()} == want


def test_pipeline_stages_on_odd_documents(spark, edge_docs, no_docs):
    for frame in (edge_docs, no_docs):
        docs = frame.select("doc_id", "text", "lang", "source", "n_chars")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, BIG)
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            docs.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, BIG).count()
    assert prose(1, 3)
