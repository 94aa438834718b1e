"""SimHash links, centroid clusters and importance resampling, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from rows import SF_DIR, edge_frame, empty_frame, with_clashes

from tidemark.llm.centroids import ClusterParams, cluster_vectors, coefficients, hadamard, nearest
from tidemark.llm.common import table
from tidemark.llm.python_queries import op11_simhash
from tidemark.llm.resampling import ResampleParams, quickselect, ranked, resample
from tidemark.llm.simhash import SimHashParams, cell_links, cells, links, simhash_components

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _fingerprint(text, words=4):
    own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(own[i : i + words]) for i in range(max(1, len(own) - words + 1))] if own else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(n, near):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in near(i):
            parent[root(i)] = root(int(j))
    return [root(i) for i in range(n)]


def _simhash_groups(rows, distance=4):
    fps = np.array([_fingerprint(t) for _, t in rows], np.uint64)
    roots = _roots(len(rows), lambda i: np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= distance))
    least = {}
    for (doc, _), r in zip(rows, roots, strict=True):
        least[r] = min((d for d in (doc, least.get(r)) if d is not None), default=None)
    return sorted((repr(doc), f"{int(fp):016x}", repr(least[r])) for (doc, _), fp, r in zip(rows, fps, roots, strict=True))


def _found(frame):
    return sorted((repr(r.doc_id), r.fingerprint, repr(r.component_id)) for r in frame.collect())


def test_simhash_of_edge_rows_equals_brute_force(spark):
    frame = edge_frame(spark)
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    assert _found(simhash_components(with_clashes(frame))) == _simhash_groups(rows)
    named = frame.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    rows = [(r.doc_id, r.text) for r in named.collect()]
    assert _found(simhash_components(named)) == _simhash_groups(rows)
    assert simhash_components(empty_frame(spark)).count() == 0


def test_simhash_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()]
    assert _found(op11_simhash(spark, SF_DIR)) == _simhash_groups(rows)


def test_fingerprints_within_the_distance_share_a_cell(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(300)] + [0, (1 << 64) - 1, 0x5555555555555555]
    pairs = [(b, b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 5)))) for b in base]
    signed = [tuple(v - (1 << 64) if v >> 63 else v for v in p) for p in pairs]
    frame = spark.createDataFrame(signed, "a long, b long").select(cells(F.col("a")).alias("x"), cells(F.col("b")).alias("y"))
    rows = frame.collect()
    assert all(set(r.x) & set(r.y) for r in rows)
    assert all(len(set(r.x)) == len(r.x) <= 66 for r in rows)


def _clusters(a, b, values):
    at = {v: i for i, v in enumerate(values)}
    near = {i: [] for i in range(len(values))}
    for x, y in zip(a, b, strict=True):
        near[at[x]].append(at[y])
    roots = _roots(len(values), lambda i: near[i])
    groups = {}
    for v, r in zip(values, roots, strict=True):
        groups.setdefault(r, set()).add(v)
    return {frozenset(g) for g in groups.values()}


def _ball(rng, n, centre, most):
    return sorted({centre ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, most))) for _ in range(n)})


@pytest.mark.parametrize("block", [2048, 7])
def test_a_crowded_ball_gives_few_links_and_the_right_groups(spark, block):
    rng = random.Random(6)
    values = _ball(rng, 500, rng.getrandbits(63), 5) + _ball(rng, 60, rng.getrandbits(63), 9)
    fps = np.array(values, np.uint64)
    wanted = _roots(len(fps), lambda i: np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= 4))
    groups = {}
    for v, r in zip(fps.view(np.int64).tolist(), wanted, strict=True):
        groups.setdefault(r, set()).add(v)
    frame = spark.createDataFrame([(v,) for v in fps.view(np.int64).tolist()], "fp long")
    found = links(frame, SimHashParams(block=block)).collect()
    assert _clusters([r.a for r in found], [r.b for r in found], fps.view(np.int64).tolist()) == {frozenset(g) for g in groups.values()}
    all_pairs = sum(int((np.bitwise_count(fps[:i] ^ fps[i]) <= 4).sum()) for i in range(len(fps)))
    assert len(found) < all_pairs / (2 if block > len(fps) else 1)


def test_large_cells_give_a_forest():
    fps = np.arange(4000, dtype=np.uint64)  # 12 bits: every number differs from another by one bit
    a, b = cell_links(np.zeros(4000, np.int64), fps, 4)
    assert len(a) == 3999 and len(_clusters(a.tolist(), b.tolist(), fps.tolist())) == 1


def test_simhash_parameters_are_checked():
    with pytest.raises(ValueError):
        SimHashParams(distance=6)


def _plain_clusters(rows, k, rounds, size, scale=256, salt="2"):
    kept = [
        (i, [max(-(1 << 24), min(1 << 24, math.floor(scale * x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not kept:
        return []
    name = lambda i: hashlib.sha256(f"{salt}:{'null' if i is None else i}".encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[0] is not None, r[0] or 0, r[1]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        near = assign()
        for j in range(len(centres)):
            own = [v for (_, v), (_, at) in zip(kept, near, strict=True) if at == j]
            if own:
                centres[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    near = assign()
    per = {}
    for d, j in near:
        per[j] = per.get(j, 0) + d
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return sorted((repr(i), j, d, per[j], sum(per.values()), digest(centres[j])) for (i, _), (d, j) in zip(kept, near, strict=True))


def _vector_rows(size, n, seed=1):
    rng = random.Random(seed)
    # Few different values, so that ties are common.
    rows = [(i, [rng.choice([-0.5, -0.1, 0.0, 0.25, 0.7]) for _ in range(size)]) for i in range(n)]
    rows += [rows[0], rows[0], (3, rows[-1][1]), (None, rows[1][1]), (900, None), (901, []), (902, [0.1] * (size - 1)), (903, [None] * size)]
    return rows + [(904, [float("nan")] + [0.0] * (size - 1)), (905, [float("inf")] + [0.0] * (size - 1)), (906, [3e38] * size)]


@pytest.mark.parametrize("k, rounds, size, n", [(5, 3, 8, 60), (40, 5, 64, 90), (7, 0, 4, 3), (3, 2, 1, 20)])
def test_clusters_equal_brute_force(spark, k, rounds, size, n):
    rows = _vector_rows(size, n)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' as id", "1 as v", "2 as cluster")
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    found = cluster_vectors(frame, ClusterParams(k=k, rounds=rounds, size=size)).collect()
    got = sorted((repr(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in found)
    assert got == _plain_clusters(single, k, rounds, size)


def test_no_vectors_give_no_rows(spark):
    frame = spark.createDataFrame([(1, [0.5])], "vec_id long, embedding array<float>")
    assert cluster_vectors(frame).count() == 0
    assert cluster_vectors(frame.limit(0)).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_the_transform_keeps_distances_and_the_search_is_exact():
    h = hadamard(64)
    assert (h @ h.T == 64 * np.eye(64)).all() and ((h[:, 1:] != h[:, :-1]).sum(axis=1) == np.arange(64)).all()
    rng = np.random.default_rng(3)
    for most in (2, 50, 1 << 24):
        v, c = rng.integers(-most, most + 1, (200, 64)), rng.integers(-most, most + 1, (40, 64))
        c[7] = c[3]  # a tie: the smaller number wins
        v[:5] = c[7]
        plain = ((v[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        cluster, distance = nearest(v, c)
        assert (cluster == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()
        assert (((coefficients(v) - coefficients(c[:1])) ** 2).sum(axis=1) == 64 * plain[:, 0]).all()


def _features(text, longest):
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    runs = [" ".join(own[i : i + n]) for n in range(1, longest + 1) for i in range(len(own) - n + 1)]
    return len(own), runs


def _plain_resample(rows, target, p):
    bucket = lambda f: zlib.crc32(f.encode()) % p.buckets
    s, t = [0] * p.buckets, [0] * p.buckets
    found = [_features(text, p.longest) for _, text in rows]
    for _, fs in found:
        for f in fs:
            s[bucket(f)] += 1
    for text in target:
        for f in _features(text, p.longest)[1]:
            t[bucket(f)] += 1
    top = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + p.buckets) / ((s[b] + 1) * (sum(t) + p.buckets)))) for b in range(p.buckets)]
    out = []
    for (doc, _), (words, fs) in zip(rows, found, strict=True):
        weight = sum(top[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{p.salt}:{'null' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, words])
    may = sorted((r for r in out if r[5] >= p.least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[5]))
    for i, r in enumerate(may[: p.percent * len(may) // 100]):
        r[4] = i + 1
    return sorted(map(repr, (tuple(r[:5]) for r in out)))


def _drawn(frame):
    return sorted(repr((r.doc_id, r.n_features, r.weight, r.score, r.rank)) for r in frame.collect())


@pytest.mark.parametrize("p", [ResampleParams(), ResampleParams(percent=60, least_words=1, buckets=50, longest=3, pivots=1), ResampleParams(percent=0)])
def test_resampling_equals_brute_force(spark, p):
    docs = edge_frame(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rng = random.Random(8)
    rows += [(100 + i, " ".join(rng.choices("alpha beta target words here".split(), k=30))) for i in range(80)] + [(100, "target words " * 15)] * 9
    target = ["Target words here", None, "alpha target", ""]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    assert _drawn(resample(with_clashes(frame), aim, p)) == _plain_resample(rows, target, p)
    assert _drawn(resample(frame, aim.limit(0), p)) == _plain_resample(rows, [], p)


def test_resampling_takes_empty_tables_and_text_ids(spark):
    assert resample(empty_frame(spark), empty_frame(spark)).count() == 0
    docs = spark.createDataFrame([(f"d{i}", "some words " * 12) for i in range(8)], "doc_id string, text string")
    assert sorted(r["rank"] for r in resample(docs, docs).collect() if r["rank"]) == [1, 2]


def test_quickselect_and_ranks_with_a_key_of_a_third_of_all_rows(spark):
    rows = [(i % 97, 1) for i in range(1000)] + [(40, 500)]
    frame = spark.createDataFrame(rows, "k long, copies long").groupBy("k").agg(F.sum("copies").alias("copies")).cache()
    flat = sorted(k for k, n in rows for _ in range(n))
    for rank in (1, 2, 400, 430, 700, 950, 1500):
        place = quickselect(frame, "k", "copies", rank, pivots=3)
        assert place.key == flat[rank - 1] and place.before == flat.index(place.key)
    assert quickselect(frame, "k", "copies", 1501, pivots=3) is None
    begins = {r["k"]: r["rank"] for r in ranked(frame, "k", "copies", "rank").collect()}
    assert begins == {k: flat.index(k) + 1 for k in set(flat)}
