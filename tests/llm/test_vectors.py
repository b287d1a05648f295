"""Linking and whitening of vectors, and periodic runs, against plain versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from storeledger.llm import periodic_runs, projection_neighbours, suffix_tree, vectors, whitening

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, label int, node long, key string, size int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "k", 3) for i, v in rows], SCHEMA)


def plain_links(rows, least=0.9):
    """All pairs, by sums rounded once."""
    good = [i is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) for i, v in rows]
    rows = [(i, [x / max(map(abs, v)) for x in v] if g else v) for g, (i, v) in zip(good, rows, strict=True)]
    norm = [math.sqrt(math.fsum(x * x for x in v)) if g else 0.0 for g, (_, v) in zip(good, rows, strict=True)]
    near = {k: set() for k in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            if good[a] and good[b] and len(rows[a][1]) == len(rows[b][1]):
                if math.fsum(x * y for x, y in zip(rows[a][1], rows[b][1], strict=True)) / (norm[a] * norm[b]) >= least - 1e-15:
                    near[a].add(b), near[b].add(a)
    out = []
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other), todo.append(other)
        component = min(rows[x][0] for x in seen) if good[k] else i
        out.append((i, len(near[k]), component, i == component))
    return sorted(out, key=str)


def around(rng, n, size, width):
    centre = rng.standard_normal(size)
    return (centre / np.linalg.norm(centre) + width * rng.standard_normal((n, size))).tolist()


@pytest.fixture(scope="module")
def crowd():
    rng = np.random.default_rng(3)
    lists = rng.standard_normal((150, 16)).tolist() + around(rng, 60, 16, 0.02) + around(rng, 60, 16, 0.09) + around(rng, 20, 5, 0.1)
    odd = [None, [], [0.0] * 16, [NAN] + [1.0] * 15, [1.0, None], [INF, 1.0], [-0.0, 3.0, 0.0], [0.0, 4.0, 0.0], [1e300, 1e300], [1e-300, 1e-300], [1.0], [-1.0]]
    rows = list(enumerate(lists + odd)) + [(700 + k, lists[200]) for k in range(40)] + [(5, lists[5]), (6, lists[220]), (None, lists[0])]
    return rows + [(900, [9.0, math.sqrt(19.0)]), (901, [10.0, 0.0])]  # at 0.9


@pytest.mark.parametrize("sizes", [{}, {"window": 32, "block": 7}])
def test_similar_vectors(spark, crowd, sizes):
    found = projection_neighbours.similar_vectors(table(spark, crowd).repartition(3), **sizes)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_links(crowd)


def test_similar_vectors_of_nothing(spark):
    assert projection_neighbours.similar_vectors(table(spark, []).limit(0)).isEmpty()
    alone = projection_neighbours.similar_vectors(table(spark, [(4, None), (None, [1.0])])).collect()
    assert {tuple(r) for r in alone} == {(4, 0, 4, True), (None, 0, None, True)}


def test_recall_at_the_threshold(spark):
    """Separate pairs of a cosine just above the threshold, which nothing else connects."""
    rng = np.random.default_rng(4)
    x, y = (projection_neighbours.unit(rng.standard_normal((4000, 64))) for _ in range(2))
    y = projection_neighbours.unit(y - (x * y).sum(axis=1, keepdims=True) * x)
    cosine = rng.uniform(0.9001, 0.92, (4000, 1))
    z = cosine * x + np.sqrt(1 - cosine**2) * y
    df = table(spark, list(enumerate(np.concatenate([x, z]).tolist()))).repartition(8)
    found = projection_neighbours.similar_vectors(df, window=64).where("n_links > 0").count()
    assert found / 8000 > 0.95


def test_planes():
    """Two words, three planes: popcounts are products."""
    u = np.random.default_rng(5).integers(0, 8, (100, 3)).astype(np.uint64)
    packed = whitening.planes(u, [3, 3, 3])
    assert packed.shape == (9, 2)
    cross = sum(int(np.bitwise_count(packed[a] & packed[3 + b]).sum()) << (a + b) for a in range(3) for b in range(3))
    assert cross == int((u[:, 0] * u[:, 1]).sum())


def test_whitening(spark):
    rng = np.random.default_rng(6)
    mixed = (rng.standard_normal((300, 40)) @ rng.standard_normal((40, 40)) * 0.1).tolist()
    rows = list(enumerate(mixed)) + [(None, mixed[0]), (7, mixed[7]), (8, mixed[9])]
    odd = [(1000, None), (1001, [NAN] * 40), (1002, [None] * 40), (1003, [INF] * 40), (1004, [1.0]), (1005, [])]
    out = whitening.whitened(table(spark, rows + odd).repartition(4)).collect()
    x = np.floor(64 * np.array([v for _, v in rows])).astype(int) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    e, basis = np.linalg.eigh(np.cov(x.T.astype(float), bias=True))
    e, basis = e[::-1][:32], basis[:, ::-1][:, :32]
    deviation = ((n * x.astype(object) - s) ** 2).sum(axis=1)
    expected = sorted((str(i), c + 1, n, int(d)) for (i, _), d in zip(rows, deviation, strict=True) for c in range(32))
    assert sorted((str(r.vec_id), r.component, r.n, r.deviation) for r in out) == expected
    turned = np.abs((x - s / n) @ basis / np.sqrt(e))
    for r in out:
        if r.vec_id is not None and r.vec_id not in (7, 8):
            assert abs(r.whitened) == pytest.approx(turned[r.vec_id, r.component - 1], abs=1e-7)
        assert r.explained == pytest.approx(e[r.component - 1] / np.trace(np.cov(x.T.astype(float), bias=True)), rel=1e-9)
        assert 0 <= r.identity_error < 1e-9
    signs = {(r.component, r.whitened > 0) for r in out if r.vec_id == 7 or r.vec_id == 8}
    assert signs  # repeated ids keep their own rows


def test_whitening_of_little(spark):
    def of(*lists):
        return whitening.whitened(table(spark, list(enumerate(lists))))

    assert whitening.whitened(table(spark, []).limit(0)).isEmpty()
    assert of([1.0, 2.0]).isEmpty()  # no variance
    assert of(None, [NAN]).isEmpty()
    assert of([1.0], [1.0]).isEmpty()
    flat = of([1.0, 1.0], [2.0, 2.0], [4.0, 4.0]).collect()  # one direction only
    assert {r.component for r in flat} == {1} and {round(r.explained, 9) for r in flat} == {1.0}
    huge = of([1e30, 1.0], [0.0, 2.0], [1.0, 5.0]).collect()  # beyond 64-bit integers
    assert len(huge) >= 3 and {r.deviation for r in huge if r.vec_id == 0} == {None}


def test_finite_vectors_take_the_longest_of_equals(spark):
    kept = vectors.finite_vectors(table(spark, [(1, [1.0]), (2, [1.0, 2.0])])).collect()
    assert [r.vec_id for r in kept] == [2]


def plain_runs(words, exponent=4, least=6):
    out = set()
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, exponent * q) and all(any(words[k] != words[k + r] for k in range(i, i + size - r)) for r in range(1, q)):
                out.add((i, size, q))
            i = max(i + 1, j)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_suffix_trees():
    pick = random.Random(8)
    for _ in range(300):
        n, k = pick.randint(1, 40), pick.choice([1, 2, 3, 5])
        s = [pick.randint(1, k) for _ in range(n)]
        if pick.random() < 0.6:
            a = pick.randrange(n)
            p = 1 + (n - a) // pick.randint(3, 10)
            s = [s[i if i < a else a + (i - a) % p] for i in range(n)]
        tree = suffix_tree.SuffixTree(s)
        assert tree.suffixes.tolist() == sorted(range(n + 1), key=lambda i: s[i:])
        turned = sorted(range(n + 1), key=lambda i: [-x for x in s[i:]])
        assert tree.reverse_rank()[turned].tolist() == list(range(n + 1))
        i, j = np.array([(i, j) for i in range(n + 1) for j in range(i)]).T
        common = [next((x for x in range(n) if i + x >= n or j + x >= n or s[i + x] != s[j + x]), n) for i, j in zip(i.tolist(), j.tolist(), strict=True)]
        assert tree.lcp(i, j).tolist() == common
        lyndon = [max(m for m in range(1, n - i + 1) if all(s[i : i + m] < s[i + x : i + m] for x in range(1, m))) for i in range(n)]
        assert suffix_tree.longest_lyndon(tree.rank).tolist() == lyndon
        for exponent, least in ((4, 6), (2, 2), (3, 4)):
            assert [tuple(r) for r in suffix_tree.runs(s, exponent, least).tolist()] == plain_runs(s, exponent, least)


TEXTS = [
    None, "", " \t", "a", "a a a a a", "a a a a a a", "x a b a b a b a b y", "a b c a b c a b c a b c a b", "\ta  a\na a\x0ba a\x0c b", "a\x1ca a\x1ca a\x1ca a\x1ca a\x1ca a\x1ca",
    "é é é é é é 日 日 日 日 日 日 日", "a a a b a a a b a a a b a a a b", "a\xa0a " * 9, "one two " * 5 + "three " + "one two " * 4 + "6 " * 6 + "7 " * 6,
]


def expected(doc_id, text, rewrite):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if rewrite and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {k for s, size, q in runs for k in range(s + q, s + size)}
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    best = sorted(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))[:1]
    told = (*best[0], 1000 * best[0][1] // best[0][2]) if best else (None,) * 4
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *told, sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(kept))


@pytest.mark.parametrize("rewrite", [False, True])
def test_periodic_runs(spark, rewrite):
    pick = random.Random(9)
    long = [" ".join(pick.choice(["of", "the", "a", "sea", "b" * 40]) for _ in range(pick.randint(1, 200))) for _ in range(60)]
    rows = list(enumerate(TEXTS + long)) + [(None, TEXTS[6]), (3, "a " * 20), (3, "a " * 20)]
    docs = spark.createDataFrame([(i, t, 1, "r") for i, t in rows], "doc_id long, text string, start int, Runs string").repartition(3)
    found = periodic_runs.periodic_runs(periodic_runs.with_repeats(docs) if rewrite else docs).drop("runs", "collapsed")
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted((expected(i, t, rewrite) for i, t in rows), key=str)
    assert periodic_runs.periodic_runs(docs.limit(0)).isEmpty()


def test_periodic_runs_of_a_long_text(spark):
    """Over a megabyte, with its runs far inside."""
    pick = random.Random(10)
    words = [f"w{pick.randrange(3000)}" for _ in range(220_000)]
    words[100_000:100_080] = ["p", "q", "r", "s"] * 20
    words[150_000:150_007] = ["z"] * 7
    row = periodic_runs.periodic_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(100_000, 80, 4), (150_000, 7, 1)]
    assert row.collapsed == " ".join(words[:100_004] + words[100_080:150_001] + words[150_007:])
