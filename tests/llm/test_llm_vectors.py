"""Operators on embeddings: whitening, clusters, exact search."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from feedloom.llm import clustering, oracle, queries, topk_search, vectors as packing, whitening

SMALL = "/root/testdata/sf0.001"
ROWS = "vec_id bigint, embedding array<double>, label int, row int, length int, shard int"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, 3) for i, v in rows], ROWS)


def random_rows(n, dims, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, v.tolist()) for i, v in enumerate(rng.normal(0, spread, (n, dims)))]


def odd_rows(dims):
    """Besides some usable vectors: null, empty, not finite, of other lengths, huge, repeated."""
    rows = random_rows(30, dims, 5)
    usual = rows[3][1]
    return rows + [
        (None, usual),
        (100, None),
        (101, []),
        (102, [None] + usual[1:]),
        (103, [math.nan] + usual[1:]),
        (104, [math.inf] + usual[1:]),
        (105, usual + [1.0]),
        (106, usual[:-1]),
        (3, usual),
        (50, usual),
        (50, usual),
        (107, [0.0] * dims),
    ]


def kept(rows, dims):
    """What takes part, by length."""
    return [
        (i, v) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]


@pytest.mark.parametrize("top", [5, 1 << 14, 1 << 20, 1 << 40])
def test_packed_vectors_come_back(top):
    import pyarrow as pa

    rng = np.random.default_rng(1)
    rows = rng.integers(-top, top, (50, 7)) >> rng.integers(0, 30, (50, 1))
    lengths = pa.array(np.full(50, 7, np.int32))
    packed = pa.concat_arrays([pa.array([b"x"]), packing.pack(rows)])[1:]
    ((part, found),) = packing.unpack(packed, lengths)
    assert (found == rows[part]).all() and len(part) == 50
    assert len({bytes(x) for x in packed.to_pylist()}) == len({tuple(r) for r in rows.tolist()})


# whitening


def expected_whitening(rows, components):
    x = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    z = centred @ axes[:, :components] / np.sqrt(values[:components])
    deviation = ((n * x - s) ** 2).sum(axis=1)
    return n, z, deviation, values[:components] / values.sum()


def check_whitening(found, rows, components=8):
    n, z, deviation, explained = expected_whitening(rows, components)
    by_row = sorted((r["vec_id"] is None, r["vec_id"], r["component"], r["whitened"]) for r in found)
    assert len(found) == n * z.shape[1]
    got = np.array([r[3] for r in by_row]).reshape(-1, z.shape[1])
    order = sorted(range(n), key=lambda i: (rows[i][0] is None, rows[i][0]))
    sign = np.sign((got * z[order]).sum(axis=0))
    assert np.abs(got * sign - z[order]).max() < 1e-8
    numbers = {r["vec_id"]: r["deviation"] for r in found}
    assert all(numbers[rows[i][0]] == deviation[i] for i in range(n))
    for r in found:
        assert r["n"] == n and r["identity_error"] < 1e-8 and r["deviation_wide"] is None
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-8


def test_whitening_against_plain_numpy(spark):
    rows = random_rows(300, 12, 1)
    rows += [(1000 + i, rows[7][1]) for i in range(200)]  # one vector on two fifths of the rows
    check_whitening(whitening.whiten(table_of(spark, rows)).collect(), rows)


def test_whitening_of_the_given_table(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SMALL}/embeddings.parquet'").fetchall()
    check_whitening(queries.op11_whitening(spark, SMALL).collect(), rows)


def test_fewer_dimensions_than_components(spark):
    rows = random_rows(40, 3, 2)
    check_whitening(whitening.whiten(table_of(spark, rows)).collect(), rows)


def test_odd_rows_of_whitening(spark):
    dims = 4
    rows = odd_rows(dims)
    found = whitening.whiten(table_of(spark, rows)).collect()
    usual = kept(rows, dims)
    n, z, deviation, _ = expected_whitening(usual, 8)
    assert sum(r["n"] == n for r in found) == n * dims
    # vectors of other lengths are one of a kind each: no variance
    for r in found:
        if r["n"] == 1:
            assert r["whitened"] == 0 and r["deviation"] == 0 and r["explained"] == 0
    assert {r["vec_id"] for r in found if r["n"] == 1} == {105, 106}
    assert {r["deviation"] for r in found if r["vec_id"] == 50} == {int(deviation[3])}
    assert len([r for r in found if r["vec_id"] == 50]) == 2 * dims


def test_deviations_beyond_a_long_are_exact(spark):
    rows = [(0, [1e12, 1.0]), (1, [-1e12, 2.0]), (2, [0.0, 0.0])]
    found = whitening.whiten(table_of(spark, rows)).collect()
    x = [[int(1024 * c) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x, strict=True)]
    for r in found:
        exact = sum((3 * a - s) ** 2 for a, s in zip(x[r["vec_id"]], sums, strict=True))
        assert (r["deviation"] if exact < 1 << 63 else int(r["deviation_wide"])) == exact
    assert any(r["deviation"] is None for r in found)


def test_whitening_with_weights_of_one(spark):
    rows = random_rows(30, 5, 3)
    again = rows + [(100 + i, rows[0][1]) for i in range(50)]
    found = whitening.whiten(table_of(spark, again), by_count=False).collect()
    check_whitening([r for r in found if r["vec_id"] < 100], rows)
    assert len(found) == 80 * 5


# clusters


def expected_clusters(rows, count=8, rounds=10, seed=3):
    x = [[math.floor(1024 * c) for c in v] for _, v in rows]
    named = [i for i in range(len(rows)) if rows[i][0] is not None]
    named.sort(key=lambda i: hashlib.sha256(f"{seed}:{rows[i][0]}".encode()).hexdigest())
    centroids = [x[i] for i in named[:count]]

    def assign():
        far = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids] for v in x]
        return [(min(range(len(f)), key=lambda k: (f[k], k)), min(f)) for f in far]

    for _ in range(rounds):
        of = assign()
        for k in range(len(centroids)):
            own = [v for v, (c, _) in zip(x, of, strict=True) if c == k]
            if own:
                centroids[k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    of = assign()
    inertia = [sum(d for c, d in of if c == k) for k in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((i, c, d, inertia[c], sum(inertia), digest[c]) for (i, _), (c, d) in
         zip(rows, of, strict=True)),
        key=repr,
    )


def got_clusters(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("leading", [1, 4, 6])
def test_clusters_against_plain_python(spark, leading):
    rows = random_rows(120, 6, 4) + [(500 + i, [0.25] * 6) for i in range(60)]
    found = clustering.clusters(table_of(spark, rows), dims=6, leading=leading)
    assert got_clusters(found) == expected_clusters(rows)


def test_odd_rows_of_clusters(spark):
    rows = odd_rows(4)
    found = clustering.clusters(table_of(spark, rows), dims=4, leading=2)
    assert got_clusters(found) == expected_clusters(kept(rows, 4))


def test_equal_vectors_and_empty_clusters(spark):
    rows = [(i, [0.5, -0.25]) for i in range(20)]
    found = clustering.clusters(table_of(spark, rows), dims=2, leading=1)
    assert got_clusters(found) == expected_clusters(rows)


def test_fewer_vectors_than_clusters_and_huge_ones(spark):
    rows = [(1, [1.0, 2.0]), (2, [1e300, -1e300]), (3, [-1e300, 1e300])]
    found = clustering.clusters(table_of(spark, rows), dims=2, leading=1).collect()
    assert sorted(r["vec_id"] for r in found) == [1, 2, 3]
    assert {r["distance"] for r in found} == {0}


def test_most_distances_are_not_taken():
    """The bound leaves few centroids of vectors that lie near a plane."""
    rng = np.random.default_rng(6)
    rows = np.zeros((2000, 64), np.int64)
    rows[:, :2] = rng.integers(-5000, 5000, (2000, 2))
    rows += rng.integers(-20, 20, rows.shape)
    covariance = np.cov(rows.T, bias=True)
    rotation = clustering.Rotation(rows.mean(axis=0), covariance, 4)
    centroids = clustering.Centroids(rows[:32].copy(), rotation)
    leading, rest, _ = rotation.reduced(rows)
    cluster, distance, taken = centroids.nearest(rows, leading, rest)
    far = ((rows[:, None] - rows[:32]) ** 2).sum(axis=2)
    assert (cluster == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()
    assert taken < 2 * len(rows)


# search


def expected_search(rows, k=5, every=50):
    x = [[math.floor(256 * c) for c in v] for _, v in rows]
    found = []
    for q, (query, _) in enumerate(rows):
        if query is not None and query % every == 0:
            scored = [
                (-sum(a * b for a, b in zip(x[q], x[i], strict=True)), rows[i][0] is None,
                 rows[i][0], i)
                for i in range(len(rows)) if i != q
            ]
            scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
            found += [(query, n + 1, s[2], -s[0]) for n, s in enumerate(scored[:k])]
    return sorted(found, key=repr)


def got_search(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_search_against_plain_python(spark, monkeypatch):
    rows = random_rows(400, 6, 7)
    rows += [(1000 + i, rows[9][1]) for i in range(200)]  # many equal scores
    expected = expected_search(rows)
    assert got_search(topk_search.top_k(table_of(spark, rows))) == expected
    # many shards, blocks and tiles, and a tree of several levels
    monkeypatch.setattr(topk_search, "BLOCK", 5)
    monkeypatch.setattr(topk_search, "SHARD", 16)
    monkeypatch.setattr(topk_search, "TILE", (3, 7))
    monkeypatch.setattr(topk_search, "FAN", 3)
    monkeypatch.setattr(topk_search, "_FEW", 1)
    assert got_search(topk_search.top_k(table_of(spark, rows))) == expected


def test_odd_rows_of_search(spark):
    rows = odd_rows(4)
    found = got_search(topk_search.top_k(table_of(spark, rows), every=5))
    expected = expected_search(kept(rows, 4), every=5)
    # those of other lengths have nobody to be compared with
    assert found == expected


@pytest.mark.parametrize("scale", [1.0, 1e4, 2e8])
def test_scores_of_large_numbers_are_exact(scale):
    rng = np.random.default_rng(8)
    rows = (rng.normal(0, 1, (60, 5)) * scale).astype(np.int64)
    numbers = np.arange(60)
    parts = list(topk_search.top_of_shard(rows[:10], numbers[:10], rows, numbers, 4))
    query, place, score = (np.concatenate(c) for c in zip(*parts, strict=True))
    exact = rows.astype(object) @ rows.T.astype(object)
    for q in range(10):
        order = sorted((i for i in range(60) if i != q), key=lambda i: (-exact[q, i], i))[:4]
        assert place[query == q].tolist() == order
        assert score[query == q].tolist() == [exact[q, i] for i in order]


def test_fewer_than_k_others(spark):
    rows = [(0, [1.0]), (50, [2.0]), (7, [3.0])]
    assert got_search(topk_search.top_k(table_of(spark, rows))) == expected_search(rows)


# all of them


def test_no_vectors(spark):
    for rows in ([], [(1, None), (2, [math.nan])]):
        df = table_of(spark, rows)
        for found in (whitening.whiten(df), clustering.clusters(df), topk_search.top_k(df)):
            assert found.collect() == []
    assert whitening.whiten(table_of(spark, [(1, [])])).collect() == []


@pytest.mark.parametrize("name", ["op12_clustering", "op13_topk_search"])
def test_query_against_its_sql(spark, name):
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
        expected = duck.sql(oracle.ORACLE_SQL[name])
        result = queries.QUERIES[name](spark, SMALL)
        assert sorted(result.columns) == sorted(expected.columns)
        got = [tuple(r[c] for c in expected.columns) for r in result.collect()]
        assert sorted(got, key=repr) == sorted(expected.fetchall(), key=repr)
