import random

import numpy as np
import pytest

from gradewell.llm import vector_dup as V


def brute(rows, least=0.95):
    """(id, links, component, kept) of each row, by comparing all rows."""
    made = []
    for _, v in rows:
        v = None if v is None or None in v else np.array(v, np.float64)
        made.append(v if v is not None and len(v) and np.isfinite(v).all() and v.any() else None)
    above, links = list(range(len(rows))), [0] * len(rows)

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for i, a in enumerate(made):
        for j, b in enumerate(made[:i]):
            if a is None or b is None or len(a) != len(b) or rows[i][0] is None or rows[j][0] is None:
                continue
            x, y = a / np.abs(a).max(), b / np.abs(b).max()
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                links[i] += 1
                links[j] += 1
                above[top(i)] = top(j)
    out = []
    for i, (name, _) in enumerate(rows):
        component = None if name is None else min(r[0] for k, r in enumerate(rows) if r[0] is not None and top(k) == top(i))
        out.append((name, links[i], component, component in (None, name)))
    return sorted(out, key=str)


def near(rng, v, cosine):
    """A vector of that cosine with `v`."""
    side = rng.normal(size=len(v))
    side -= (side @ v) / (v @ v) * v
    return cosine * v / np.linalg.norm(v) + np.sqrt(1 - cosine**2) * side / np.linalg.norm(side)


def rows_of(made):
    return sorted(map(tuple, made.collect()), key=str)


@pytest.mark.parametrize("dim,block", [(64, 8192), (100, 8192), (64, 7)])
def test_against_all_pairs(spark, dim, block):
    """Groups, chains and lone vectors; small blocks deal a bucket over several groups of comparisons."""
    rng = np.random.default_rng(dim)
    rows, centres = [], rng.normal(size=(30, dim))
    for k, centre in enumerate(centres):
        rows += [near(rng, centre, c) for c in ([0.99] * 12 if k < 3 else [0.951, 0.949] if k < 20 else [])]
        rows.append(centre * rng.uniform(0.1, 1000))
        for _ in range(5 if k > 25 else 0):
            rows.append(near(rng, rows[-1], 0.96))
    rows += [rows[0], rows[0] * 3, rows[5], -rows[5]]
    named = [(i * 7 % 1009, [float(x) for x in v]) for i, v in enumerate(rows)]
    made = V.near_vectors(spark.createDataFrame(named, "vec_id long, embedding array<double>"), V.NearVectors(block=block))
    assert rows_of(made) == brute(named)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [float(x) for x in np.random.default_rng(1).normal(size=8)]
    rows = [
        (1, None), (2, []), (3, [0.0] * 8), (4, [nan] + v[1:]), (5, [inf] + v[1:]), (6, [None] + v[1:]), (7, v), (8, v), (8, v),
        (9, [2e30 * x for x in v]), (10, [-x for x in v]), (None, v), (None, None), (11, v[:7]), (12, [1.0]), (13, [2.0]), (14, [-1.0]),
        (11, v), (15, [1.0, 0.0]), (16, [1.0, -0.0]), (17, [1.0, 0.0, 0.0]),
    ]
    clash = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, key string, idx int")
    made = V.near_vectors(clash)
    assert made.columns == ["vec_id", "n_links", "component_id", "kept"]
    floats = [(i, None if w is None else [None if x is None else float(np.float32(x)) for x in w]) for i, w in rows]
    assert rows_of(made) == brute(floats)
    assert V.near_vectors(clash.where("false")).collect() == []
    with pytest.raises(ValueError):
        V.near_vectors(spark.createDataFrame([("a", v)], "vec_id string, embedding array<float>"))


def test_estimates_are_unbiased_and_bounds_hold():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(400, 64))
    b = np.array([near(rng, v, 0.95) for v in a])
    units = V.unit(np.vstack([a, b]))
    gaps = []
    for seed in range(20):
        codes = V.Codes(V.encode(units, seed, rng.integers(0, 2**63, 800).astype(np.uint64)))
        rows, others = np.arange(400), np.arange(400, 800)
        gaps.append(np.diag(codes.estimate(rows, others)) - 0.95)
        assert np.diag(codes.open(rows, others)).all()
        assert codes.open(rows, rows)[~np.eye(400, dtype=bool)].mean() < 0.01  # unlike vectors need no exact computation
    assert abs(np.mean(gaps)) < 0.002


def test_tables_follow_the_chance_of_missing():
    for rows in (1, 10_000, 10**8, 10**11):
        how = V.keys_for(rows)
        assert (1 - V.meeting_rate(how.places, 0.95)) ** how.tables <= 0.001


def test_recall_at_the_threshold():
    """Pairs of exactly the asked cosine meet in some table."""
    rng = np.random.default_rng(8)
    a = rng.normal(size=(3000, 64))
    b = np.array([near(rng, v, 0.95) for v in a])
    for how in (V.keys_for(10_000), V.keys_for(10**7), V.keys_for(10**8)):
        met = (V.bucket_keys(V.unit(a), 64, how, 20) == V.bucket_keys(V.unit(b), 64, how, 20)).any(axis=1)
        assert met.mean() > 0.99
