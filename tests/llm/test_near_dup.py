import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gradewell.llm import near_dup as N
from gradewell.llm.components import components, forest
from gradewell.llm.common import staged

from .awkward_rows import ROWS


def shingle_set(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in low.translate(dict.fromkeys(map(ord, "\t\n\x0b\x0c\r"), " ")).split(" ") if w]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(id, size, component, kept) of each row, by comparing all texts; rows of one id are one document."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    above = {i: i for i, _ in rows if i is not None}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is None or j is None or not a or not b:
                continue
            common = len(a & b)
            if 100 * common >= 75 * (len(a) + len(b) - common):
                x, y = sorted((top(i), top(j)))
                above[y] = x
    out = []
    for i, s in sets:
        component = None if i is None else top(i) if s else i
        out.append((i, len(s), component, i is None or component == i))
    return sorted(map(str, out))


def found(df):
    return sorted(str((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])) for r in df.collect())


def test_awkward_rows(awkward, nothing):
    assert found(N.near_duplicates(awkward)) == brute(ROWS)
    assert N.near_duplicates(nothing).count() == 0


def copies(seed, groups, size, words=60):
    """Groups of near copies whose members differ from the group's text in up to a fifth of the places, chains too."""
    random.seed(seed)
    rows, vocabulary = [], [f"w{i}" for i in range(5_000)]
    passage = random.choices(vocabulary, k=40)
    for g in range(groups):
        text = random.choices(vocabulary, k=words)
        for k in range(size):
            own = list(text)
            for at in random.sample(range(words), k % 4):
                own[at] = random.choice(vocabulary)
            if k % 5 == 4:
                text = own
            rows.append((len(rows), " ".join(own)))
        rows.append((len(rows), " ".join(passage + random.choices(vocabulary, k=20))))
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [512, 4])
def test_near_copies_against_all_pairs(spark, block):
    rows = copies(3, 12, 25)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(N.near_duplicates(docs, N.NearDup(block=block))) == brute(rows)


def test_every_band_mate_is_decided_without_the_sketch(spark):
    rows = copies(5, 6, 12)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(N.near_duplicates(docs, N.NearDup(least_agreeing=0.0, block=16))) == brute(rows)


def test_a_group_of_near_copies_costs_its_size(spark):
    """Pairs that are verified grow with the members of a group, not with their square."""
    random.seed(9)
    verified = []
    for size in (100, 400):
        text = [f"w{i}" for i in range(200)]
        rows = [(k, " ".join([f"x{k}" if i == k % 200 else w for i, w in enumerate(text)])) for k in range(size)]
        named = spark.createDataFrame(rows, "id long, text string").select("id", F.col("text").cast("binary").alias("text"))
        prints = named.select("id", N._fingerprints(N.DEFAULT)("text").alias("f")).select("id", "f.*")
        classes = staged(prints.withColumnRenamed("id", "node"), "classes")
        banded = classes.select("node", F.explode("bands").alias("key"))
        shared = staged(banded.join(banded.groupBy("key").agg(F.min("node").alias("rep")), "key"), "shared")
        first = staged(N._with_representatives(shared, classes, N.DEFAULT), "first")
        labels = staged(components(first), "labels")
        verified.append(first.count() + N._open_pairs(shared, labels, classes, N.DEFAULT).count())
    assert verified[1] < 8 * verified[0] and verified[1] < 400 * 12


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    estimates = []
    for _ in range(200):
        whole = rng.integers(0, 2**63, 240, dtype=np.uint64)
        a, b = N.superminhash([np.unique(whole[:200]), np.unique(whole[40:])])  # 160 of 240 in common
        estimates.append((a == b).mean())
    assert abs(np.mean(estimates) - 2 / 3) < 0.01
    # Plain MinHash with 128 slots has a deviation of 0.0417.
    assert np.std(estimates) < 0.036


def test_signatures_do_not_depend_on_company():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 3, 100, 2_000, 7)]
    together = N.superminhash(sets)
    assert all((N.superminhash([s])[0] == row).all() for s, row in zip(sets, together))
    assert (together < N.SLOTS).all()


def test_parities_never_claim_too_much():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 4_000, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool[:m], m * 3 // 4, replace=False)) for m in (2, 8, 100, 120, 130, 400, 500, 2_000, 4_000)]
    bound = N.Parities([N.parities(s) for s in sets])
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            least = bound.differing(i, np.array([j]))[0]
            differ = len(np.setxor1d(a, b))
            assert least <= differ
            if 0.75 <= len(a) / len(b) <= 4 / 3 and i != j:
                assert least > 0.6 * differ


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=60))
def test_forest(edges):
    trees = forest(edges)
    reach = {x: x for e in edges for x in e}
    for _ in reach:
        for a, b in edges:
            reach[a] = reach[b] = min(reach[a], reach[b])
    assert trees == {x: r for x, r in reach.items() if x != r}


@pytest.mark.parametrize("share", [10_000, 20])
def test_components(spark, monkeypatch, share):
    """With few edges a task, passes of stars settle what tasks leave apart."""
    monkeypatch.setattr("gradewell.llm.components.EDGES_A_TASK", share)
    random.seed(4)
    path = list(range(1_000, 1_400))
    order = random.sample(path, len(path))
    edges = list(zip(order, order[1:])) + [(5, x) for x in range(6, 300)] + [(7, 7), (300, 301), (301, 300), (None, 4)]
    made = components(staged(spark.createDataFrame(edges, "a long, b long").repartition(16), "edges"))
    rows = {r["node"]: r["root"] for r in made.collect()}
    assert made.count() == len(rows)
    assert rows == {**dict.fromkeys(path, 1_000), **dict.fromkeys(range(5, 300), 5), 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
