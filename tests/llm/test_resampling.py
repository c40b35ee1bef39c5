import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from gradewell.llm import resampling as R

from .awkward_rows import ROWS

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = WORD.findall(low)
    return found, found + [f"{a} {b}" for a, b in zip(found, found[1:])]


def brute(rows, target):
    """(id, features, weight, score, rank), one document after the other."""
    count = lambda texts: Counter(crc32(f.encode()) % 10000 for t in texts for f in runs(t)[1])
    s, t = count([x for _, x in rows]), count(target)
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000))))
    out = []
    for name, text in rows:
        found, f = runs(text)
        weight = sum(gain(crc32(x.encode()) % 10000) for x in f) // len(f) if f else 0
        score = None
        if name is not None:
            h = int(sha256(f"7:{name}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([name, len(f), weight, score, None, len(found)])
    able = sorted((r for r in out if r[5] >= 20 and r[0] is not None), key=lambda r: (-r[3], r[0]))
    for place, row in enumerate(able[:25 * len(able) // 100]):
        row[4] = place + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def shown(made):
    return sorted(map(tuple, made.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_against_brute_force(spark, documents):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("text")
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert shown(R.resample(documents, target)) == brute(rows, [r[0] for r in target.collect()])


def test_awkward_rows(spark, awkward, nothing):
    target = spark.createDataFrame([("end of the long text",), (None,), ("",)], "text string")
    made = R.resample(awkward, target)
    assert set(awkward.columns) <= set(made.columns)
    assert shown(made) == brute(ROWS, ["end of the long text", None, ""])
    assert R.resample(nothing, target).collect() == []
    assert shown(R.resample(awkward, target.where("false"))) == brute(ROWS, [])
    with pytest.raises(ValueError):
        R.resample(spark.createDataFrame([("a", "b")], "doc_id string, text string"), target)


@pytest.mark.parametrize("bits,stretch", [(12, 1_000_000), (4, 50), (16, 7)])
def test_radix_sort(spark, tmp_path, bits, stretch):
    """Composite keys of all widths, negative numbers as unsigned ones, and ties."""
    rng = np.random.default_rng(bits)
    rows = [(int(a), int(b)) for a, b in zip(rng.integers(0, 5, 400), rng.integers(-2**63, 2**63 - 1, 400))]
    rows += [(3, 17)] * 30 + [(4, -1), (4, 0), (0, -2**63)]
    spark.createDataFrame(rows, "a long, b long").repartition(5).write.parquet(str(tmp_path / "rows"))
    table = spark.read.parquet(str(tmp_path / "rows"))
    made = R.radix_ranks(table, [("a", 3), ("b", 64)], R.Resampling(bits=bits, stretch=stretch)).collect()
    assert sorted(r["place"] for r in made) == list(range(len(rows)))
    wanted = sorted(rows, key=lambda r: (r[0], r[1] % 2**64))
    assert [(r["a"], r["b"]) for r in sorted(made, key=lambda r: r["place"])] == wanted
    assert R.radix_ranks(table.where("false"), [("a", 3)]).collect() == []
    assert len({r["place"] for r in R.radix_ranks(table, [("a", 0)]).collect()}) == len(rows)


def test_ids_beyond_the_range_of_a_difference(spark):
    words = " ".join(f"w{i}" for i in range(25))
    rows = [(-2**63, words), (2**63 - 1, words), (0, words), (-1, words), (5, words), (6, words), (7, words), (8, words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([("w1 w2",)], "text string")
    assert shown(R.resample(docs, target)) == brute(rows, ["w1 w2"])


@settings(max_examples=100, deadline=None)
@given(st.text())
def test_features(text):
    found, wanted = runs(text)
    assert [w.decode() for w in R.words(text.encode())] == found
    assert R.features(R.words(text.encode()), 10000).tolist() == [crc32(f.encode()) % 10000 for f in wanted]
