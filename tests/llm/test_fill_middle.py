import re
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gradewell.llm import fill_middle as M

from .awkward_rows import LONG, ROWS


def brute(name, text):
    """FIELDS by a list of units."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    if name is not None:
        told = sha256(f"1:{name}".encode()).hexdigest()
        h = [int(told[i:i + 8], 16) for i in range(0, 32, 8)]
    if name is None or not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


PIECES = st.sampled_from(["a", "Z", "word", " ", "\n", "0", "é", "你", "😀", "<", "<P", ">", "<S>", "@", "[", "`", "{", "\x00", "S>"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 10**6)), st.lists(PIECES).map("".join) | st.text()), max_size=8))
def test_against_lists_of_units(rows):
    rows = [(n, t.encode("utf-8", "ignore").decode()) for n, t in rows]
    made = M.transform_texts([n for n, _ in rows], [t.encode() for _, t in rows])
    assert [(*r[:4], r[4].decode()) for r in made] == [brute(n, t) for n, t in rows]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=300))
def test_wavelet_matrix_ranks(symbols):
    matrix = M.WaveletMatrix(np.array(symbols, np.uint8), 2)
    at = np.arange(len(symbols) + 1)
    for s in range(4):
        assert matrix.rank(s, at).tolist() == [symbols[:i].count(s) for i in at]


def test_awkward_rows(spark, awkward, nothing):
    made = M.fill_middle(awkward)
    assert set(made.columns) == {*awkward.columns, *M.FIELDS}
    rows = made.withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
    assert sorted((str(r["doc_id"]), *(r[f] for f in M.FIELDS)) for r in rows if r["n"] and r["form"] != "plain") == sorted(
        (str(i), *brute(i, t)) for i, t in ROWS if t and brute(i, t)[1] != "plain")
    assert sorted((str(r["doc_id"]), r["back"]) for r in rows) == sorted((str(i), t or "") for i, t in ROWS)
    assert M.fill_middle(nothing).collect() == []
    with pytest.raises(ValueError):
        M.fill_middle(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_few_bytes_under_a_matrix_give_the_same(spark, documents):
    few, many = (M.fill_middle(documents, M.FillMiddle(at_once=k)).select("doc_id", *M.FIELDS) for k in (100, 4 << 20))
    key = lambda r: r["doc_id"]
    assert sorted(few.collect(), key=key) == sorted(many.collect(), key=key)


def test_both_orders_and_plain_texts_occur(spark):
    made = M.fill_middle(spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(LONG[:500]).alias("text")))
    share = {r["form"]: r["count"] / 2000 for r in made.groupBy("form").count().collect()}
    assert abs(share["plain"] - 0.1) < 0.03 and abs(share["spm"] - 0.18) < 0.03 and abs(share["psm"] - 0.72) < 0.04
