import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gradewell.llm import token_counts as C
from gradewell.llm.queries import EDITED, op7_token_counts

from .awkward_rows import ROWS

TEXT = st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab's'tre.,!? \n\t12  ''llve  ")), max_size=60)


@pytest.fixture(scope="module")
def counter():
    return C.Counter(C.default(), 2_000)


def whole(counter, text):
    return len(counter.whole.encode_ordinary(text or ""))


@settings(max_examples=500, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(0, 70), st.integers(0, 10), TEXT), max_size=4))
def test_edits_one_after_the_other(counter, text, edits):
    pieces = counter.pieces(text)
    tree = C.Tree(np.array([len(p) for p in pieces], np.int64), np.array([counter[p] for p in pieces], np.int64))
    for start, n, new in edits:
        start = min(start, len(text))
        end = min(len(text), start + n)
        wanted = text[:start] + new + text[end:]
        text, _ = C.edit_all(text, tree, counter, [(start, end, new)])
        assert text == wanted and tree.characters == len(text) and tree.tokens == whole(counter, text)
        assert [n for leaf in range(tree.size) for n in tree.cuts(leaf)] == [len(p) for p in counter.pieces(text)]


def test_only_the_region_is_encoded(counter):
    text = "some words of a long text " * 5_000
    pieces = counter.pieces(text)
    tree = C.Tree(np.array([len(p) for p in pieces], np.int64), np.array([counter[p] for p in pieces], np.int64))
    _, encoded = C.edit_all(text, tree, counter, [(60_000, 60_010, "new")])
    assert encoded < 10


@settings(max_examples=300, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60), TEXT), max_size=8))
def test_edits_of_one_text_together(counter, text, wanted):
    edits, at = [], 0
    for a, b, new in sorted(wanted):
        start, end = max(at, min(a, len(text))), max(at, min(max(a, b), len(text)))
        edits.append((start, max(start, end), new))
        at = edits[-1][1]
    changed = text
    for start, end, new in reversed(edits):
        changed = changed[:start] + new + changed[end:]
    pieces = counter.pieces(text)
    tree = C.Tree(np.array([len(p) for p in pieces], np.int64), np.array([counter[p] for p in pieces], np.int64))
    assert C.edit_all(text, tree, counter, edits)[0] == changed
    assert tree.tokens == whole(counter, changed) and tree.characters == len(changed)


def test_awkward_rows(spark, awkward, nothing, counter):
    edits = C.Masking("z|[0-9]+|[Ee]nd", "€")
    made = C.apply_edits(C.with_trees(awkward), edits)
    got = sorted(str((r["doc_id"], r["n_tokens"], r["n_edits"], r["n_tokens_after"], r["text_after"])) for r in made.collect())
    wanted = []
    for i, t in ROWS:
        after, n = re.subn("z|[0-9]+|[Ee]nd", "€", t or "")
        wanted.append(str((i, whole(counter, t), n, whole(counter, after), after if n else t)))
    assert got == sorted(wanted)
    assert made.columns.count("text_after") == 1
    # Without kept trees the same.
    same = C.apply_edits(awkward, edits)
    assert sorted(map(str, same.collect())) == sorted(map(str, made.drop("tree").select(*same.columns).collect()))
    assert C.apply_edits(C.with_trees(nothing), edits).count() == 0


def test_a_second_batch_uses_the_trees_of_the_first(spark, awkward, counter, tmp_path):
    """Trees are written with the edited texts; the next batch counts right and encodes its own regions only."""
    once = C.apply_edits(C.with_trees(awkward), C.Masking("[0-9]+|dolor", "×××"), with_trees_after=True)
    once.select("doc_id", F.col("text_after").alias("text"), F.col("tree_after").alias("tree")).write.parquet(str(tmp_path / "once"))
    kept = spark.read.parquet(str(tmp_path / "once"))
    twice = C.apply_edits(kept, C.Masking("×+|a ", "0 1"), with_trees_after=True).collect()
    wanted = []
    for i, t in ROWS:
        one = re.sub("[0-9]+|dolor", "×××", t or "")
        two, n = re.subn("×+|a ", "0 1", one)
        wanted.append(str((i, len(counter.pieces(one)), whole(counter, one), n, whole(counter, two), two)))
    got = [str((r["doc_id"], r["n_pre_tokens"], r["n_tokens"], r["n_edits"], r["n_tokens_after"], r["text_after"] or "")) for r in twice]
    assert sorted(got) == sorted(wanted)
    for r in twice:
        lengths, tokens = C._numbers(bytes(r["tree_after"]))
        pieces = counter.pieces(r["text_after"] or "")
        assert lengths.tolist() == list(map(len, pieces)) and tokens.tolist() == [counter[p] for p in pieces]


@pytest.mark.parametrize("edits", [[(3, 2, "")], [(-1, 2, "")], [(0, 99, "")], [(4, 6, ""), (2, 3, "")], [(0, 3, ""), (2, 4, "")]])
def test_wrong_edits_are_refused(edits):
    with pytest.raises(ValueError, match="edit"):
        C._checked("some text", [{"start": a, "end": b, "new": c} for a, b, c in edits])


def test_given_edits(spark, counter):
    kind = "doc_id long, text string, e array<struct<start:bigint,end:bigint,new:string>>"
    rows = [(1, "some text here", [(0, 4, "more"), (5, 5, "of "), (5, 9, None)]), (2, "x", None), (3, None, []), (4, "", [(0, 0, "new")])]
    made = {r["doc_id"]: r for r in C.apply_edits(spark.createDataFrame(rows, kind), F.col("e")).collect()}
    assert [made[i]["text_after"] for i in (1, 2, 3, 4)] == ["more of  here", "x", None, "new"]
    assert all(made[i]["n_tokens_after"] == whole(counter, made[i]["text_after"]) for i in made)


def test_query(spark, texts, counter):
    for r in op7_token_counts(spark, "/root/testdata/sf0.001").collect():
        text = texts[r["doc_id"]]
        after, n = re.subn(EDITED, "", text)
        assert (r["n_tokens"], r["n_edits"], r["n_tokens_after"]) == (whole(counter, text), n, whole(counter, after))
        assert r["n_pre_tokens"] == len(counter.pieces(text)) and (r["n_encoded"] > 0) == (n > 0)
