import zlib

import pytest
from .test_decontamination import brute as decontaminated
from .test_near_dup import brute as near_dups
from .test_packing import check
from .test_secrets import base as secrets

import __spark_entry__
import corpus_pipeline as P
from gradewell.llm import packing, toxicity
from gradewell.llm.common import staged

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def stages(spark, documents):
    """The documents before and after each stage."""
    out, docs = [documents], documents
    for name, stage in P.STAGES:
        docs = staged(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def test_names_and_columns(stages, documents):
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    assert all(d.columns == documents.columns and d.dtypes == documents.dtypes for d in stages[:-1])


def test_toxicity(spark, stages):
    model = toxicity.train(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    scored = toxicity.score_toxicity(stages[0], model)
    assert rows_of(stages[1]) == rows_of(scored.where("predicted = 0").drop("score", "predicted"))
    assert 0 < stages[1].count() < stages[0].count()


def test_near_duplicates(stages):
    before = [(r["doc_id"], r["text"]) for r in stages[1].collect()]
    kept = {i for i, _ in before if str((i, *_kept(before)[i])).endswith("True)")}
    assert {r["doc_id"] for r in stages[2].collect()} == kept and stages[2].count() == len(kept) < len(before)


_cache = {}


def _kept(before):
    if not _cache:
        import ast

        _cache.update({row[0]: row[1:] for row in map(ast.literal_eval, near_dups(before))})
    return _cache


def test_decontamination(spark, stages):
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = stages[2].collect()
    assert rows_of(stages[3]) == sorted(str(r) for r in before if not decontaminated(r["text"], items)[1])


def test_secrets(stages):
    before = {r["doc_id"]: r for r in stages[3].collect()}
    after = {r["doc_id"]: r for r in stages[4].collect()}
    assert before.keys() == after.keys()
    for i, r in before.items():
        spans = secrets(r["text"])[1]
        assert bool(spans) <= ("[SECRET]" in after[i]["text"]) and after[i]["n_chars"] == len(after[i]["text"])
        assert not spans or all(r["text"][s:e] not in after[i]["text"] for s, e, _ in spans)
        if "[SECRET]" not in after[i]["text"]:
            assert after[i] == r


def test_packing_and_run(spark, stages):
    tokens = packing.WordTokens(packing.default().tokenizer).tokenizer
    ids_of = [(r["doc_id"], tokens.encode(r["text"], add_special_tokens=False).ids + [2]) for r in stages[4].collect()]
    check([r.asDict() | {"crc": zlib.crc32(r["ids"])} for r in stages[5].collect()], ids_of, 4096)
    run = __spark_entry__.queries()["pipeline"](spark, SF)
    # The run has models of its own but the same rows, and so the same pieces up to where sequences cut them.
    whole = lambda df: {
        i: b"".join(ids for _, ids in sorted(of)) for i, of in _by_document(df).items()
    }
    assert whole(run) == whole(stages[5])


def _by_document(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"])))
    return out


def test_awkward_rows(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for _, stage in P.STAGES[:-1]:
            made = stage(spark, docs, SF)
            assert made.columns == docs.columns
            docs = staged(made, "awkward")
        P.STAGES[-1][1](spark, docs, SF).count()
    near = P.STAGES[1][1](spark, awkward, SF).collect()
    ids = [r["doc_id"] for r in near]
    assert ids.count(None) == 2 and ids.count(13) == 2 and ids.count(5) == 0 and ids.count(4) == 1


def test_texts_that_share_an_id_are_compared_one_by_one(spark):
    """Texts of one id that are no near copies all stay; of near copies one stays, whatever the order of the rows."""
    words = [f"w{i}" for i in range(80)]
    group = [" ".join([f"x{k}" if i == 3 * k else w for i, w in enumerate(words)]) for k in range(6)]
    others = [f"text {i} of one id alpha beta gamma delta {i * 7} epsilon" for i in range(12)]
    rows = [(1, t) for t in others + group[:4]] + [(0, others[3]), (2, group[5]), (2, "alone"), (3, "alone")]
    made = set()
    for order in (rows, rows[::-1], rows[9:] + rows[:9]):
        docs = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        made.add(tuple(sorted((r["doc_id"], r["text"]) for r in P.STAGES[1][1](spark, docs, SF).collect())))
    kept = list(made.pop())
    assert not made
    assert sorted(t for _, t in kept if t in others) == sorted(others) and (0, others[3]) in kept
    assert [i for i, t in kept if t in group] == [1] and [i for i, t in kept if t == "alone"] == [2]
