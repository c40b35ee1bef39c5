import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from gradewell.llm import packing
from gradewell.llm.queries import op1_curve_packing

from .awkward_rows import ROWS


@pytest.fixture(scope="module")
def tokens():
    return packing.WordTokens(packing.default().tokenizer)


TEXT = st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aB's'tre.,!? \n\t\x0b\x1c\x85\xa0éÉßİΣςḰ÷ÿ$<|endoftext|>12")))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=4))
def test_word_by_word_is_the_tokenizer(tokens, some):
    whole = [tokens.tokenizer.encode(t or "", add_special_tokens=False).ids for t in some]
    assert [x.tolist() for x in tokens.encode(pa.array(some, pa.string()))] == whole


def test_other_tokenizers_encode_whole_texts(tokens):
    import public_tokenizers

    assert tokens.by_words
    other = packing.WordTokens(public_tokenizers.path("byte_bpe_50k.json"))
    some = ["Some text, with  blanks.", None, "", " École 12"]
    assert not other.by_words
    assert [x.tolist() for x in other.encode(pa.array(some, pa.string()))] == [
        other.tokenizer.encode(t or "", add_special_tokens=False).ids for t in some]


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_neighbours(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = packing.hilbert(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def check(pieces, ids_of, length):
    """Every id of every row lies in one piece, and sequences are filled without gaps but the last."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    made = sorted((str(doc), r["start"], r["length"], r["crc"], r["doc_tokens"]) for doc, rs in by_doc.items() for r in rs)
    assert sum(r["length"] for r in pieces) == sum(len(i) for _, i in ids_of)
    wanted = defaultdict(list)
    for doc, ids in ids_of:
        wanted[doc].append(ids)
    for doc, start, n, crc, whole in made:
        texts = [i for d, some in wanted.items() if str(d) == doc for i in some if len(i) == whole]
        assert any(zlib.crc32(np.array(i[start:start + n], "<u4").tobytes()) == crc for i in texts)
    for k, parts in by_sequence.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == length or k == max(by_sequence)
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_awkward_rows(awkward, nothing, tokens):
    p = packing.default()
    pieces = [r.asDict() | {"crc": zlib.crc32(r["ids"])} for r in packing.pack(awkward, p).collect()]
    ids_of = [(d, tokens.tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in ROWS]
    check(pieces, ids_of, 4096)
    assert packing.pack(nothing, p).count() == 0


def test_query(spark, texts, tokens):
    pieces = [r.asDict() | {"crc": r["ids_crc32"]} for r in op1_curve_packing(spark, "/root/testdata/sf0.001").collect()]
    check(pieces, [(d, tokens.tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in texts.items()], 4096)


def test_similar_documents_lie_close(spark):
    import random

    random.seed(5)
    vocabularies = [[f"{a}{i}" for i in range(60)] for a in ("kala", "mondo", "trifi")]
    rows = [(i, " ".join(random.choices(vocabularies[i % 3], k=200))) for i in range(120)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).where("start = 0")
    order = [r["doc_id"] % 3 for r in pieces.orderBy("sequence_id", "offset").collect()]
    assert sum(a != b for a, b in zip(order, order[1:])) < 40  # 80 if the order were random
