"""Packing along a space-filling curve: similar documents become neighbours in the training sequences.

Every document's tokens are hashed into a signed vector and projected to four dimensions. Each dimension is
made uniform by the corpus' mean and deviation and cut into cells; a document's place on the Hilbert curve through
the cells is its key. Documents are range-sorted by key, their tokens laid end to end along the curve, and
the line is cut every 4096 tokens. So only the very last sequence holds padding.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from gradewell.llm.common import released, shared_folder, staged


@dataclass(frozen=True)
class Packing:
    tokenizer: str
    end_id: int = 2
    length: int = 4096
    #: Hashed vectors, and what they are projected to: `dims` coordinates of `bits` bits each.
    hashed: int = 512
    dims: int = 4
    bits: int = 12


def default() -> Packing:
    import public_tokenizers

    return Packing(public_tokenizers.path("word_bpe_49k.json"))


#: A word of letters that clean-up neither splits nor joins, and the ASCII marks after it, of which none opens a contraction.
_WORD = r"^(?P<stem>[a-zA-ZÀ-ÖØ-öø-ÿ]+)(?P<marks>(?:[!-&(-/:-@\[-`{-~][!-/:-@\[-`{-~]*)?)$"


#: Texts by which a tokenizer shows whether it goes word by word: cases, marks, white space of all kinds, digits, other scripts.
_PROBE = (
    "Words, WORDS and words; can't  won't\tI'll   see...", " leading and trailing \n\n", "a.b,c!d?(e) [f] {g} 12 3.14 x2 2x",
    "École, ŒUVRE, İstanbul, ΣΟΦΟΣ, straße", "你好 мир\u00a0x\u3000y", "a\n b\r\nc", "don't-stop/now_then $5 #1 @me", "",
)


class WordTokens:
    """Token ids of texts by the tokenizer file, each different word tokenized once a batch.

    For tokenizers that never join what white space parts, nor letters and the marks after them, and that mark
    the token which ends a word: the ids of a text are those of its words in turn. Upper case in A-Z may be lost
    beforehand if the tokenizer drops it anyway, but for special tokens. Whether a file is of that kind is tried when it is
    loaded; texts of another are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # For lower-case words of letters, which need no clean-up.
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        ])
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.ends = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[i] = token.endswith("</w>")
        told = self._encoded(pa.array(_PROBE, pa.string()))
        self.by_words = bool(self.ends.any()) and all(
            np.array_equal(a, b) for a, b in zip(told, self._each(list(_PROBE)), strict=True))

    def _each(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(e.ids, self.kind) for e in found]

    def _stems(self, stems: list[str]) -> list[np.ndarray]:
        """Ids of words of letters, many to a call; parts of the list in turn, each with the lengths of its words."""
        groups = [stems[i:i + 500] for i in range(0, len(stems), 500)]
        out = []
        for group, e in zip(groups, self.letters.encode_batch_fast([" ".join(g).lower() for g in groups])):
            ids = np.array(e.ids, self.kind)
            last = np.flatnonzero(self.ends[ids])
            if len(last) == len(group):
                out.append((ids, np.diff(last, prepend=-1)))
            else:
                each = self._each(group)
                out.append((np.concatenate(each), np.array([len(x) for x in each])))
        return out

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text (null: none), a few megabytes of texts at a time."""
        texts = pc.fill_null(texts, "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + (1 << 22), "right")))
            some = texts.slice(at, stop - at)
            yield from self._encoded(some) if self.by_words else self._each(some.to_pylist())
            at = stop

    def _encoded(self, texts: pa.Array) -> Iterator[np.ndarray]:
        special = pc.match_substring(texts, "<|")
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        words = split.flatten().dictionary_encode()
        known, which = words.dictionary, words.indices.to_numpy(zero_copy_only=False)
        parts = pc.extract_regex(known, _WORD)
        other = pc.is_null(parts).to_numpy(zero_copy_only=False)
        stems = pc.struct_field(parts, "stem").dictionary_encode()
        marks = pc.struct_field(parts, "marks").dictionary_encode()

        # Pieces in turn: the stems, the marks, the other words. A word is a stem and marks, or one other word and nothing.
        found = self._stems(stems.dictionary.to_pylist())
        single = self._each(marks.dictionary.to_pylist() + known.filter(pa.array(other)).to_pylist())
        flat = np.concatenate([ids for ids, _ in found] + single + [np.zeros(0, self.kind)])
        size = np.concatenate([n for _, n in found] + [np.array([len(x) for x in single] + [0], np.int64)])
        start = np.cumsum(size) - size
        n_stems, nothing = len(stems.dictionary), len(size) - 1
        first = pc.fill_null(stems.indices, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        second = pc.fill_null(marks.indices, 0).to_numpy(zero_copy_only=False) + n_stems
        first[other] = n_stems + len(marks.dictionary) + np.arange(other.sum())
        second = np.where(other, nothing, second)

        piece = np.column_stack((first[which], second[which])).reshape(-1)
        lengths = size[piece]
        done = np.cumsum(lengths)
        ids = flat[np.repeat(start[piece] - (done - lengths), lengths) + np.arange(done[-1] if len(done) else 0)]
        cuts = np.concatenate(([0], done))[2 * (split.offsets.to_numpy() - split.offsets[0].as_py())]
        whole = iter(self._each(texts.filter(special).to_pylist()))
        for i, is_special in enumerate(special.to_pylist()):
            yield next(whole) if is_special else ids[cuts[i]:cuts[i + 1]]


@lru_cache(maxsize=2)
def _tokens(path: str) -> WordTokens:
    return WordTokens(path)


@dataclass(frozen=True)
class Vectors:
    """The fixed hashing and projection, the same in every task: bucket and sign by token id."""

    bucket: np.ndarray
    sign: np.ndarray
    onto: np.ndarray

    @staticmethod
    def of(p: Packing, ids: int) -> Vectors:
        mixed = np.arange(1, ids + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        bucket = ((mixed >> np.uint64(20)) % np.uint64(p.hashed)).astype(np.int64)
        onto = np.random.default_rng(4096).standard_normal((p.hashed, p.dims))
        return Vectors(bucket, np.where(mixed >> np.uint64(63), 1.0, -1.0), onto)

    def point(self, tokens: np.ndarray) -> np.ndarray:
        """Coordinates of a document: signed buckets, damped, of unit length, projected."""
        vector = np.bincount(self.bucket[tokens], self.sign[tokens], len(self.onto))
        vector = np.sign(vector) * np.sqrt(np.abs(vector))
        return vector / max(1e-12, np.sqrt(vector @ vector)) @ self.onto


_DOCUMENT = "struct<n:bigint,ids:binary,point:array<double>>"


def _documents(p: Packing):
    def documents(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = _tokens(p.tokenizer)
        vectors = Vectors.of(p, max(len(tokens.ends), p.end_id + 1))
        end = np.array([p.end_id], tokens.kind)
        for texts in released(batches):
            out = []
            for ids in tokens.encode(texts):
                whole = np.concatenate((ids, end))
                out.append({"n": len(whole), "ids": whole.tobytes(), "point": vectors.point(whole)})
            yield pa.array(out, pa.struct([("n", pa.int64()), ("ids", pa.binary()), ("point", pa.list_(pa.float64()))]))

    return F.arrow_udf(documents, _DOCUMENT, F.ArrowUDFType.SCALAR_ITER).asNondeterministic()


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of cell numbers, below 2 ** bits each."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(dims):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(up, q - 1, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    gray = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        gray ^= np.where((x[-1] & q) != 0, q - 1, 0)
    x ^= gray
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _key(points: Column, mean: list[float], spread: list[float], bits: int) -> Column:
    """Hilbert keys of points whose coordinates are made about uniform in [0, 1) first."""

    def keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in released(batches):
            at = np.asarray(batch.flatten()).reshape(len(batch), -1)
            at = (at - np.array(mean)) / np.array(spread)
            even = 1 / (1 + np.exp(-1.702 * np.clip(at, -30, 30)))
            yield pa.array(hilbert(np.minimum((even * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits))

    return F.arrow_udf(keys, "bigint", F.ArrowUDFType.SCALAR_ITER).asNondeterministic()(points)


def _cut(kind: np.dtype, length: int):
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            out = [[] for _ in names]
            for doc, begin, ids in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = np.frombuffer(ids, kind).astype("<u4")
                start = 0
                while start < len(tokens):
                    sequence, offset = divmod(begin + start, length)
                    stop = min(len(tokens), start + length - offset)
                    piece = (doc, start, stop - start, tokens[start:stop].tobytes(), len(tokens), sequence, offset)
                    for column, x in zip(out, piece):
                        column.append(x)
                    start = stop
            kinds = [batch.schema.field(0).type, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    return cut


def pack(docs: DataFrame, p: Packing | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id and offset.

    A null text is empty: its document is the end id alone. Every row is a document, with a null or repeated id too;
    equal texts share a key and lie beside each other, in the order of their rows. Other columns are not read. An
    empty table gives an empty one. The tokens are moved once, by row; only keys and lengths are sorted. Equal keys are
    dealt by row as well, so that no group of copies meets in one task.
    """
    p = p or default()
    spark = docs.sparkSession
    made = docs.select(
        F.col(id_col).alias("doc_id"), _documents(p)(F.col(text_col).cast("string")).alias("d")
    ).select(F.monotonically_increasing_id().alias("row"), "doc_id", "d.*")
    folder = shared_folder(spark, "tokens")
    made.write.option("compression", "zstd").parquet(folder)
    made = spark.read.schema(made.schema).parquet(folder)

    at = [F.col("point")[i] for i in range(p.dims)]
    told = made.agg(*map(F.avg, at), *map(F.stddev_pop, at)).first()
    mean, spread = [x or 0.0 for x in told[:p.dims]], [max(x or 0.0, 1e-9) for x in told[p.dims:]]

    keyed = staged(made.select("row", "n", _key(F.col("point"), mean, spread, p.bits).alias("key")), "keys")
    ranged = staged(keyed.repartitionByRange("key", "row").withColumn("part", F.spark_partition_id()), "ranges")
    parts = ranged.groupBy("part").agg(F.sum("n").alias("n"))  # a row for each partition
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("key", "row")) - F.col("n")
    starts = ranged.withColumn("inside", inside).join(F.broadcast(before), "part").select(
        "row", (F.col("before") + F.col("inside")).alias("begin")
    )
    laid = made.select("row", "doc_id", "ids").join(staged(starts, "starts"), "row").select("doc_id", "begin", "ids")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return laid.mapInArrow(_cut(_tokens(p.tokenizer).kind, p.length), schema)
