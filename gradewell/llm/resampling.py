"""Importance resampling towards a target: weights scored by an array of gains, ranks by a distributed radix sort.

A document's features are its runs of one or two words, hashed into buckets. Counts of the buckets in the corpus and in the target
are two arrays of fixed size; from them every bucket has a gain, and a document's weight is the mean gain of its features. A
Gumbel draw from a hash of the id makes the weights a sample without replacement: the highest scores are drawn.

The scores are ranked by a least-significant-digit radix sort over the table. The key is composite, the score downwards and then the
id upwards, and is taken digit by digit from its lowest. In each pass a task holds one stretch of places: it puts its rows in
their order, numbers those of equal digits in that order (a stable counting sort), and adds the offset of the digit in its
stretch, which is a prefix sum over all digits and stretches. That is each row's next place. After the last pass
the place is the rank. Every pass is a written table; no task holds more than a stretch, and the driver sees a few numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gradewell.llm.common import PLAIN_WORDS, integers, released, staged, with_result


@dataclass(frozen=True)
class Resampling:
    buckets: int = 10_000
    seed: int = 7
    #: Documents of fewer words are never drawn.
    least_words: int = 20
    #: Share of the others that is drawn.
    percent: int = 25
    #: Bits of a digit.
    bits: int = 12
    #: Rows of one stretch, at most.
    stretch: int = 1_000_000


DEFAULT = Resampling()


# --- features and weights -----------------------------------------------------------------------

def words(text: bytes) -> list[bytes]:
    """Runs of letters, digits and bytes beyond ASCII, lower-cased in A-Z."""
    return text.translate(PLAIN_WORDS).split()


def features(found: list[bytes], buckets: int) -> np.ndarray:
    """Buckets of all runs of one and two words."""
    ones = list(map(crc32, found))
    spaced = [b" " + w for w in found[1:]]
    # The checksum of two words goes on from that of the first.
    return np.array(ones + list(map(crc32, spaced, ones)), np.int64) % buckets


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For each bucket the thousandfold logarithm of how much likelier it is in the target, one added to each count."""
    n = len(corpus)
    all_corpus, all_target = float(corpus.sum()) + n, float(target.sum()) + n
    return np.array(
        [floor(1000 * log((t + 1.0) * all_corpus / ((s + 1.0) * all_target))) for s, t in zip(corpus.tolist(), target.tolist())],
        np.int64,
    )


def gumbel(seed: int, name: int) -> int:
    """Thousandfold Gumbel draw, rounded down, that belongs to the id."""
    h = int(sha256(b"%d:%d" % (seed, name)).hexdigest()[:8], 16)
    return floor(-1000 * log(-log((h + 0.5) / 4294967296)))


def bucket_counts(texts: DataFrame, p: Resampling, text_col: str) -> np.ndarray:
    """How often each bucket occurs in all texts. Every task adds up its own; `p.buckets` numbers reach the driver."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(p.buckets, np.int64)
        for batch in released(batches):
            for text in batch.column(0):
                found = features(words(text.as_py() or b""), p.buckets)
                sums += np.bincount(found, minlength=p.buckets)
        held = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"bucket": held, "n": sums[held]})

    sums = (
        texts.select(_own(text_col).cast("string").cast("binary")).mapInArrow(counted, "bucket long, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # at most p.buckets rows
    )
    out = np.zeros(p.buckets, np.int64)
    for row in sums:
        out[row["bucket"]] = row["n"]
    return out


def _weighted(gain: np.ndarray, p: Resampling):
    """Words, features, weight and score of each (id, text)."""

    def of(ids: pa.Array, texts: pa.Array) -> pa.Array:
        columns: list[list] = [[], [], [], []]
        for name, text in zip(ids, texts):
            found = words(text.as_py() or b"")
            at = features(found, p.buckets)
            weight = int(gain[at].sum()) // len(at) if len(at) else 0
            score = weight + gumbel(p.seed, name.as_py()) if name.is_valid else None
            for column, value in zip(columns, (len(found), len(at), weight, score)):
                column.append(value)
        return pa.StructArray.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["n_words", "n_features", "weight", "score"])

    def weighted(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ids, texts in released(batches):
            yield of(ids, texts)

    kind = "struct<n_words:bigint,n_features:bigint,weight:bigint,score:bigint>"
    return F.arrow_udf(weighted, kind, F.ArrowUDFType.SCALAR_ITER).asNondeterministic()


def _own(column: str) -> Column:
    return F.col(f"`{column.replace('`', '``')}`")


def weigh(docs: DataFrame, target: DataFrame, p: Resampling = DEFAULT, id_col: str = "doc_id", text_col: str = "text",
          target_text: str = "text") -> DataFrame:
    """`docs` with n_words, n_features, weight and score; columns of those names are replaced.

    A null text has no words; without words there is no feature and the weight is 0. A row without an id has no score. Ids
    are integers, others raise ValueError. An empty target or corpus counts 0 everywhere. Whole texts are read, twice.
    """
    name = integers(docs, id_col)
    gain = gains(bucket_counts(docs, p, text_col), bucket_counts(target, p, target_text))
    made = _weighted(gain, p)(name, _own(text_col).cast("string").cast("binary"))
    return with_result(docs, made, ["n_words", "n_features", "weight", "score"])


# --- the radix sort -----------------------------------------------------------------------------

@dataclass(frozen=True)
class Digit:
    column: str
    shift: int
    bits: int

    @property
    def of(self) -> Column:
        return F.shiftrightunsigned(F.col(self.column), self.shift).bitwiseAND(F.lit((1 << self.bits) - 1)).cast("int")


def digits(key: list[tuple[str, int]], bits: int) -> list[Digit]:
    """Digits of a composite key (column, bits it needs), the lowest of the last column first."""
    return [Digit(column, shift, bits) for column, needed in reversed(key) for shift in range(0, needed, bits)]


def offsets(rows: DataFrame, digit: Digit) -> DataFrame:
    """(stretch, digit, offset): how many rows come before those of a digit in a stretch, over the whole table.

    The prefix over stretches is one window for each digit; that over digits has 2^bits rows at most.
    """
    counts = rows.groupBy("stretch", digit.of.alias("digit")).agg(F.count("*").alias("n"))
    totals = counts.groupBy("digit").agg(F.sum("n").alias("n"))
    below = totals.select("digit", (F.sum("n").over(Window.orderBy("digit")) - F.col("n")).alias("below"))
    before = F.sum("n").over(Window.partitionBy("digit").orderBy("stretch")) - F.col("n")
    return counts.select("stretch", "digit", before.alias("before")).join(below, "digit").select(
        "stretch", "digit", (F.col("before") + F.col("below")).alias("offset"))


def _dealt(digit: Digit, size: int):
    """One stretch and its offsets: its rows with their next place."""
    mask = np.uint64((1 << digit.bits) - 1)

    def place(rows: pa.Table, known: pa.Table) -> pa.Table:
        rows = rows.take(pa.array(np.argsort(rows.column("place").to_numpy(), kind="stable")))
        values = (rows.column(digit.column).to_numpy().view(np.uint64) >> np.uint64(digit.shift) & mask).astype(np.int64)
        # Counting sort: rows of one digit follow each other in `order` as they did before.
        order = np.argsort(values.astype(np.uint16), kind="stable")
        counts = np.bincount(values, minlength=1 << digit.bits)
        starts = np.cumsum(counts) - counts
        offset = np.zeros(1 << digit.bits, np.int64)
        offset[known.column("digit").to_numpy()] = known.column("offset").to_numpy()
        to = np.empty(len(values), np.int64)
        to[order] = np.arange(len(values)) - starts[values[order]] + offset[values[order]]
        names = rows.column_names
        return rows.set_column(names.index("place"), "place", pa.array(to)).set_column(
            names.index("stretch"), "stretch", pa.array(to // size))

    return place


def radix_ranks(rows: DataFrame, key: list[tuple[str, int]], p: Resampling = DEFAULT) -> DataFrame:
    """`rows` with `place` (0, 1, 2, ...) in the order of the composite key, whose columns are longs of so many bits, unsigned.

    Rows of equal keys stand next to each other, in any order. `rows` is a written table without the columns place and stretch.
    An empty table and an empty key are harmless. Each pass moves every row once.
    """
    spark, total = rows.sparkSession, rows.count()
    stretches = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // p.stretch))
    size = max(1, -(-total // stretches))
    # The first order is any order: numbers that a written table keeps, in stretches of the same count.
    number = F.monotonically_increasing_id()
    now = staged(rows.select("*", number.alias("place"), F.pmod(number, F.lit(stretches)).alias("stretch")), "place")
    for digit in digits(key, p.bits) or [Digit("place", 0, 1)]:
        told = staged(offsets(now, digit), "offsets")
        dealt = now.groupBy("stretch").cogroup(told.groupBy("stretch")).applyInArrow(_dealt(digit, size), now.schema)
        now = staged(dealt, "place")
    return now.drop("stretch")


def resample(docs: DataFrame, target: DataFrame, p: Resampling = DEFAULT, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text") -> DataFrame:
    """`docs` with n_words, n_features, weight, score and rank; columns of those names are replaced.

    Of the rows with an id and at least `p.least_words` words, `p.percent` in a hundred are drawn, rounded down: the highest
    scores, of equal ones the smaller id. rank is 1, 2, 3, ... in that order and null for the others. Rows that share id and
    score stand next to each other in any order. See weigh() for nulls, empty texts and empty tables.
    """
    fields = ["n_words", "n_features", "weight", "score", "rank"]
    kept = [c for c in docs.columns if c.lower() not in fields]
    own = docs.select(F.struct(*map(_own, docs.columns)).alias("row"), _own(id_col).alias("id"), _own(text_col).alias("text"))
    weighed = weigh(own, target, p, "id", "text", target_text)
    made = staged(weighed.select(
        F.monotonically_increasing_id().alias("idx"), "row", F.col("id").cast("long").alias("id"),
        "n_words", "n_features", "weight", "score"), "weighed")

    able = made.where(F.col("score").isNotNull() & (F.col("n_words") >= p.least_words))
    ends = able.agg(F.min("id"), F.max("id"), F.min("score"), F.max("score"), F.count("*")).first()
    low, high, least, most, n = ends
    if n == 0:
        ranked = made.select("idx", F.lit(None).cast("long").alias("rank")).limit(0)
    else:
        wide = high - low >= 1 << 63  # then the sign bit alone is turned, which orders all longs
        by_id = F.col("id").bitwiseXOR(F.lit(-(1 << 63))) if wide else F.col("id") - F.lit(low)
        keyed = staged(able.select("idx", (F.lit(most) - F.col("score")).alias("by_score"), by_id.alias("by_id")), "keyed")
        key = [("by_score", (most - least).bit_length()), ("by_id", 64 if wide else (high - low).bit_length())]
        places = radix_ranks(keyed, key, p)
        ranked = places.where(F.col("place") < p.percent * n // 100).select("idx", (F.col("place") + 1).alias("rank"))
    return made.join(ranked, "idx", "left").select(*[F.col("row")[c].alias(c) for c in kept], *fields)
