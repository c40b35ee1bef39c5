"""Near-duplicate vectors by randomised-rotation binary codes with correction factors.

A unit vector is turned by one random rotation. Its code is the sign of every coordinate; the code's inner product with the
turned vector itself is stored beside it as the correction factor. The inner product of a code with another turned vector,
divided by the code's factor, is an unbiased estimate of the cosine of the two, and its spread is known: it falls
with the root of the dimensions. The other vector is kept in four bits a coordinate, rounded up or down at random, which
adds a known spread and no bias. Only pairs that a confidence bound leaves open are computed anew, in double precision.

Which pairs are looked at is told by keys: each of many tables turns the vector by a rotation of its own and takes the places and
signs of its few largest coordinates. The number of tables follows from the wanted chance of meeting, and the places
taken from the number of vectors, so that buckets stay small at any size while that chance stays.

Equal vectors are one class. Two passes over the buckets: the first moves codes only and tells which vectors have a
pair left open; the second brings the vectors of those, computes their pairs and gives sums and a spanning forest. No pair is
ever a row. A large bucket is cut into blocks, and each two blocks meet in a task of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gradewell.llm.common import integers, released, staged
from gradewell.llm.components import components

#: Directions of a table; codes are padded to a multiple of as many coordinates.
LANES = 64
_GOLDEN = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class NearVectors:
    cosine: float = 0.95
    #: Chance that two vectors of exactly that cosine share no key; closer ones miss each other less often.
    miss: float = 0.001
    #: Standard deviations between estimate and bound.
    deviations: float = 4.5
    #: Vectors a key on average, at most; tells how many places make a key.
    occupancy: int = 512
    #: Members of a bucket in one block.
    block: int = 8192
    seed: int = 20


DEFAULT = NearVectors()


@dataclass(frozen=True)
class _Keys:
    """How keys are made: places a key takes, and tables."""

    places: int
    tables: int


@lru_cache(maxsize=32)
def meeting_rate(places: int, cosine: float) -> float:
    """Share of pairs of that cosine that get one key in one table, by simulation with a fixed seed."""
    draw = np.random.default_rng(5)
    a, e = draw.normal(size=(2, 20_000, LANES))
    b = cosine * a + np.sqrt(1 - cosine * cosine) * e
    return float((_largest(a, places) == _largest(b, places)).all(axis=1).mean())


def keys_for(rows: int, p: NearVectors = DEFAULT) -> _Keys:
    """Fewest places that leave `occupancy` vectors a key, and as many tables as the wanted chance takes."""
    places = 1
    while places < 8 and comb(LANES, places) * 2**places * p.occupancy < rows:
        places += 1
    return _Keys(places, ceil(log(p.miss) / log(1 - meeting_rate(places, p.cosine))))


def _largest(turned: np.ndarray, places: int) -> np.ndarray:
    """The places of the largest coordinates of each row, in order of place, with their signs."""
    at = np.argpartition(-np.abs(turned), places - 1, axis=-1)[..., :places] if places < turned.shape[-1] else None
    if at is None:
        return np.broadcast_to(np.arange(turned.shape[-1]), turned.shape) * 2 + (turned > 0)
    at.sort(axis=-1)
    return at * 2 + (np.take_along_axis(turned, at, axis=-1) > 0)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _rotation(size: int, seed: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))[0].astype(np.float32)


@lru_cache(maxsize=4)
def _directions(size: int, tables: int, seed: int) -> np.ndarray:
    """LANES orthogonal directions for each table, side by side."""
    draw = np.random.default_rng(seed + 1)
    return np.hstack([np.linalg.qr(draw.normal(size=(size, LANES)))[0] for _ in range(tables)]).astype(np.float32)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, padded with zeros to a multiple of LANES; none is zero."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    scaled /= np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
    return np.pad(scaled, ((0, 0), (0, -scaled.shape[1] % LANES)))


def bucket_keys(units: np.ndarray, dim: int, how: _Keys, seed: int) -> np.ndarray:
    """A 64-bit key for each row and table; the table and the vector's own length are parts of it."""
    turned = (units.astype(np.float32) @ _directions(units.shape[1], how.tables, seed)).reshape(len(units), how.tables, LANES)
    digits = _largest(turned, how.places).astype(np.uint64)
    keys = np.arange(how.tables, dtype=np.uint64) + np.uint64(dim << 20) + np.zeros((len(units), 1), np.uint64)
    for i in range(how.places):
        keys = _mix(keys * np.uint64(_GOLDEN) + digits[..., i])
    return keys.view(np.int64)


def encode(units: np.ndarray, seed: int, dither: np.ndarray) -> np.ndarray:
    """One row of bytes for each vector: factor, lowest level, step, signs, and four bits a coordinate.

    `dither`, a 64-bit number for each row, draws the random rounding; equal vectors get equal bytes.
    """
    size = units.shape[1]
    turned = units.astype(np.float32) @ _rotation(size, seed)
    factor = np.abs(turned).sum(axis=1) / np.sqrt(size, dtype=np.float32)
    low = turned.min(axis=1)
    step = np.maximum((turned.max(axis=1) - low) / 15, np.float32(1e-9))
    chance = (_mix(dither[:, None] + np.arange(size, dtype=np.uint64) * np.uint64(_GOLDEN)) >> np.uint64(40)) * 2.0**-24
    level = np.clip(np.floor((turned - low[:, None]) / step[:, None] + chance), 0, 15).astype(np.uint8)
    numbers = np.stack([factor, low, step], axis=1).astype("<f4").view(np.uint8)
    return np.hstack([numbers, np.packbits(turned > 0, axis=1), level[:, 0::2] | level[:, 1::2] << 4])


class Codes:
    """Codes of a group of vectors, ready to be compared."""

    def __init__(self, raw: np.ndarray, p: NearVectors = DEFAULT):
        size = (raw.shape[1] - 12) * 8 // 5
        factor, low, step = np.ascontiguousarray(raw[:, :12]).view("<f4").T
        signs = np.unpackbits(raw[:, 12:12 + size // 8], axis=1).astype(np.float32) * 2 - 1
        self.signs = signs / (np.sqrt(size, dtype=np.float32) * factor[:, None])
        levels = np.empty((len(raw), size), np.float32)
        nibbles = raw[:, 12 + size // 8:]
        levels[:, 0::2], levels[:, 1::2] = nibbles & 15, nibbles >> 4
        self.turned = low[:, None] + step[:, None] * levels
        # Spread at the asked cosine, of the code and of the rounding; it is smaller above.
        code = (1 - p.cosine**2) * np.maximum(1 - factor**2, 0) / (factor**2 * (size - 1))
        self.slack = p.deviations * np.sqrt(code + (step.max(initial=0) / (2 * factor)) ** 2)
        self.cosine = p.cosine

    def estimate(self, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        return self.signs[rows] @ self.turned[others].T

    def open(self, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Which pairs may reach the cosine, by the bounds of both codes."""
        one = self.estimate(rows, others) + self.slack[rows][:, None]
        two = self.estimate(others, rows) + self.slack[others][:, None]
        return (one >= self.cosine) & (two.T >= self.cosine)


# --- tasks --------------------------------------------------------------------------------------

_PRINT = "struct<dim:int,digest:binary,keys:array<bigint>,code:binary,vec:binary>"


def _prints(how: _Keys, p: NearVectors, kind: str):
    """Digest, keys, code and bytes of every usable vector; nulls for the others."""

    def of(column: pa.Array) -> pa.Array:
        dims, digests, keys, codes, vecs = ([None] * len(column) for _ in range(5))
        by_size: dict[int, list[int]] = {}
        lengths = column.value_lengths().to_pylist()
        for i, length in enumerate(lengths):
            if length:
                by_size.setdefault(length, []).append(i)
        for dim, rows in by_size.items():
            flat = column.take(pa.array(rows)).flatten()
            made = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(rows), dim) + 0.0  # no negative zero
            good = np.isfinite(made).all(axis=1) & (made != 0).any(axis=1)  # nulls are NaN here
            if not good.any():
                continue
            made, rows = made[good], np.array(rows)[good]
            units = unit(made)
            raw = made.astype(kind)
            stored = [v.tobytes() for v in raw]
            dither = np.array([xxhash.xxh3_64_intdigest(s) for s in stored], np.uint64)
            own_keys, own_codes = bucket_keys(units, dim, how, p.seed), encode(units, p.seed, dither)
            for i, s, k, c in zip(rows, stored, own_keys, own_codes):
                dims[i], digests[i], keys[i], codes[i], vecs[i] = dim, xxhash.xxh3_128_digest(s), k, c.tobytes(), s
        kinds = (pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary())
        names = ("dim", "digest", "keys", "code", "vec")
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip((dims, digests, keys, codes, vecs), kinds)], names)

    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in released(batches):
            parts = [of(column.slice(at, 1_000)) for at in range(0, len(column), 1_000)]
            yield pa.concat_arrays(parts or [of(column)])

    return F.arrow_udf(prints, _PRINT, F.ArrowUDFType.SCALAR_ITER).asNondeterministic()


def _groups(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.Table]:
    """Rows of equal first `n` columns, of batches in which they follow each other."""
    held: pa.Table | None = None
    for batch in released(batches):
        table = pa.Table.from_batches([batch])
        table = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
        if not len(table):
            continue
        by = [table.column(i).to_numpy() for i in range(n)]
        change = np.zeros(len(table) - 1, bool)
        for column in by:
            change |= column[1:] != column[:-1]
        starts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for a, b in zip(starts, starts[1:]):
            yield table.slice(a, b - a)
        held = table.slice(starts[-1])
    if held is not None and len(held):
        yield held


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Byte strings of one length as rows."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(len(column), -1)


_SIDE = 512  # rows of a block that are compared with the others at once


def _sides(group: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Rows and others to be compared, a few rows at a time; whether both are the same rows."""
    lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
    mine = group.column("mine").to_numpy()
    first, second = np.flatnonzero(mine == lo), np.flatnonzero(mine == hi)
    for at in range(0, len(first), _SIDE):
        if lo == hi:
            yield first[at:at + _SIDE], first[at:], True
        else:
            yield first[at:at + _SIDE], second, False


def _pairs(codes: Codes, rows: np.ndarray, others: np.ndarray, same: bool) -> np.ndarray:
    open_pairs = codes.open(rows, others)
    return np.triu(open_pairs, 1) if same else open_pairs


def _with_open_pairs(p: NearVectors):
    """(dim, key, idx) of the members that have a pair left open in their bucket."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims, keys, ids = [], [], []

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pydict({
                "dim": pa.array(dims, pa.int32()), "key": pa.array(keys, pa.int64()), "idx": pa.array(ids, pa.int64())})
            for column in (dims, keys, ids):
                column.clear()
            return made

        for group in _groups(batches, 4):
            if len(group) < 2:
                continue
            codes, live = Codes(_matrix(group.column("code")), p), np.zeros(len(group), bool)
            for rows, others, same in _sides(group):
                open_pairs = _pairs(codes, rows, others, same)
                live[rows] |= open_pairs.any(axis=1)
                live[others] |= open_pairs.any(axis=0)
            if live.any():
                own = group.column("idx").to_numpy()[live].tolist()
                ids += own
                dims += [group.column("dim")[0].as_py()] * len(own)
                keys += [group.column("key")[0].as_py()] * len(own)
                if len(ids) >= 50_000:
                    yield out()
        yield out()

    return found


def _links(p: NearVectors, kind: str):
    """(a, null, n) how many vectors a member is linked with in this bucket first, and (a, b, null) a spanning forest.

    A pair that shares several keys is counted in the first of their tables only.
    """

    def rows_of(group: pa.Table) -> Iterator[tuple[int, int | None, int | None]]:
        size, idx = len(group), group.column("idx").to_numpy()
        copies = group.column("copies").to_numpy()
        keys = np.array(group.column("keys").to_pylist(), np.int64)
        table = int(np.flatnonzero(keys[0] == group.column("key")[0].as_py())[0])
        codes = Codes(_matrix(group.column("code")), p)
        vectors = _matrix(group.column("vec")).view(kind).astype(np.float64)
        vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        linked, tree, forest = np.zeros(size, np.int64), np.arange(size), []
        for rows, others, same in _sides(group):
            open_pairs = _pairs(codes, rows, others, same)
            for i, row in zip(rows, open_pairs):
                j = others[row]
                if table:
                    j = j[~(keys[j, :table] == keys[i, :table]).any(axis=1)]
                j = j[vectors[j] @ vectors[i] / (lengths[j] * lengths[i]) >= p.cosine]
                if not len(j):
                    continue
                linked[i] += copies[j].sum()
                linked[j] += copies[i]
                trees, at = np.unique(tree[j], return_index=True)
                joined = trees != tree[i]
                if joined.any():
                    forest += [(int(idx[i]), int(b)) for b in idx[j[at[joined]]]]
                    tree[np.isin(tree, trees[joined])] = tree[i]
        yield from ((int(a), None, int(n)) for a, n in zip(idx, linked) if n)
        yield from ((a, b, None) for a, b in forest)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pydict(
                {name: pa.array([r[i] for r in rows], pa.int64()) for i, name in enumerate(("a", "b", "n"))})
            rows.clear()
            return made

        for group in _groups(batches, 4):
            if len(group) < 2:
                continue
            rows += rows_of(group)
            if len(rows) >= 50_000:
                yield out()
        yield out()

    return links


# --- plans --------------------------------------------------------------------------------------

def _in_blocks(members: DataFrame, p: NearVectors) -> DataFrame:
    """`members` (dim, key, idx, ...) so that every two of one bucket meet in one group (dim, key, lo, hi) of a task.

    The list of buckets of more than one block joins by Spark's choice, which knows its size.
    """
    rest = [c for c in members.columns if c not in ("dim", "key", "idx")]
    large = (
        members.groupBy("dim", "key").agg(F.count("*").alias("size")).where(F.col("size") > p.block)
        .select("dim", "key", F.ceil(F.col("size") / p.block).cast("int").alias("blocks"))
    )
    blocks = F.coalesce(F.col("blocks"), F.lit(1))
    dealt = members.join(staged(large, "large"), ["dim", "key"], "left").select(
        "dim", "key", "idx", *rest, F.pmod(F.xxhash64("idx"), blocks).cast("int").alias("mine"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"),
    ).select("dim", "key", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "mine", "idx", *rest)
    return dealt.repartition("dim", "key", "lo", "hi").sortWithinPartitions("dim", "key", "lo", "hi")


def _own(column: str) -> Column:
    return F.col(f"`{column.replace('`', '``')}`")


def near_vectors(
    vectors: DataFrame, p: NearVectors = DEFAULT, id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """One row per row of `vectors`: the id (long), n_links, component_id and kept.

    n_links counts the other rows of cosine `p.cosine` or more, in double precision, that share a key; component_id is
    the smallest id that links reach, itself included; kept is whether that is the own id. Vectors that are null, empty, zero
    or hold null or non-finite components are linked with nothing, nor are vectors of different lengths. Every row is a
    vector of its own, also where rows share an id or are equal throughout: such rows are linked. A row without an id takes
    part in no link: no links, a null component, kept. Ids are integers (others raise ValueError), vectors arrays of numbers.
    Other columns are not read. An empty table gives an empty one.
    """
    element = vectors.schema[vec_col].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    named = vectors.select(
        integers(vectors, id_col).alias("id"),
        _own(vec_col).cast("array<float>" if kind == "<f4" else "array<double>").alias("vec"),
    )
    how = keys_for(named.count(), p)
    prints = staged(named.select("id", _prints(how, p, kind)("vec").alias("f")).select("id", "f.*"), "prints")
    usable = prints.where("id IS NOT NULL AND digest IS NOT NULL")
    classes = staged(
        usable.groupBy("digest").agg(
            F.min("id").alias("first_id"), F.count("*").alias("copies"), F.first(F.struct("dim", "keys", "code", "vec")).alias("f"))
        # Read back only from the written table, where the numbers are fixed.
        .select(F.monotonically_increasing_id().alias("idx"), "digest", "first_id", "copies", "f.*"), "classes",
    )
    keyed = classes.select("dim", F.explode("keys").alias("key"), "idx", "code")
    live = staged(
        _in_blocks(keyed, p).select("dim", "key", "lo", "hi", "mine", "idx", "code")
        .mapInArrow(_with_open_pairs(p), "dim int, key long, idx long").distinct(), "live",
    )
    whole = live.join(classes.select("idx", "copies", "keys", "code", "vec"), "idx")
    found = staged(
        _in_blocks(whole, p).select("dim", "key", "lo", "hi", "mine", "idx", "copies", "keys", "code", "vec")
        .mapInArrow(_links(p, kind), "a long, b long, n long"), "links",
    )
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("idx")).agg(F.sum("n").alias("n"))
    labels = staged(components(found.where("b IS NOT NULL").select("a", "b")), "labels").withColumnRenamed("node", "idx")
    named_classes = classes.select("idx", "digest", "first_id", "copies")
    linked = labels.join(named_classes.select("idx", "first_id"), "idx")
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("least_id"))
    told = (
        named_classes.join(counts, "idx", "left")
        .join(labels.join(smallest, "root").select("idx", "least_id"), "idx", "left")
        .select("digest", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("least_id", "first_id").alias("least"))
    )
    own = F.when(F.col("id").isNotNull(), F.coalesce("least", "id"))
    mine = prints.select("id", F.when(F.col("id").isNotNull(), F.col("digest")).alias("digest"))
    return mine.join(staged(told, "told"), "digest", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"), F.coalesce(F.col("id") == own, F.lit(True)).alias("kept"),
    )
