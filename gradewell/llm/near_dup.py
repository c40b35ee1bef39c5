"""Near-duplicate documents by SuperMinHash, bands, verification and union-find.

A document's set is its distinct 5-word shingles. Every shingle draws a random permutation of the slots and
visits them in that order with values in [0, 1), [1, 2), ...; a slot keeps its smallest value. The ranks of
one shingle are correlated, so that estimates vary less than MinHash's, and a document stops as soon as
all slots hold values below the next rank. Slots are banded; documents that share a band are candidates.
Candidates become links only when their full sets, made anew from the whole texts, are similar enough.

Documents of one set form a class, and only classes are compared. First each class is verified against the smallest class of
each of its buckets; then each that is still apart from others of a bucket against the one whose sketch agrees most. Groups of near
copies become components by that, at a few verifications a member. Then all pairs that share a bucket, are still in different
components and may be similar are verified, so that no link between components is lost. Sketches are compared in
blocks of bounded size, and only across components. What passes the sketch must also pass a bound that never errs: sets are kept as parities of hashed bits, and as many
shingles differ, at least, as parities do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from gradewell.llm.common import integers, released, staged
from gradewell.llm.components import components

SLOTS = 128
_GOLDEN = 0x9E3779B97F4A7C15
_WORD = (1 << 64) - 1
#: Odd factors of the words of a shingle.
_FOLD = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)


@dataclass(frozen=True)
class NearDup:
    """Two texts of similarity 0.75 miss all of 32 bands of 4 slots once in 190,000 times."""

    words: int = 5
    percent: int = 75
    rows: int = 4
    #: Share of the sketch's bytes, one of each slot, that must agree before sets are compared: five standard
    #: deviations below the similarity asked for. With 0 every pair that shares a band is decided by exact bound and full sets.
    least_agreeing: float = 0.56
    #: Members of a bucket in one block of comparisons.
    block: int = 512


DEFAULT = NearDup()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """Hashes of words seen by this worker; forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 100_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def shingles(text: bytes | None, words: int = DEFAULT.words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; fewer words than that are one shingle."""
    found = (text or b"").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
    n = max(1, len(found) - words + 1)
    parts = min(words, len(found))
    folded = np.full(n, parts * _GOLDEN & _WORD, np.uint64)
    for i in range(parts):
        folded += hashes[i:i + n] * np.uint64(_FOLD[i % 5] + 2 * (i // 5))
    return np.unique(_mix(folded))


def superminhash(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures, one row of SLOTS values for each of the sets, none of which is empty."""
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    out = np.full((len(sets), SLOTS), SLOTS + 1.0)
    flat, base = out.reshape(-1), owner * SLOTS
    slots_of = rows = None
    for rank in range(SLOTS):
        drawn = _mix(elements + np.uint64((2 * rank + 1) * _GOLDEN & _WORD))
        value = (drawn >> np.uint64(11)) * 2.0**-53 + rank
        at = rank + (((drawn * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)) * np.uint64(SLOTS - rank) >> np.uint64(32)).astype(np.int64)
        if rank == 0:
            slot = at
        else:
            slot = slots_of[rows, at]
            slots_of[rows, at] = slots_of[rows, rank]
        np.minimum.at(flat, base + slot, value)
        open_sets = out.max(axis=1) >= rank + 1
        if not open_sets.any():
            break
        live = open_sets[owner]
        if rank == 0:
            elements, owner, base, at = elements[live], owner[live], base[live], at[live]
            rows = np.arange(len(elements))
            slots_of = np.tile(np.arange(SLOTS, dtype=np.uint8), (len(elements), 1))
            slots_of[rows, at] = 0
        elif live.mean() < 0.7:
            elements, owner, base, slots_of = elements[live], owner[live], base[live], slots_of[live]
            rows = np.arange(len(elements))
    return out


def bands_and_sketches(signatures: np.ndarray, p: NearDup = DEFAULT) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit key for each band (its number is part of it), and a byte for each slot."""
    bits = _mix(signatures.view(np.uint64))
    keys = np.zeros((len(bits), SLOTS // p.rows), np.uint64) + np.arange(SLOTS // p.rows, dtype=np.uint64) * np.uint64(_GOLDEN)
    for i in range(p.rows):
        keys = _mix(keys ^ bits[:, i::p.rows])
    return keys.view(np.int64), (bits & np.uint64(0xFF)).astype(np.uint8)


def parities(found: np.ndarray) -> bytes:
    """Whether an odd number of shingles falls on a bit; at least twice as many bits as shingles, a power of two."""
    bits = max(64, 1 << int(2 * len(found) - 1).bit_length())
    return np.packbits(np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).tobytes()


class Parities:
    """The parities of a group's sets, each also in half the bits; sets of similar sizes differ by one halving at most."""

    def __init__(self, sets: list[bytes]):
        self.size = np.array([len(s) for s in sets])
        own = [np.frombuffer(s, np.uint8) for s in sets]
        self.at: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in set(self.size.tolist()) | {s // 2 for s in self.size.tolist()}:
            rows = np.flatnonzero((self.size == size) | (self.size == 2 * size))
            made = [own[i] if len(own[i]) == size else own[i][:size] ^ own[i][size:] for i in rows]
            place = np.full(len(sets), -1)
            place[rows] = np.arange(len(rows))
            self.at[size] = place, np.array(made, np.uint8)

    def differing(self, i: int, which: np.ndarray) -> np.ndarray:
        """How many shingles of row i and of each other differ, at least; 0 if the sizes are too far apart."""
        out = np.zeros(len(which), np.int64)
        for size in (self.size[i], self.size[i] // 2):
            place, rows = self.at[size]
            both = np.minimum(self.size[which], self.size[i]) == size
            both &= (place[which] >= 0) & (place[i] >= 0)
            if both.any():
                out[both] = np.bitwise_count(rows[place[which[both]]] ^ rows[place[i]]).sum(axis=1)
        return out


_FINGERPRINT = "struct<n_shingles:bigint,set_key:binary,bands:array<bigint>,sketch:binary,parities:binary>"
#: Shingles in one call of superminhash; the permutations of so many fit the processor's cache.
_AT_ONCE = 50_000


def _fingerprints(p: NearDup):
    kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary())
    names = ("n_shingles", "set_key", "bands", "sketch", "parities")

    def of(texts: pa.Array) -> pa.Array:
        size, key, bands, sketch, parity = ([] for _ in names)
        group: list[tuple[int, np.ndarray]] = []

        def flush() -> None:
            if group:
                keys, sketches = bands_and_sketches(superminhash([s for _, s in group]), p)
                for (i, s), k, sk in zip(group, keys, sketches):
                    key[i], bands[i] = xxhash.xxh3_128_digest(s.tobytes()), k
                    sketch[i], parity[i] = sk.tobytes(), parities(s)
                group.clear()

        held = 0
        for i, text in enumerate(texts):
            found = shingles(text.as_py(), p.words)
            for column, value in ((size, len(found)), (key, None), (bands, []), (sketch, None), (parity, None)):
                column.append(value)
            if len(found):
                group.append((i, found))
                held += len(found)
                if held >= _AT_ONCE:
                    flush()
                    held = 0
        flush()
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip((size, key, bands, sketch, parity), kinds)], names)

    def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in released(batches):
            # Few rows at a time, so that only their results are Python objects.
            parts = [of(texts.slice(at, 1_000)) for at in range(0, len(texts), 1_000)]
            yield pa.concat_arrays(parts or [of(texts)])

    return F.arrow_udf(fingerprints, _FINGERPRINT, F.ArrowUDFType.SCALAR_ITER).asNondeterministic()


def _similar(p: NearDup):
    """Of (a, text_a, b, text_b) the pairs whose full sets are similar."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = lru_cache(maxsize=16)(lambda text: shingles(text, p.words))
        for batch in released(batches):
            links = []
            for a, text_a, b, text_b in zip(*batch.columns):
                a, b = a.as_py(), b.as_py()
                set_a, set_b = full(text_a.as_py()), full(text_b.as_py())
                common = len(set_a) + len(set_b) - len(np.union1d(set_a, set_b))
                if 100 * common >= p.percent * (len(set_a) + len(set_b) - common):
                    links.append((a, b))
            yield _edges(links)

    return verify


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())
    })


def _verified(pairs: DataFrame, texts: DataFrame, p: NearDup) -> DataFrame:
    """Links among `pairs` (a, b); b's texts are moved first, once, and then meet those of a."""
    side = lambda c: texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))
    met = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "text_a", "b", "text_b")
    return met.mapInArrow(_similar(p), "a long, b long")


def _batches_of(pairs: Iterator[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """The different pairs, as far as some thousands at a time tell."""
    held: set[tuple[int, int]] = set()
    for pair in pairs:
        held.add(pair)
        if len(held) >= 50_000:
            yield _edges(list(held))
            held.clear()
    yield _edges(list(held))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in released(batches):
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _agreeing(p: NearDup):
    """Of (a, sketch_a, b, sketch_b) the pairs whose sketches agree enough."""

    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SLOTS) for i in (1, 3))
            like = pa.array((one == two).mean(axis=1) >= p.least_agreeing)
            yield pa.RecordBatch.from_pydict({"a": batch.column(0), "b": batch.column(2)}).filter(like)

    return agreeing


def _with_representatives(shared: DataFrame, sketches: DataFrame, p: NearDup) -> DataFrame:
    """Pairs (a, b) of each class with the smallest one of each of its buckets, where sizes and sketches allow a link.

    As many pairs as a class has different representatives, one for a group of near copies: linear in the classes.
    """
    pairs = shared.where("node <> rep").select("node", "rep").distinct()
    side = lambda c: sketches.select(*[F.col(x).alias(f"{x}_{c}") for x in ("node", "n_shingles", "sketch")])
    met = pairs.join(side("a"), F.col("node") == F.col("node_a")).join(side("b"), F.col("rep") == F.col("node_b"))
    close = met.where(100 * F.least("n_shingles_a", "n_shingles_b") >= p.percent * F.greatest("n_shingles_a", "n_shingles_b"))
    return close.select("node_a", "sketch_a", "node_b", "sketch_b").mapInArrow(_agreeing(p), "a long, b long")


def _open(p: NearDup, best: bool):
    """Pairs (a, b) of different components that may be linked, of groups of residents and visitors that come group by group.

    `best` gives for each visitor the resident only whose sketch agrees most.
    """

    def pairs_of(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        here = np.flatnonzero([not r[0] for r in rows])
        visitors = np.flatnonzero([r[0] for r in rows])
        if not len(here) or not len(visitors):
            return
        node, comp, n, minor = (np.array([r[i] for r in rows]) for i in range(1, 5))
        sketch = np.frombuffer(b"".join(r[5] for r in rows), np.uint8).reshape(len(rows), -1)
        kept: Parities | None = None
        for i in visitors:
            # Two of the smaller components meet twice; once counts.
            rest = here[(comp[here] != comp[i]) & (~minor[here] | (node[here] < node[i]) | best)]
            rest = rest[100 * np.minimum(n[rest], n[i]) >= p.percent * np.maximum(n[rest], n[i])]
            share = (sketch[rest] == sketch[i]).mean(axis=1)
            rest, share = rest[share >= p.least_agreeing], share[share >= p.least_agreeing]
            if not len(rest):
                continue
            if best:
                rest = rest[[share.argmax()]]
            kept = kept or Parities([r[6] for r in rows])
            both = n[rest] + n[i]
            common = (both - kept.differing(i, rest)) // 2  # at most
            for j in rest[100 * common >= p.percent * (both - common)]:
                yield int(max(node[i], node[j])), int(min(node[i], node[j]))

    def open_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = groupby(_rows(batches), key=lambda r: r[:3])
        yield from _batches_of(pair for _, group in groups for pair in pairs_of([r[3:] for r in group]))

    return open_pairs


def _open_pairs(shared: DataFrame, labels: DataFrame, sketches: DataFrame, p: NearDup, best: bool = False) -> DataFrame:
    """Pairs (a, b) that share a bucket, are in different components and pass sketch and bound; or the `best` of a class in each group.

    In every bucket the largest component only receives: its members are residents of blocks, once each. Members of the others are
    residents too and besides visit every block, themselves cut into blocks, so each two classes of different components meet
    in one group of at most twice `p.block` rows. A bucket that is one component but for a few costs its size, not its square.
    """
    labelled = staged(shared.join(labels, "node", "left").select("key", "node", F.coalesce("root", "node").alias("comp")), "labelled")
    counted = labelled.groupBy("key", "comp").agg(F.count("*").alias("size"))
    mixed = counted.groupBy("key").agg(
        F.sum("size").alias("all"), F.max("size").alias("largest"), F.max_by("comp", F.struct("size", "comp")).alias("major"),
    ).where(F.col("all") > F.col("largest")).select(
        "key", "major", F.ceil(F.col("all") / p.block).cast("int").alias("blocks"),
        F.ceil((F.col("all") - F.col("largest")) / p.block).cast("int").alias("visits"),
    )
    members = labelled.join(staged(mixed, "mixed"), "key").join(sketches, "node")
    minor, home = F.col("comp") != F.col("major"), F.xxhash64("node")
    block, visit = F.pmod(home, "blocks").cast("int"), F.pmod(home, "visits").cast("int")
    place = lambda b, v, visiting: F.struct(b.alias("block"), v.alias("visit"), F.lit(visiting).alias("visiting"))
    resides = F.transform(F.sequence(F.lit(0), F.col("visits") - 1), lambda v: place(block, v, False))
    visits = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: place(b, visit, True))
    met = members.withColumn("at", F.explode(F.when(minor, F.concat(resides, visits)).otherwise(resides))).select(
        "key", "at.block", "at.visit", "at.visiting", "node", "comp", "n_shingles", minor.alias("minor"), "sketch", "parities")
    dealt = met.repartition("key", "block", "visit").sortWithinPartitions("key", "block", "visit")
    return staged(dealt.mapInArrow(_open(p, best), "a long, b long").distinct(), "pairs")


def _known(labels: DataFrame) -> DataFrame:
    """What labels tell as edges."""
    return labels.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))


def near_duplicates(
    docs: DataFrame, p: NearDup = DEFAULT, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of `docs`: the id (long), n_shingles, class_id, component_id and kept.

    class_id is the smallest id with the same set, component_id the smallest id that links reach. Texts without
    words, null ones too, are linked with nothing: both are the own id. A row without an id takes part in no link;
    its component is null and it is kept. Rows that share an id are one document: what any of their texts is
    linked with is one component. Ids are integers; others raise ValueError. Other columns of `docs` are not read. An empty
    table gives an empty one.
    """
    named = docs.select(integers(docs, id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    prints = staged(named.select("id", _fingerprints(p)("text").alias("f")).select("id", "f.*"), "fingerprints")
    usable = prints.where("id IS NOT NULL AND set_key IS NOT NULL")
    classes = staged(
        usable.groupBy("set_key").agg(F.min("id").alias("node"), F.first(F.struct("n_shingles", "bands", "sketch", "parities")).alias("f"))
        .select("node", "set_key", "f.*"), "classes",
    )
    banded = classes.select("node", F.explode("bands").alias("key"))
    sizes = staged(
        banded.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("rep")).where("size > 1").select("key", "rep"), "sizes",
    )
    shared = staged(banded.join(sizes, "key"), "shared")
    sketches = classes.select("node", "n_shingles", "sketch", "parities")
    needed = shared.select("node").distinct()
    texts = staged(named.join(needed, F.col("id") == F.col("node")).select("node", "text"), "texts")

    first = staged(_with_representatives(shared, sketches, p), "pairs")
    links = staged(_verified(first, texts, p), "links")  # one Python worker a task, not two
    labels = staged(components(links), "labels")
    nearest = staged(_verified(_open_pairs(shared, labels, sketches, p, best=True), texts, p), "nearest")
    labels = staged(components(_known(labels).unionAll(nearest)), "labels")
    more = staged(_verified(_open_pairs(shared, labels, sketches, p), texts, p), "more")

    # Texts of one id are one document, so their classes are linked as well.
    several = usable.groupBy("id").agg(F.min("set_key").alias("lo"), F.max("set_key").alias("hi")).where("lo <> hi").select("id")
    same = usable.join(staged(several, "several"), "id").join(classes.select("set_key", "node"), "set_key")
    labels = components(_known(labels).unionAll(more).unionAll(same.select(F.col("id").alias("a"), F.col("node").alias("b"))))
    found = classes.select("node", "set_key").join(staged(labels, "labels"), "node", "left")
    found = staged(found.select("set_key", "node", F.coalesce("root", "node").alias("root")), "found")
    own = F.when(F.col("set_key").isNotNull(), F.col("root")).otherwise(F.col("id"))
    return prints.select("id", "n_shingles", "set_key").join(found, "set_key", "left").select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(F.col("id").isNotNull(), F.coalesce("node", "id")).alias("class_id"),
        F.when(F.col("id").isNotNull(), own).alias("component_id"),
        F.coalesce(F.col("id") == own, F.lit(True)).alias("kept"),
    )
