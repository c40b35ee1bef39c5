"""Benchmark decontamination: one Aho-Corasick automaton over the word windows of benchmark items.

Texts and items are lower-cased in A-Z and reduced to words. Every window of 10 consecutive item words
(an item of fewer words is one window) is a pattern with a space at each end, so that a hit is a run of
whole words. Each text is walked once, and hits map back to code points of the text as it was.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Collection, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyarrow import fs, parquet
from pyspark.sql import DataFrame, functions as F

from gradewell.llm.common import PLAIN_WORDS, released, shared_folder, staged, with_result

WINDOW = 10
#: Characters of patterns in one automaton, some 30 bytes of memory each. Larger benchmarks are dealt
#: by a hash over several automata, with a pass over the texts for each.
PATTERN_CHARS = 4_000_000
#: Rows whose texts are Python objects at a time.
_AT_ONCE = 500

_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FOUND = pa.struct([("hits", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
_RESULT = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("contaminated", pa.bool_()), ("spans", _SPANS),
])
_DDL = {
    _FOUND: "struct<hits:array<bigint>,items:array<string>>",
    _RESULT: "struct<n_words:bigint,n_hit:bigint,items:array<string>,contaminated:boolean,spans:array<struct<start:bigint,end:bigint>>>",
}


def _joined(text: bytes | None) -> tuple[str, int]:
    """Words with one space around each, byte for character, and their number."""
    words = (text or b"").translate(PLAIN_WORDS).split()
    return f" {b' '.join(words).decode('latin-1')} ", len(words)


def windows_of(text: bytes | None, window: int = WINDOW) -> set[str]:
    """Patterns of one item; none if it has no word."""
    words = (text or b"").translate(PLAIN_WORDS).decode("latin-1").split(" ")
    words = [w for w in words if w]
    return {f" {' '.join(words[i:i + window])} " for i in range(max(1, len(words) - window + 1))} if words else set()


def patterns(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item, pattern); the id of an item without one is empty."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = sorted(windows_of(text, window))
                yield pa.RecordBatch.from_pydict(
                    {"item": pa.array([item] * len(found), pa.string()), "pattern": pa.array(found, pa.string())}
                )

    items = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col).cast("string").cast("binary")
    )
    return items.mapInArrow(cut, "item string, pattern string").distinct()


@lru_cache(maxsize=1)
def _automaton(folder: str) -> ahocorasick.Automaton | None:
    """Built once in each Python worker, from patterns in the shared folder; values are (length, words, items) of a pattern."""
    where, top = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))
    automaton = ahocorasick.Automaton()
    for found in where.get_file_info(fs.FileSelector(top)):
        if found.base_name.endswith(".parquet"):
            for batch in parquet.ParquetFile(where.open_input_file(found.path)).iter_batches(columns=["pattern", "items"]):
                for pattern, items in zip(*(c.to_pylist() for c in batch.columns)):
                    automaton.add_word(pattern, (len(pattern), pattern.count(" ") - 1, tuple(items)))
    automaton.make_automaton()
    return automaton if len(automaton) else None


def _hits(line: str, automaton: ahocorasick.Automaton) -> tuple[set[int], set[str]]:
    """Indexes of the words inside occurrences, and the items that occur."""
    hits: set[int] = set()
    items: set[str] = set()
    before, at = 0, 0
    for end, (length, n, of) in automaton.iter(line):
        start = end - length + 1
        before += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
        at = start
        hits.update(range(before, before + n))
        items.update(of)
    return hits, items


def _spans(text: bytes, hits: list[int]) -> list[dict[str, int]]:
    """Runs of hit words as code points of the original, end exclusive."""
    if not hits:
        return []
    raw = np.frombuffer(text, np.uint8)
    inside = np.frombuffer(text.translate(PLAIN_WORDS), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    which = np.asarray(hits)
    cuts = np.flatnonzero(np.diff(which) > 1)
    first, last = which[np.concatenate(([0], cuts + 1))], which[np.concatenate((cuts, [len(which) - 1]))]
    return [
        {"start": int(s), "end": int(e)} for s, e in zip(points[edges[2 * first]], points[edges[2 * last + 1]])
    ]


def _written_shards(known: DataFrame, shards: int) -> list[str]:
    """Folders of (pattern, items), one for each automaton, dealt by a hash of the pattern."""
    folders = []
    for k in range(shards):
        mine = known.where(F.pmod(F.xxhash64("pattern"), F.lit(shards)) == k)
        folders.append(shared_folder(known.sparkSession, "shard"))
        mine.groupBy("pattern").agg(F.sort_array(F.collect_set("item")).alias("items")).write.parquet(folders[-1])
    return folders


def _row(text: bytes | None, n: int, hits: Collection[int], items: Collection[str]) -> dict:
    where = sorted(hits)
    return {
        "n_words": n, "n_hit": len(where), "items": sorted(items), "contaminated": bool(where), "spans": _spans(text or b"", where)}


def _scanner(folder: str, whole: bool):
    """Result of texts by one automaton, if that is the `whole` benchmark; else its hits alone."""

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = _automaton(folder)
        for texts in released(batches):
            parts = []
            for at in range(0, max(1, len(texts)), _AT_ONCE):
                out = []
                for text in texts.slice(at, _AT_ONCE).to_pylist():
                    line, n = _joined(text)
                    hits, items = _hits(line, automaton) if automaton else ((), ())
                    out.append(_row(text, n, hits, items) if whole else {"hits": sorted(hits), "items": sorted(items)})
                parts.append(pa.array(out, _RESULT if whole else _FOUND))
            yield pa.concat_arrays(parts)

    return F.arrow_udf(scan, _DDL[_RESULT if whole else _FOUND], F.ArrowUDFType.SCALAR_ITER).asNondeterministic()


def _told(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """Result of (text, hits, items)."""
    for columns in released(batches):
        parts = []
        for at in range(0, max(1, len(columns[0])), _AT_ONCE):
            some = zip(*(c.slice(at, _AT_ONCE).to_pylist() for c in columns))
            parts.append(pa.array([_row(t, _joined(t)[1], hits or (), items or ()) for t, hits, items in some], _RESULT))
        yield pa.concat_arrays(parts)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
    pattern_chars: int = PATTERN_CHARS,
) -> DataFrame:
    """`docs` with n_words, n_hit, items, contaminated and spans (code points of the hit runs).

    A null or empty text, or one without words, has no words and no hits. Repeated rows are judged alike;
    rows with a null id too. Items that share a window are all counted. An empty benchmark hits nothing.
    Columns of `docs` with the names of results are replaced, all others stay. The patterns lie in the shared folder, from which
    tasks build their automaton; neither they nor texts pass the driver. A benchmark of up to `pattern_chars` characters
    of patterns is one automaton and one pass over the texts, without a shuffle. A larger one is a pass for each automaton, so
    that a task never holds two; the hits of each are written, and meet the texts by a hash at the end.
    """
    known = staged(patterns(benchmark, window), "patterns")
    total = known.agg(F.sum(F.length("pattern"))).first()[0] or 0
    folders = _written_shards(known, max(1, -(-total // pattern_chars)))
    names = [f.name for f in _RESULT]
    text = F.col(text_col).cast("string").cast("binary")
    if len(folders) == 1:
        return with_result(docs, _scanner(folders[0], True)(text), names)
    digest = F.unhex(F.sha2(text, 256))
    found = None
    for folder in folders:
        one = docs.where(F.col(text_col).isNotNull()).select(digest.alias("digest"), _scanner(folder, False)(text).alias("f"))
        hit = staged(one.where(F.size("f.items") > 0).select("digest", "f.*"), "hits")
        found = hit if found is None else found.unionAll(hit)
    met = found.groupBy("digest").agg(
        F.array_distinct(F.flatten(F.collect_set("hits"))).alias("hits"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    rows = docs.select(F.struct("*").alias("row"), text.alias("text"), digest.alias("digest")).join(staged(met, "met"), "digest", "left")
    told = F.arrow_udf(_told, _DDL[_RESULT], F.ArrowUDFType.SCALAR_ITER).asNondeterministic()
    own = f"_{uuid.uuid4().hex}"
    made = rows.select("row", told("text", "hits", "items").alias(own)).select("row.*", own)
    return with_result(made, F.col(own), names).drop(own)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` whose text holds no window of any item, with their own columns."""
    judged = find_contamination(docs.select(F.struct("*").alias("_row"), F.col("text")), benchmark)
    return judged.where(~F.col("contaminated")).select("_row.*")
