"""Toxicity by compression distance: two Zstandard dictionaries, and how much shorter one makes a window.

Both dictionaries end in the same words, the commonest of ordinary text. Before these the toxic one holds pieces of
words that stand in toxic texts and hardly in ordinary ones, chosen so that they cover the toxic texts; the ordinary
one holds as many bytes of rare ordinary words. A text is cut into windows, each is compressed with either dictionary,
and the differences of the lengths, whose only cause are those pieces, are the evidence. Each window stands behind
a piece of the common words, so that it is compressed at all and not stored as it is. A logistic
curve over four summaries of the differences is fitted to the labels and gives the score; its threshold is a half.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from gradewell.llm.common import released, staged, with_result


@dataclass(frozen=True)
class Toxicity:
    """The model is fitted on the whole texts of at most `per_label` labelled ids of each label."""

    per_label: int = 3_000
    window: int = 96
    level: int = 7
    common_bytes: int = 12_000
    context_bytes: int = 64
    #: A piece must be over-represented by so many standard errors and so many times.
    deviations: float = 4.0
    times: float = 4.0
    sizes: tuple[int, ...] = (5, 6, 7)
    #: Each toxic text is covered by so many pieces; a piece must add cover in so many texts.
    cover: int = 3
    least_cover: int = 3
    #: Pieces among which the cover is chosen: those that most toxic texts hold. Bounds what reaches the driver.
    most_pieces: int = 5_000
    #: Weight that holds the logistic curve's coefficients down.
    ridge: float = 1.0
    fold_every: int = 5


DEFAULT = Toxicity()


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]  # of the summaries, the last one alone
    window: int
    level: int
    context: int


def held_out(doc_id: Column, every: int = DEFAULT.fold_every) -> Column:
    """Rows that no label is learned from: crc32 of the id as text divides by `every`; without an id, also these."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % every == 0, F.lit(True))


def _lower(text: bytes) -> bytes:
    """Lower case by Unicode, for training and scoring alike; bytes that are no UTF-8 stay."""
    if text.isascii():
        return text.lower()
    return text.decode("utf-8", "surrogateescape").lower().encode("utf-8", "surrogateescape")


def _clean(text: bytes | None) -> bytes:
    return b" " + b" ".join(_lower(text or b"").split()) + b" "


def windows(text: bytes, size: int) -> Iterator[bytes]:
    """The whole text in turn, cut at spaces where there are any in a window's second half."""
    at = 0
    while at < len(text):
        end = min(len(text), at + size)
        if end < len(text) and (space := text.rfind(b" ", at + size // 2, end)) > 0:
            end = space
        yield text[at:end]
        at = end


class _Scorer:
    def __init__(self, model: Model):
        self.window, self.context = model.window, model.toxic[len(model.toxic) - model.context:]
        self.packers = []
        for content in (model.ordinary, model.toxic):
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(model.level)
            self.packers.append(zstandard.ZstdCompressor(
                level=model.level, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False,
            ).compress)

    def summary(self, text: bytes | None) -> tuple[float, float, float, float]:
        """Largest gain of the toxic dictionary, mean of the three largest, mean gain, share of windows that gain."""
        ordinary, toxic = self.packers
        context = self.context
        clean = _clean(text)
        if len(clean) <= 2:
            return 0.0, 0.0, 0.0, 0.0
        framed = (context + w for w in windows(clean, self.window))
        gains = sorted((len(ordinary(w)) - len(toxic(w)) for w in framed), reverse=True)
        top = gains[:3]
        return float(top[0]), sum(top) / 3, sum(gains) / len(gains), sum(g >= 2 for g in gains) / len(gains)


#: Bytes of a text, and different pieces or words of a task, that are held as numbers at a time.
BLOCK, HELD = 1 << 20, 1 << 20
#: The dictionaries of a fit: those that halves 0 and 1 of the sample are scored with, and those of the whole sample.
FITS = 3


def _teaching(rows: list, toxic: int) -> dict[str, list[int]]:
    """Digests of the texts of one label, and which dictionaries each teaches: of texts with the same smallest word
    hash, copies that differ a little, only the first one does."""
    group = [r for r in rows if r["toxic"] == toxic]
    out: dict[str, list[int]] = {}
    for fit in range(FITS):
        learnt = [r for r in group if fit == FITS - 1 or r["half"] != fit] or group
        first: dict[int, str] = {}
        for r in learnt:
            if r["least"] is not None:
                first.setdefault(r["least"], r["digest"])
        for digest in first.values():
            out.setdefault(digest, []).append(fit)
    return out


def _grams(text: bytes, n: int) -> np.ndarray:
    """Different pieces of words of n bytes as numbers; a space stands in the first place only."""
    found = [np.zeros(0, np.uint64)]
    for at in range(0, max(0, len(text) - n + 1), BLOCK):
        raw = np.frombuffer(text[at:at + BLOCK + n - 1], np.uint8).astype(np.uint64)
        value, plain = np.zeros(len(raw) - n + 1, np.uint64), np.ones(len(raw) - n + 1, bool)
        for i in range(n):
            part = raw[i:len(raw) - n + 1 + i]
            value = (value << np.uint64(8)) | part
            if i:
                plain &= part != 0x20
        found.append(np.unique(value[plain]))
    return np.unique(np.concatenate(found))


def _gram_counts(teaching: tuple[dict, dict], sizes: tuple[int, ...]):
    """For mapInArrow: how many texts of each label and fit hold each piece, in parts to be summed."""
    def counted(held: dict) -> Iterator[pa.RecordBatch]:
        for n in sizes:
            mine = {k[1:]: np.concatenate(v) for k, v in held.items() if k[0] == n}
            if mine:
                gram = np.unique(np.concatenate(list(mine.values())))
                columns = {"n": np.full(len(gram), n, np.int32), "gram": gram.view(np.int64)}
                for label in (0, 1):
                    for fit in range(FITS):
                        count = np.zeros(len(gram), np.int64)
                        value, times = np.unique(mine.get((label, fit), gram[:0]), return_counts=True)
                        count[np.searchsorted(gram, value)] = times
                        columns[f"c{label}{fit}"] = count
                whole = pa.RecordBatch.from_pydict(columns)
                yield from (whole.slice(at, 50_000) for at in range(0, len(gram), 50_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in released(batches):
            for toxic, digest, text in zip(*(batch.column(c) for c in ("toxic", "digest", "text"))):
                fits = teaching[toxic.as_py()].get(digest.as_py(), ())
                for n in sizes if fits else ():
                    grams = _grams(text.as_py(), n)
                    size += len(grams) * len(fits)
                    for fit in fits:
                        held.setdefault((n, toxic.as_py(), fit), []).append(grams)
                if size > 8 * HELD:
                    yield from counted(held)
                    held, size = {}, 0
        yield from counted(held)

    return run


def _contrasted(sample: DataFrame, teaching: tuple[dict, dict], sizes: list[tuple[int, int]], p: Toxicity) -> list[list[bytes]]:
    """For each fit the pieces of words that toxic texts hold far more often, in a fixed order; `sizes` are the numbers
    of ordinary and of toxic texts that teach."""
    counts = [f"c{label}{fit}" for label in (0, 1) for fit in range(FITS)]
    parts = sample.select("toxic", "digest", "text").mapInArrow(
        _gram_counts(teaching, p.sizes), "n int, gram long, " + ", ".join(f"{c} long" for c in counts)
    )
    total = parts.groupBy("n", "gram").agg(*(F.sum(c).alias(c) for c in counts))
    tells = []
    for fit, (ordinary, toxic) in enumerate(sizes):
        if not ordinary or not toxic:
            tells.append(F.lit(False))
            continue
        count, against = F.col(f"c1{fit}"), F.col(f"c0{fit}")
        mean = (count + against) / (toxic + ordinary)
        error = F.sqrt(mean * (1 - mean) * (1 / toxic + 1 / ordinary)) + 1e-12
        more = (count / toxic - against / ordinary) >= p.deviations * error
        tells.append((count > 0) & more & (count / toxic >= p.times * (against + 0.5) / ordinary))
    told = staged(total.select(
        "n", "gram", *(t.alias(f"t{fit}") for fit, t in enumerate(tells)), *(f"c1{fit}" for fit in range(FITS)),
    ).where("t0 OR t1 OR t2"), "pieces")
    most = [
        told.where(f"t{fit}").orderBy(F.desc(f"c1{fit}"), F.desc("n"), "gram").limit(p.most_pieces).collect() for fit in range(FITS)
    ]
    return [sorted((int(r["gram"]) % 2**64).to_bytes(r["n"], "big") for r in rows) for rows in most]


def _holding(sample: DataFrame, teaching: dict, pieces: list[list[bytes]]) -> list[np.ndarray]:
    """For each fit a table of pieces by toxic texts that teach: does the text hold the piece? A bit each reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            rows = []
            for digest, text in zip(batch.column("digest").to_pylist(), batch.column("text")):
                for fit in teaching.get(digest, ()):
                    whole = text.as_py()
                    held = np.packbits(np.array([g in whole for g in pieces[fit]], bool))
                    rows.append({"digest": digest, "fit": fit, "held": held.tobytes()})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("digest", pa.string()), ("fit", pa.int32()), ("held", pa.binary())]))

    found = sample.where("toxic = 1").select("digest", "text").mapInArrow(run, "digest string, fit int, held binary").collect()
    tables = []
    for fit in range(FITS):
        rows = sorted((r["digest"], r["held"]) for r in found if r["fit"] == fit)
        table = np.zeros((len(pieces[fit]), len(rows)), bool)
        for k, (_, held) in enumerate(rows):
            table[:, k] = np.unpackbits(np.frombuffer(held, np.uint8), count=len(pieces[fit])).astype(bool)
        tables.append(table)
    return tables


def _covering(pieces: list[bytes], held: np.ndarray, p: Toxicity) -> list[bytes]:
    """Pieces taken one by one for the texts that need them most, until a piece adds too little."""
    order = sorted(range(len(pieces)), key=lambda i: (-len(pieces[i]), pieces[i]))
    if not pieces:
        return []
    pieces, held = [pieces[i] for i in order], held[order]
    need, worth = np.full(held.shape[1], p.cover), np.array([len(g) - 2 for g in pieces])
    taken: list[bytes] = []
    while True:
        useful = (held & (need > 0)).sum(axis=1)
        k = int((useful * worth).argmax())
        if useful[k] < p.least_cover:
            return taken
        taken.append(pieces[k])
        need = need - held[k]
        for j, g in enumerate(pieces):
            if g in pieces[k] or pieces[k] in g:
                held[j] = False


def _filled(words: list[bytes], size: int) -> bytes:
    out = b""
    for word in words:
        if len(out) >= size:
            break
        if b" " + word not in out:
            out = b" " + word + out
    return out[:size]


def _word_counts(teaching: dict, longest: int):
    """For mapInArrow: how many ordinary texts of each fit hold each word, in parts to be summed. Of a word longer than
    a window only so much can be met in one."""
    def counted(held: list[Counter]) -> Iterator[pa.RecordBatch]:
        words = list(set().union(*held))
        for at in range(0, len(words), 50_000):
            part = words[at:at + 50_000]
            yield pa.RecordBatch.from_pydict(
                {"word": pa.array(part, pa.binary())} | {f"c{fit}": pa.array([c[w] for w in part], pa.int64()) for fit, c in enumerate(held)}
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Counter() for _ in range(FITS)]
        for batch in released(batches):
            for digest, text in zip(batch.column("digest").to_pylist(), batch.column("text")):
                if fits := teaching.get(digest, ()):
                    words = {w[:longest] for w in text.as_py().split() if len(w) > 2}
                    for fit in fits:
                        held[fit].update(words)
                if sum(map(len, held)) > HELD:
                    yield from counted(held)
                    held = [Counter() for _ in range(FITS)]
        yield from counted(held)

    return run


def _dictionaries(sample: DataFrame, rows: list, p: Toxicity) -> list[tuple[bytes, bytes]]:
    """For each fit the contents of the toxic and the ordinary dictionary, equally long.

    Texts stay in the tasks: what reaches the driver are counts of pieces and words that the dictionaries may take.
    """
    teaching = _teaching(rows, 0), _teaching(rows, 1)
    sizes = [tuple(sum(fit in fits for fits in t.values()) for t in teaching) for fit in range(FITS)]
    pieces = _contrasted(sample, teaching, sizes, p)
    held = _holding(sample, teaching[1], pieces)
    parts = sample.where("toxic = 0").select("digest", "text").mapInArrow(
        _word_counts(teaching[0], p.window), "word binary, " + ", ".join(f"c{fit} long" for fit in range(FITS))
    )
    words = staged(parts.groupBy("word").agg(*(F.sum(f"c{fit}").alias(f"c{fit}") for fit in range(FITS))), "words")
    out = []
    for fit in range(FITS):
        own = b"".join(reversed(_covering(pieces[fit], held[fit], p)))
        seen = words.where(F.col(f"c{fit}") > 0)
        # A word takes four bytes or more.
        often = seen.orderBy(F.desc(f"c{fit}"), "word").limit(p.common_bytes).collect()
        rare = seen.orderBy(f"c{fit}", F.desc("word")).limit(len(own)).collect() if own else []
        common = _filled([bytes(r["word"]) for r in often], p.common_bytes)
        out.append((own + common, _filled([bytes(r["word"]) for r in rare], len(own)).ljust(len(own)) + common))
    return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Newton's method; classes weigh as they come."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    hold = np.diag([ridge] * (x.shape[1] - 1) + [1e-3])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + hold, x.T @ (y - q) - hold @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training texts made ready: digest, half of the sample, smallest word hash and the cleaned text."""
    for batch in released(batches):
        for toxic, text in zip(batch.column("toxic"), batch.column("text")):
            low = _lower(text.as_py())
            words = set(low.split())
            least = min(map(xxhash.xxh3_64_intdigest, words)) >> 1 if words else None
            yield pa.RecordBatch.from_pydict({
                "toxic": pa.array([toxic.as_py()], pa.int32()), "digest": [xxhash.xxh3_128_hexdigest(low)],
                "half": pa.array([(zlib.crc32(low) >> 4) % 2], pa.int32()), "least": pa.array([least], pa.int64()),
                "text": pa.array([_clean(low)], pa.binary()),
            })


def _sampled(docs: DataFrame, known: DataFrame, p: Toxicity) -> DataFrame:
    """Different whole texts by label, of a bounded sample of ids that does not depend on partitions: those of the
    smallest hashes. A written table."""
    picked = [
        known.where(F.col("toxic") == label).orderBy(F.xxhash64("id"), "id").limit(p.per_label) for label in (0, 1)
    ]
    # Twice per_label ids at most, and one text of each.
    ids = F.broadcast(picked[0].unionAll(picked[1]))
    texts = docs.join(ids, "id").groupBy("id", "toxic").agg(F.min("text").alias("text")).where("text IS NOT NULL")
    made = texts.select("toxic", F.col("text").cast("binary").alias("text")).mapInArrow(
        _prepared, "toxic int, digest string, half int, least long, text binary"
    )
    dealt = made.repartition(docs.sparkSession.sparkContext.defaultParallelism, "toxic", "digest")
    return staged(dealt.dropDuplicates(["toxic", "digest"]), "sample")


def _summaries(sample: DataFrame, models: list[Model]) -> list:
    """Label and summary of every text, scored by the model of its half, in a fixed order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [_Scorer(m) for m in models]
        for batch in released(batches):
            columns = [batch.column(c).to_pylist() for c in ("toxic", "digest", "half")]
            made = [list(scorers[half].summary(t.as_py())) for half, t in zip(columns[2], batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.string()), pa.array(made, pa.list_(pa.float64()))],
                ["toxic", "digest", "x"],
            )

    rows = sample.select("toxic", "digest", "half", "text").mapInArrow(run, "toxic int, digest string, x array<double>").collect()
    return sorted(rows, key=lambda r: (r["toxic"], r["digest"]))


def train(docs: DataFrame, labels: DataFrame, p: Toxicity = DEFAULT, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model, from a bounded sample of the labelled rows that are not held out, each in whole length.

    Rows without a label, an id or a text teach nothing; an id of two labels teaches with each, one of several texts with one. The curve is
    fitted to each half of the sample by dictionaries of the other, so to gains like those of unseen texts; the
    dictionaries kept are of the whole sample.
    Without any text of one label every score is the share of toxic labels, or a half if there is no label.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1)).select(
        F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic")
    )
    known = known.where(~held_out(F.col("id"), p.fold_every)).distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sample = _sampled(texts, known, p)
    rows = sorted(sample.select("toxic", "digest", "half", "least").collect(), key=lambda r: (r["toxic"], r["digest"]))
    toxic = sum(r["toxic"] for r in rows)
    ordinary = len(rows) - toxic
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not toxic or not ordinary:
        share = (toxic + 0.5) / (len(rows) + 1)
        return Model(b" " * 8, b" " * 8, (0.0,) * 4 + (float(np.log(share / (1 - share))),), p.window, p.level, p.context_bytes)
    fits = [Model(*d, (0.0,) * 5, p.window, p.level, p.context_bytes) for d in _dictionaries(sample, rows, p)]
    unseen = _summaries(sample, fits[:2])
    weights = _logistic(np.array([r["x"] for r in unseen]), np.array([float(r["toxic"]) for r in unseen]), p.ridge)
    # The sample holds the labels in other shares than all labelled rows.
    weights[-1] += np.log(counts[1] / toxic) - np.log(counts[0] / ordinary)
    return replace(fits[2], weights=tuple(map(float, weights)))


@lru_cache(maxsize=2)
def _scorer(key: str, of: Broadcast) -> _Scorer:
    return _Scorer(of.value)


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 from a half on); nothing but the text is used.

    A null or empty text has no windows and gets the curve's value at no gain. Every row is scored by itself, in whole
    length. Columns named score or predicted are replaced. No shuffle; the broadcast model is some 30 kB.
    """
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer, weights = _scorer(key, shared), np.array(shared.value.weights)
        for texts in released(batches):
            x = np.array([scorer.summary(t.as_py()) for t in texts]).reshape(-1, 4)
            yield pa.array(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))))

    made = F.arrow_udf(score, "double", F.ArrowUDFType.SCALAR_ITER).asNondeterministic()
    scored = with_result(docs, F.struct(made(F.col(text_col).cast("string").cast("binary")).alias("score")), ["score"])
    return scored.select(*(c for c in scored.columns if c != "predicted"), F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
