"""Fill-in-the-middle by a wavelet matrix over character classes.

A text is cut between units: runs of letters A-Z, a-z, and every other character. Each byte of the UTF-8 text has one of four classes:
inside a character, a character that is no letter, a letter that begins a run, a letter inside a run. A wavelet matrix over
the classes of many texts at once, laid end to end, answers how often a class occurs before a byte (rank). Units before
a byte are the ranks of two classes together, code points those of three; the byte where a unit begins is found
by bisection on such ranks, for all texts at the same time. Texts are cut in their bytes and never become lists of units.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gradewell.llm.common import integers, released, with_result

#: Marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
INSIDE, OTHER, FIRST, LETTER = range(4)


@dataclass(frozen=True)
class FillMiddle:
    seed: int = 1
    #: Share of texts that are cut, and of those the share whose suffix comes first.
    percent: int = 90
    suffix_first: int = 20
    #: Bytes of texts under one matrix; a longer text has a matrix of its own.
    at_once: int = 4 << 20


DEFAULT = FillMiddle()
FIELDS = ["n", "form", "prefix_chars", "middle_chars", "output"]


def classes(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Class of every byte; at `begins` a text begins, so no run goes on there."""
    lower = data | 0x20
    letter = (lower >= ord("a")) & (lower <= ord("z")) & (data < 0x80)
    out = np.where(data & 0xC0 == 0x80, INSIDE, OTHER).astype(np.uint8)
    goes_on = np.zeros(len(data), bool)
    goes_on[1:] = letter[:-1]
    goes_on[begins[begins < len(data)]] = False
    out[letter] = FIRST
    out[letter & goes_on] = LETTER
    return out


class Bits:
    """A row of bits that tells how many of its first `i` are set: counts before every eighth byte, and the bytes between."""

    WORD = 64

    def __init__(self, bits: np.ndarray):
        self.words = np.packbits(np.pad(bits, (0, -len(bits) % self.WORD + self.WORD)), bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def rank(self, i: np.ndarray) -> np.ndarray:
        word, rest = i // self.WORD, (i % self.WORD).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << rest) - np.uint64(1)))


class WaveletMatrix:
    """Symbols of a few bits, kept as a row of bits for each bit from the highest; zeros go before ones in the next row."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.rows: list[tuple[Bits, int]] = []
        for bit in reversed(range(bits)):
            ones = symbols >> bit & 1
            self.rows.append((Bits(ones), len(ones) - int(ones.sum())))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbol: int, i: np.ndarray) -> np.ndarray:
        """How many of the first `i` symbols are this one."""
        begin, end = np.zeros_like(i), i
        for depth, (bits, zeros) in enumerate(self.rows):
            ones_begin, ones_end = bits.rank(begin), bits.rank(end)
            if symbol >> (len(self.rows) - 1 - depth) & 1:
                begin, end = zeros + ones_begin, zeros + ones_end
            else:
                begin, end = begin - ones_begin, end - ones_end
        return end - begin


class Units:
    """Units and code points before the bytes of texts that lie end to end."""

    def __init__(self, data: np.ndarray, begins: np.ndarray):
        self.matrix = WaveletMatrix(classes(data, begins), 2)

    def before(self, i: np.ndarray) -> np.ndarray:
        return self.matrix.rank(OTHER, i) + self.matrix.rank(FIRST, i)

    def chars_before(self, i: np.ndarray) -> np.ndarray:
        return i - self.matrix.rank(INSIDE, i)

    def cut(self, begin: np.ndarray, end: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Byte after the first `units` units of each text [begin, end): where the next unit begins, or the end."""
        wanted = self.before(begin) + units
        # Largest byte with no more units before it: all of the last unit, and nothing of the next.
        low, high = begin.copy(), end.copy()
        while (open_ends := low < high).any():
            middle = (low + high + 1) // 2
            fits = self.before(middle) <= wanted
            low = np.where(open_ends & fits, middle, low)
            high = np.where(open_ends & ~fits, middle - 1, high)
        return low


def draws(seed: int, name: int) -> tuple[int, int, int, int]:
    told = sha256(b"%d:%d" % (seed, name)).hexdigest()
    return tuple(int(told[i:i + 8], 16) for i in range(0, 32, 8))


def _parts(texts: list[bytes], p: FillMiddle) -> Iterator[tuple[int, int]]:
    """Runs of texts of `p.at_once` bytes together, at least one text each."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > p.at_once:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def transform_texts(names: list[int | None], texts: list[bytes], p: FillMiddle = DEFAULT) -> list[tuple]:
    """FIELDS of every text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    data = b"".join(texts)
    units = Units(np.frombuffer(data, np.uint8), begins)
    n = units.before(ends) - units.before(begins)
    h = [None if name is None else draws(p.seed, name) for name in names]
    cut = [
        d is not None and d[2] % 100 < p.percent and len(t) > 0 and not any(m in t for m in (PREFIX, SUFFIX, MIDDLE))
        for d, t in zip(h, texts)
    ]
    rows = np.flatnonzero(cut)
    counts = n[rows]
    one, two = ([d[k] % (int(c) + 1) for d, c in zip((h[r] for r in rows), counts)] for k in (0, 1))
    one, two = np.array(one, np.int64), np.array(two, np.int64)
    a = units.cut(begins[rows], ends[rows], np.minimum(one, two))
    b = units.cut(begins[rows], ends[rows], np.maximum(one, two))
    at_begin, at_a, at_b = (units.chars_before(x) for x in (begins[rows], a, b))
    out: list[tuple] = [(int(c), "plain", None, None, t) for c, t in zip(n, texts)]
    for k, r in enumerate(rows):
        prefix, middle, suffix = data[begins[r]:a[k]], data[a[k]:b[k]], data[b[k]:ends[r]]
        if h[r][3] % 100 < p.suffix_first:
            form, text = "spm", SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
        else:
            form, text = "psm", PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
        out[r] = int(n[r]), form, int(at_a[k] - at_begin[k]), int(at_b[k] - at_a[k]), text
    return out


def _transformed(p: FillMiddle):
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())

    def of(names: pa.Array, texts: pa.Array) -> pa.Array:
        names, texts = names.to_pylist(), [t or b"" for t in texts.to_pylist()]
        columns: list[list] = [[] for _ in FIELDS]
        for begin, end in _parts(texts, p):
            for row in transform_texts(names[begin:end], texts[begin:end], p):
                for column, value in zip(columns, row):
                    column.append(value)
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], FIELDS)

    def transformed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for names, texts in released(batches):
            # Few rows at a time, so that only their results are Python objects.
            parts = [of(names.slice(at, 1_000), texts.slice(at, 1_000)) for at in range(0, len(texts), 1_000)]
            yield pa.concat_arrays(parts or [of(names, texts)])

    kind = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"
    return F.arrow_udf(transformed, kind, F.ArrowUDFType.SCALAR_ITER).asNondeterministic()


def _own(column: str) -> Column:
    return F.col(f"`{column.replace('`', '``')}`")


def fill_middle(docs: DataFrame, p: FillMiddle = DEFAULT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with n (units), form (plain, psm or spm), prefix_chars, middle_chars and output; columns of those names are replaced.

    Form and cuts follow from a hash of the id, so rows that share an id are drawn alike, each over its own text. Texts that
    are null (taken as empty), empty or hold a mark stay plain, and so does a row without an id; their output is the text and
    the counts of characters are null. Ids are integers, others raise ValueError. An empty table gives an empty one.
    """
    return with_result(docs, _transformed(p)(integers(docs, id_col), _own(text_col).cast("string").cast("binary")), FIELDS)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of, by its marks. A cut text holds no mark of its own, so its output has three."""
    parts = F.split(output, "<[PSM]>", 4)
    in_order = F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(F.concat(parts[2], parts[3], parts[1]))
    return F.when(form == "plain", output).otherwise(in_order)
