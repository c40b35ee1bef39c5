"""Token counts that follow edits: a segment tree over the pre-tokens of each document.

A tokenizer cuts a text into pre-tokens by a pattern and encodes each by itself. A document's tree has a leaf for
each pre-token with its characters and tokens, and sums above them. An edit finds its leaves from the
sums, cuts the text anew from a leaf before the edit until a cut falls on an old one behind it, encodes only what is new
there and updates the sums above. All else keeps its counts. Trees are kept as a column between batches of edits, so the next
batch encodes nothing but its own regions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from gradewell.llm.common import released, with_result

#: A pre-token depends on no character further behind it than this one's place; the pattern looks ahead as far.
LOOK_AHEAD = 2


@dataclass(frozen=True)
class Encoding:
    """Ranks of a byte-level vocabulary, and the pattern that cuts pre-tokens without looking behind."""

    ranks: str
    pattern: str


def default() -> Encoding:
    import public_tokenizers

    return Encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


class Counter(dict):
    """Tokens of pre-tokens; forgotten when there are too many."""

    def __init__(self, encoding: Encoding, most: int = 150_000):
        import base64

        import tiktoken

        super().__init__()
        with open(encoding.ranks, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.whole = tiktoken.Encoding("counted", pat_str=encoding.pattern, mergeable_ranks=ranks, special_tokens={})
        self.cut = regex.compile(encoding.pattern)
        self.most = most

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.most:
            self.clear()
        self[piece] = n = len(self.whole._encode_single_piece(piece))
        return n

    def pieces(self, text: str) -> list[str]:
        return self.cut.findall(text)


@lru_cache(maxsize=2)
def _counter(encoding: Encoding) -> Counter:
    return Counter(encoding)


class Tree:
    """Sums of characters and tokens over the leaves; a leaf holds any number of pre-tokens after edits."""

    def __init__(self, lengths: np.ndarray, tokens: np.ndarray):
        #: Lengths and tokens of the pre-tokens of leaves that were edited.
        self.leaves: dict[int, tuple[list[int], list[int]]] = {}
        self.size = 1 << max(0, int(len(lengths) - 1).bit_length())
        self.sums = []
        for values in (lengths, tokens):
            level = np.zeros(self.size, np.int64)
            level[:len(values)] = values
            levels = [level]
            while len(level) > 1:
                level = level[::2] + level[1::2]
                levels.append(level)
            self.sums.append(levels)

    @property
    def characters(self) -> int:
        return int(self.sums[0][-1][0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1][-1][0])

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character, and where it begins; the last one for the end of the text."""
        node, begin = 0, 0
        for level in reversed(self.sums[0][:-1]):
            node *= 2
            if place >= begin + level[node] and level[node + 1]:
                begin += int(level[node])
                node += 1
        return node, begin

    def put(self, leaf: int, lengths: list[int], tokens: list[int]) -> None:
        self.leaves[leaf] = lengths, tokens
        for levels, value in zip(self.sums, (sum(lengths), sum(tokens))):
            more, node = value - int(levels[0][leaf]), leaf
            if more:
                for level in levels:
                    level[node] += more
                    node //= 2

    def cuts(self, leaf: int) -> list[int]:
        if leaf in self.leaves:
            return self.leaves[leaf][0]
        return [n] if (n := int(self.sums[0][0][leaf])) else []

    def pre_tokens(self) -> tuple[list[int], list[int]]:
        """Lengths and tokens of all pre-tokens in order."""
        lengths, tokens = (levels[0].tolist() for levels in self.sums)
        for leaf in sorted(self.leaves, reverse=True):
            lengths[leaf:leaf + 1], tokens[leaf:leaf + 1] = self.leaves[leaf]
        held = [i for i, n in enumerate(lengths) if n]
        return [lengths[i] for i in held], [tokens[i] for i in held]


class Tail:
    """The text behind a place, as pieces of which the first is on top."""

    def __init__(self, text: str):
        self.pieces = [text]

    def push(self, text: str) -> None:
        self.pieces.append(text)

    def peek(self, n: int) -> tuple[str, bool]:
        """Its first n characters, and whether that is all."""
        out = []
        for piece in reversed(self.pieces):
            out.append(piece[:n])
            n -= len(piece)
            if n < 0:
                return "".join(out), False
        return "".join(out), True

    def whole(self) -> str:
        return "".join(reversed(self.pieces))


def _replace(text: str, tail: Tail, tree: Tree, counter: Counter, start: int, end: int, new: str) -> int:
    """Brings the tree up to date with [start, end) replaced; how many pre-tokens were encoded.

    The tree stands for text[:end] and the tail behind it; no more of them is looked at than the cuts need.
    """
    first, begin = tree.leaf_at(max(0, start - LOOK_AHEAD))
    head = text[begin:start] + new
    shift = len(new) - (end - start) - begin  # from old places to new ones, counted from `begin`
    last, reach = first, begin
    old: set[int] = set()
    pieces: list[str] = []
    at, window, found = 0, 24, False
    while not found:
        seen, is_all = tail.peek(max(0, at + window - len(head)))
        view = head + seen
        while reach + shift < len(view) and last < tree.size:
            for n in tree.cuts(last):
                reach += n
                if reach >= end:
                    old.add(reach + shift)
            last += 1
        for m in counter.cut.finditer(view, at):
            if m.end() > len(view) - LOOK_AHEAD and not is_all:
                break
            pieces.append(m[0])
            at = m.end()
            if at in old:
                found = True
                break
        if is_all and at >= len(view):
            break
        window *= 2
    # The leaves from `first` up to the one that ends where the cuts agree again.
    place, leaf = begin, first
    rest: list[int] = []
    while leaf < tree.size and (place + shift < at or place < end):
        for n in tree.cuts(leaf):
            place += n
            if place + shift > at:
                rest.append(n)
        leaf += 1
    behind = []
    if rest:
        view, to = head + tail.peek(at + sum(rest))[0], at
        for n in rest:
            behind.append(view[to:to + n])
            to += n
    for k in range(first + 1, leaf):
        tree.put(k, [], [])
    tree.put(first, [len(p) for p in pieces + behind], [counter[p] for p in pieces + behind])
    return len(pieces)


def edit_all(text: str, tree: Tree, counter: Counter, edits: list[tuple[int, int, str]]) -> tuple[str, int]:
    """The text with all edits made, the tree brought up to date, and how many pre-tokens were encoded.

    Edits (start, end, new) are in order and apart, on the text as it is; they are made from the last one back.
    """
    encoded, behind = 0, len(text)
    tail = Tail("")
    for start, end, new in reversed(edits):
        tail.push(text[end:behind])
        encoded += _replace(text, tail, tree, counter, start, end, new)
        tail.push(new)
        behind = start
    return text[:behind] + tail.whole(), encoded


def _pack(lengths: list[int], tokens: list[int]) -> bytes:
    """A byte that tells the width of a number, the lengths, the tokens."""
    width = 2 if max(lengths, default=0) < 1 << 16 and max(tokens, default=0) < 1 << 16 else 4
    return bytes([width]) + np.array(lengths + tokens, f"<u{width}").tobytes()


def _numbers(tree: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and tokens of the pre-tokens of a packed tree."""
    both = np.frombuffer(tree, f"<u{tree[0]}", offset=1).astype(np.int64)
    return both[:len(both) // 2], both[len(both) // 2:]


#: Rows whose texts are Python objects at a time.
_AT_ONCE = 500


def _built(text: str | None, counter: Counter) -> tuple[list[int], list[int]]:
    pieces = counter.pieces(text or "")
    return list(map(len, pieces)), list(map(counter.__getitem__, pieces))


def with_trees(docs: DataFrame, encoding: Encoding | None = None, text_col: str = "text") -> DataFrame:
    """`docs` with n_pre_tokens, n_tokens and tree (lengths, then tokens, of all pre-tokens), to be kept with them.

    A null text is empty and has none. Every row is counted by itself and whole. Columns of these names are replaced.
    """
    encoding = encoding or default()
    kind = pa.struct([("n_pre_tokens", pa.int64()), ("n_tokens", pa.int64()), ("tree", pa.binary())])

    def build(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(encoding)
        for texts in released(batches):
            parts = []
            for at in range(0, max(1, len(texts)), _AT_ONCE):
                built = [_built(text.as_py(), counter) for text in texts.slice(at, _AT_ONCE)]
                parts.append(pa.array(
                    [{"n_pre_tokens": len(n), "n_tokens": sum(t), "tree": _pack(n, t)} for n, t in built], kind
                ))
            yield pa.concat_arrays(parts)

    made = F.arrow_udf(build, "struct<n_pre_tokens:bigint,n_tokens:bigint,tree:binary>", F.ArrowUDFType.SCALAR_ITER)
    return with_result(docs, made.asNondeterministic()(F.col(text_col).cast("string")), ["n_pre_tokens", "n_tokens", "tree"])


@dataclass(frozen=True)
class Masking:
    """Edits that replace every match of a pattern, found in the task that makes them. The pattern is one of `regex`."""

    pattern: str
    new: str = ""

    def of(self, text: str) -> list[tuple[int, int, str]]:
        return [(m.start(), m.end(), self.new) for m in regex.finditer(self.pattern, text) if m.end() > m.start()]


def _checked(text: str, edits: list[dict]) -> list[tuple[int, int, str]]:
    """The edits of a document, if they lie inside the text, in order and apart."""
    out, at = [], 0
    for k, e in enumerate(edits):
        start, end, new = e["start"], e["end"], e["new"] or ""
        if start is None or end is None or not at <= start <= end <= len(text):
            raise ValueError(f"edit {k} ({start}, {end}) of a text of {len(text)} characters is outside of it or not behind the one before")
        out.append((start, end, new))
        at = end
    return out


#: Kinds of the columns that apply_edits() can add.
_FOLLOWED = {
    "n_pre_tokens": "bigint", "n_tokens": "bigint", "n_edits": "bigint", "n_tokens_after": "bigint", "n_encoded": "bigint",
    "text_after": "string", "tree_after": "binary",
}


def apply_edits(
    docs: DataFrame, edits: Column | Masking, encoding: Encoding | None = None, text_col: str = "text", with_texts: bool = True,
    with_trees_after: bool = False,
) -> DataFrame:
    """`docs` with n_pre_tokens and n_tokens before the edits, n_edits, n_tokens_after, n_encoded and, if wanted, text_after
    and tree_after.

    `edits` is an array of structs (start, end, new) on the text as it was: code points, end exclusive, in order, without
    overlap (they may touch); others fail the job with their numbers. A null `new` is
    empty. Null or empty edits leave a document as it is; a null text counts as empty. A Masking finds its edits itself, in the same
    pass. Edits are made from the last one back. n_encoded is how many pre-tokens were encoded again. The column `tree` of
    with_trees(), or tree_after of an earlier batch under that name, is used where there is one, so nothing else is cut or
    encoded; else a text's pre-tokens are counted on the way, and a tree is built of those that are edited.
    """
    encoding = encoding or default()
    kept, given = "tree" in docs.columns, not isinstance(edits, Masking)
    masking = None if given else edits
    names = [n for n in _FOLLOWED if (n != "text_after" or with_texts) and (n != "tree_after" or with_trees_after)]
    kind = pa.struct([(n, {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[_FOLLOWED[n]]) for n in names])

    def row(text: str | None, tree: bytes | None, wanted: list[dict] | None, counter: Counter) -> tuple:
        plain = text or ""
        changes = _checked(plain, wanted or []) if given else masking.of(plain)
        if tree is None and not changes and not with_trees_after:
            pieces = counter.pieces(plain)
            before = sum(map(counter.__getitem__, pieces))
            return len(pieces), before, 0, before, 0, text, None
        lengths, tokens = _numbers(tree) if tree is not None else _built(plain, counter)
        n, before = len(lengths), int(sum(tokens))
        if not changes:
            return n, before, 0, before, 0, text, tree if tree is not None or not with_trees_after else _pack(lengths, tokens)
        known = Tree(np.asarray(lengths, np.int64), np.asarray(tokens, np.int64))
        after, encoded = edit_all(plain, known, counter, changes)
        return n, before, len(changes), known.tokens, encoded, after, _pack(*known.pre_tokens()) if with_trees_after else None

    def follow(batches: Iterator[pa.Array | tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        counter = _counter(encoding)
        for columns in released(batches):
            texts, *more = (columns,) if isinstance(columns, pa.Array) else columns
            changes, trees = more[0] if given else None, more[-1] if kept else None
            parts = []
            for at in range(0, max(1, len(texts)), _AT_ONCE):
                some = texts.slice(at, _AT_ONCE).to_pylist()
                wanted, known = (
                    [None] * len(some) if c is None else c.slice(at, _AT_ONCE).to_pylist() for c in (changes, trees))
                rows = [dict(zip(_FOLLOWED, row(*r, counter))) for r in zip(some, known, wanted)]
                parts.append(pa.array([{n: r[n] for n in names} for r in rows], kind))
            yield pa.concat_arrays(parts)

    shape = ",".join(f"{n}:{_FOLLOWED[n]}" for n in names)
    made = F.arrow_udf(follow, f"struct<{shape}>", F.ArrowUDFType.SCALAR_ITER).asNondeterministic()
    columns = [F.col(text_col).cast("string")] + [edits] * given + [F.col("tree")] * kept
    return with_result(docs, made(*columns), names)
