"""Secret scan in DataFrame operations: fixed patterns, and a battery of randomness tests.

Long tokens that hold letters and digits are candidates. A candidate's encoding gives its alphabet, and three
tests ask whether its symbols could be drawn at random from it: chi-squared for uniform use, runs above and
below the middle, and serial correlation. Fisher's method combines them. Random tokens have evenly spread p-values,
others small ones; so, for every encoding and length, the upper half of the p-values tells how many tokens are
random, and the threshold is the smallest one above which at most the wanted share of finds is false.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from gradewell.llm.common import prefixes

#: Fixed values of the contract: kinds in order, pattern, what of the match is measured (0: all), least characters.
KINDS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
#: As KINDS, for a test that a text has any find: what cannot reach the least length is no candidate.
_SOME = {
    "assign": KINDS[0][1], "access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}",
}
#: Maximal runs of 20 or more symbols with a letter and a digit.
RANDOM = "random"
_RUN = r"[A-Za-z0-9+/_-]"
_CANDIDATE = rf"(?<!{_RUN})(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z]){_RUN}{{20,}}+={{0,2}}"

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings, the first that fits counts: name, pattern, alphabet in the order of its values.
ENCODINGS = (
    ("hex", "[0-9a-f]+", _DIGITS + "abcdef"),
    ("hex_upper", "[0-9A-F]+", _DIGITS + "ABCDEF"),
    ("base32", "[A-Z2-7]+", _UPPER + "234567"),
    ("base36", "[a-z0-9]+", _DIGITS + _LOWER),
    ("base62", "[A-Za-z0-9]+", _DIGITS + _UPPER + _LOWER),
    ("base64", ".*", _UPPER + _LOWER + _DIGITS + "+/"),
)
#: Lower ends of the length classes.
LENGTHS = (20, 24, 32, 40, 48, 64, 128)


@dataclass(frozen=True)
class SecretScan:
    #: Share of false finds among the random spans of a class; bins of p-values.
    false_share: float = 0.05
    bins: int = 20
    #: Candidates that a length class borrows from its encoding's histogram: the fewer it has of its own, the more of its
    #: threshold comes from there.
    borrowed: float = 50.0
    mark: str = "[SECRET]"


DEFAULT = SecretScan()
_SPAN = "array<struct<start:bigint,end:bigint,value:string>>"


def _spans(text: Column, pattern: str, some: str, group: int, least: int) -> Column:
    """Places (code points, end exclusive) of the leftmost matches that do not overlap and are long enough."""
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    lengths = F.transform(found, lambda x: (F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0))).cast("bigint"))
    ends = prefixes(lengths, F.lit(0).cast("bigint"), lambda a, b: a + b)
    placed = F.zip_with(found, ends, lambda x, end: F.struct(
        (end - F.length(x["hit"])).alias("start"), end.alias("end"), x["value"].alias("value")))
    spans = F.filter(placed, lambda s: F.length(s["value"]) >= least).cast(_SPAN)
    return F.when(text.rlike(some), spans).otherwise(F.array().cast(_SPAN))


def _upper_tail(z: Column) -> Column:
    """Chance that a normal value exceeds z, to seven places (a known rational approximation)."""
    at = F.abs(z)
    t = 1 / (1 + 0.2316419 * at)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-at * at / 2) * (1 / math.sqrt(2 * math.pi)) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _encoded(span: Column) -> Column:
    """The span's symbols, without padding, with its encoding and alphabet."""
    body = F.rtrim(span["value"], F.lit("="))
    encoding, alphabet = F.lit(ENCODINGS[-1][0]), F.lit(ENCODINGS[-1][2])
    for name, pattern, symbols in reversed(ENCODINGS[:-1]):
        fits = body.rlike(rf"\A{pattern}\z")
        encoding, alphabet = F.when(fits, name).otherwise(encoding), F.when(fits, symbols).otherwise(alphabet)
    characters = F.filter(F.split(F.translate(body, "-_", "+/"), ""), lambda c: c != "")
    return F.struct(
        span["start"].alias("start"), span["end"].alias("end"), encoding.alias("encoding"), alphabet.alias("alphabet"),
        characters.alias("characters"),
    )


def _symbols(s: Column) -> Column:
    """The values of the symbols in their alphabet, and its size."""
    return F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["encoding"].alias("encoding"),
        F.length(s["alphabet"]).cast("double").alias("size"),
        F.transform(s["characters"], lambda c: (F.instr(s["alphabet"], c) - 1).cast("double")).alias("codes"),
    )


def _ordered(s: Column) -> Column:
    return F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["encoding"].alias("encoding"), s["size"].alias("size"),
        s["codes"].alias("codes"), F.sort_array(s["codes"]).alias("ordered"),
        (_sum(s["codes"]) / F.size(s["codes"])).alias("mean"),
    )


def _sums(s: Column) -> Column:
    """What the tests count."""
    codes, size, ordered, mean = s["codes"], s["size"], s["ordered"], s["mean"]
    n = F.size(codes).cast("double")
    following = F.slice(codes, 2, F.greatest(F.size(codes) - 1, F.lit(1)))
    leading = F.slice(codes, 1, F.greatest(F.size(codes) - 1, F.lit(1)))
    # Equal symbols stand together once sorted: the squares of their counts by the places of changes.
    changes = F.filter(
        F.transform(ordered, lambda c, i: F.when((i == 0) | (c != F.get(ordered, i - 1)), i.cast("double"))),
        lambda i: i.isNotNull(),
    )
    ends = F.concat(F.slice(changes, 2, F.greatest(F.size(changes), F.lit(1))), F.array(n))
    return F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["encoding"].alias("encoding"), size.alias("size"), n.alias("n"),
        _sum(F.zip_with(changes, ends, lambda a, b: (b - a) * (b - a))).alias("squares"),
        _sum(F.transform(codes, lambda c: F.when(c * 2 >= size, 1.0).otherwise(0.0))).alias("high"),
        _sum(F.zip_with(leading, following, lambda a, b: F.when((a * 2 >= size) != (b * 2 >= size), 1.0).otherwise(0.0))).alias("turns"),
        _sum(F.zip_with(leading, following, lambda a, b: (a - mean) * (b - mean))).alias("lagged"),
        _sum(F.transform(codes, lambda c: (c - mean) * (c - mean))).alias("spread"),
    )


def _tested(s: Column) -> Column:
    """p-value of a random token, by Fisher's combination of the three tests, and its class."""
    n, free = s["n"], s["size"] - 1
    chi = s["size"] / n * s["squares"] - n
    # The cube root of chi-squared over its degrees of freedom is nearly normal.
    uniform = _upper_tail((F.cbrt(F.greatest(chi, F.lit(0.0)) / free) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free)))
    expected = 2 * s["high"] * (n - s["high"]) / n + 1
    variance = (expected - 1) * (expected - 2) / (n - 1)
    runs = F.when(variance > 1e-9, (s["turns"] + 1 - expected) / F.sqrt(variance)).otherwise(F.sqrt(n))
    serial = F.when(s["spread"] > 1e-9, (s["lagged"] / s["spread"] + 1 / n) * F.sqrt(n)).otherwise(F.sqrt(n))
    logs = F.lit(0.0)
    for p in (uniform, 2 * _upper_tail(F.abs(runs)), 2 * _upper_tail(F.abs(serial))):
        logs = logs - F.log(F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-30)))
    length = F.lit(LENGTHS[0])
    for low in LENGTHS[1:]:
        length = F.when(n >= low, low).otherwise(length)
    return F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["encoding"].alias("encoding"), length.alias("length"),
        (F.exp(-logs) * (1 + logs + logs * logs / 2)).alias("p"),
    )


def _candidates(docs: DataFrame, text: str, out: str) -> DataFrame:
    """`docs` with the tested candidates of `text`. A projection for each step, so that nothing is made twice."""
    kept = [c for c in docs.columns if c != out]
    some = rf"{_RUN}{{20}}"
    steps = docs.select(*kept, _spans(F.col(text), _CANDIDATE, some, 0, 20).alias(out))
    for step in (_encoded, _symbols, _ordered, _sums, _tested):
        steps = steps.select(*kept, F.transform(out, step).alias(out))
    return steps


def thresholds(docs: DataFrame, p: SecretScan = DEFAULT, text_col: str = "text") -> dict[tuple[str, int], float]:
    """Least p-value of a find, by encoding and length class, from the candidates of all texts.

    What reaches the driver is a histogram: a row for each encoding, length class and bin.
    """
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    tested = _candidates(texts.where(F.col("text").rlike(rf"{_RUN}{{20}}")), "text", "found").select(F.explode("found").alias("f"))
    counted = tested.groupBy(
        "f.encoding", "f.length", F.least(F.floor(F.col("f.p") * p.bins), F.lit(p.bins - 1)).cast("int").alias("bin")
    ).agg(F.count("*").alias("n")).collect()
    by_class: dict[tuple[str, int], list[int]] = {}
    for r in counted:
        for length in (r["length"], 0):  # 0: all lengths of the encoding
            by_class.setdefault((r["encoding"], length), [0] * p.bins)[r["bin"]] += r["n"]
    return {
        (encoding, length): _threshold(_shrunk(bins, by_class[encoding, 0], p), p)
        for (encoding, length), bins in by_class.items() if length
    }


def _shrunk(bins: list[int], whole: list[int], p: SecretScan) -> list[float]:
    """A class' histogram with some candidates spread over it as its encoding's are."""
    return [n + p.borrowed * m / sum(whole) for n, m in zip(bins, whole)]


def _threshold(bins: list[float], p: SecretScan) -> float:
    """The smallest edge above which the bins hold at most the wanted share beyond what random tokens put there."""
    half = len(bins) // 2
    random_in_bin = sum(bins[half:]) / (len(bins) - half)
    edge = half
    for k in range(half, -1, -1):
        found = sum(bins[k:])
        if found - random_in_bin * (len(bins) - k) <= p.false_share * found:
            edge = k
    return edge / len(bins)


def find_secrets(
    docs: DataFrame, p: SecretScan = DEFAULT, text_col: str = "text", limits: dict[tuple[str, int], float] | None = None,
) -> DataFrame:
    """`docs` with n_assign, n_access, n_hex and spans (start, end, kind), sorted by start and then by kind.

    Code points, end exclusive. A null text is empty and has no spans. Every row is scanned by itself, with a null or
    repeated id too. Columns with the names of results are replaced. Without `limits` the texts are read twice, first
    for thresholds(); nothing else is shuffled. An empty table gives an empty one.
    """
    limits = thresholds(docs, p, text_col) if limits is None else limits
    made = ["n_assign", "n_access", "n_hex", "spans"]
    kept = [c for c in docs.columns if c not in made]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    steps = docs.select(F.struct(*kept).alias("row"), text.alias("text"))
    steps = steps.select(
        "row", "text", *(_spans(F.col("text"), rx, _SOME[kind], group, least).alias(kind) for kind, rx, group, least in KINDS)
    )
    steps = _candidates(steps, "text", RANDOM)
    def random_enough(c: Column) -> Column:
        edge = F.lit(2.0)
        for (encoding, length), value in limits.items():
            edge = F.when((c["encoding"] == encoding) & (c["length"] == length), value).otherwise(edge)
        return c["p"] >= edge

    names = [kind for kind, *_ in KINDS] + [RANDOM]
    found = [F.col(kind) for kind, *_ in KINDS] + [F.filter(RANDOM, random_enough)]

    def told(column: Column, k: int) -> Column:
        return F.transform(column, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("k"), s["end"].alias("end")))

    every = F.sort_array(F.concat(*(told(c, k) for k, c in enumerate(found))))
    spans = F.transform(every, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.array(*map(F.lit, names))[s["k"]].alias("kind")
    ))
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind, *_ in KINDS]
    return steps.select("row.*", *counts, spans.alias("spans"))


def written(spans: Column) -> Column:
    """`kind:start:end`, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] != RANDOM)


def redact(docs: DataFrame, p: SecretScan = DEFAULT, text_col: str = "text") -> DataFrame:
    """`docs` with every span in the texts replaced by the mark; overlapping spans by one. Null texts stay null."""
    columns = docs.columns
    scanned = find_secrets(docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text")), p)
    # Spans come by their starts: one that begins before the furthest end so far lies in the run before it.
    reached = scanned.select("row", "text", "spans", prefixes(
        F.transform("spans", lambda s: s["end"]), F.lit(-1).cast("bigint"), lambda a, b: F.greatest(a, b)).alias("reach"))
    begins = F.filter(F.transform("spans", lambda s, i: F.when(
        s["start"] >= F.coalesce(F.get("reach", i - 1), F.lit(0)), F.struct(s["start"].alias("start"), i.alias("i")))), lambda s: s.isNotNull())
    opened = reached.select("row", "text", "reach", begins.alias("begins"))
    cuts = F.transform("begins", lambda b, k: F.struct(
        b["start"].alias("start"), F.get("reach", F.coalesce(F.get("begins", k + 1)["i"], F.size("reach")) - 1).alias("end")))
    cut = opened.select("row", "text", cuts.alias("cuts"))
    parts = F.transform("cuts", lambda s, i: F.concat(
        F.substring("text", F.coalesce(F.get("cuts", i - 1)["end"], F.lit(0)).cast("int") + 1,
                    (s["start"] - F.coalesce(F.get("cuts", i - 1)["end"], F.lit(0))).cast("int")),
        F.lit(p.mark),
    ))
    tail = F.substr("text", F.element_at("cuts", -1)["end"].cast("int") + 1)
    clean = F.when(F.size("cuts") == 0, F.col("text")).otherwise(F.concat(F.array_join(parts, ""), tail))
    return cut.select(*(
        clean.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in columns
    ))
