"""URL filter: host and path rules, then a weighted vocabulary of strict and soft terms.

One Aho-Corasick automaton walks the whole url, and a percent-decoded copy where that differs. A term counts where it stands
between characters that are no ASCII letters or digits, as it is, in the plural, or written as one word with another. One strict
term or several distinct soft ones block the page; weights decide single soft terms.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from functools import lru_cache
from urllib.parse import unquote

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gradewell.llm.common import with_result


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


#: Fixed values of the contract.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)
STRICT = ("porn", "xxx", "casino", "warez", "malware", "phishing")
SOFT: Mapping[str, float] = {
    "ads": 0.6, "adult": 1.0, "bet": 0.6, "bonus": 0.5, "cams": 0.8, "cheap": 0.4, "clickbait": 1.0, "crack": 0.8, "dating": 0.7,
    "escort": 1.0, "farm": 0.2, "free": 0.3, "gambling": 1.0, "hot": 0.4, "keygen": 1.0, "loan": 0.5, "nude": 1.0, "pills": 0.8,
    "poker": 0.8, "popup": 0.8, "sex": 1.0, "slots": 0.8, "spam": 1.0, "torrent": 0.7, "track": 0.3, "viagra": 1.0, "win": 0.3,
}


@dataclass(frozen=True)
class Vocabulary:
    """Terms in lower case. Soft terms block from `distinct` different ones on, a single one from a weight of `alone`. `forms` are
    other writings, each with the terms that it stands for.
    """

    strict: tuple[str, ...] = STRICT
    soft: Mapping[str, float] = field(default_factory=lambda: dict(SOFT))
    distinct: int = 2
    alone: float = 1.0
    forms: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def stands_for(self) -> dict[str, tuple[str, ...]]:
        """Every writing with the terms that it stands for."""
        return {**self.forms, **{t: (t,) for t in (*self.strict, *self.soft)}}


def _forms() -> dict[str, tuple[str, ...]]:
    """Plurals (or the singular) of nouns, and any two different terms written as one word."""
    plural = ("bet", "casino", "crack", "escort", "farm", "keygen", "loan", "nude", "popup", "torrent", "win")
    nouns = {f"{t}s": t for t in plural} | {"bonuses": "bonus", "cam": "cams", "pill": "pills", "slot": "slots", "tracker": "track", "tracking": "track"}
    one = {t: t for t in (*STRICT, *SOFT)} | nouns
    two = {a + b: (one[a], one[b]) for a in one for b in one if one[a] != one[b]}
    return {form: terms for form, terms in (two | {f: (t,) for f, t in nouns.items()}).items() if form not in {*STRICT, *SOFT}}


DEFAULT = Vocabulary(forms=_forms())


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased in A-Z, and path; both empty for a null or a text without `://`."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(after, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(after, r"\A[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Name of the longest rule that fits; of equally long ones the first. Null if none does."""
    fits = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):
        on_host = (host == rule.host) | host.endswith(f".{rule.host}")
        fits = F.when(on_host & path.startswith(rule.path), F.lit(rule.name)).otherwise(fits)
    return fits


@lru_cache(maxsize=4)
def _automaton(terms: tuple[str, ...]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for term in terms:
        automaton.add_word(term, term)
    automaton.make_automaton()
    return automaton


def terms_in(text: str, terms: tuple[str, ...]) -> dict[str, int]:
    """How often each term stands in `text`, in any case of A-Z, with no ASCII letter or digit beside it."""
    low = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    found: dict[str, int] = {}
    joins = lambda at: 0 <= at < len(low) and low[at].isascii() and low[at].isalnum()
    for end, term in _automaton(terms).iter(low):
        if not joins(end - len(term)) and not joins(end + 1):
            found[term] = found.get(term, 0) + 1
    return found


def terms_in_url(url: str, terms: tuple[str, ...]) -> dict[str, int]:
    """How often each term stands in a url, as it is or percent-decoded: the larger number of the two."""
    found = terms_in(url, terms)
    if "%" in url and (plain := unquote(url)) != url:
        for term, n in terms_in(plain, terms).items():
            found[term] = max(n, found.get(term, 0))
    return found


def _judge(vocabulary: Vocabulary):
    stands = vocabulary.stands_for()
    terms = tuple(sorted(stands))
    strict = frozenset(vocabulary.strict)

    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for text in texts.to_pylist():
                found = Counter()
                for form, n in (terms_in_url(text, terms) if text and terms else {}).items():
                    for term in stands[form]:
                        found[term] += n
                hard = sorted(t for t in found if t in strict)
                soft = sorted(t for t in found if t not in strict)
                weight = sum(vocabulary.soft[t] for t in soft)
                blocked = bool(hard) or len(soft) >= vocabulary.distinct or any(vocabulary.soft[t] >= vocabulary.alone for t in soft)
                out.append({
                    "n_strict": sum(found[t] for t in hard), "n_soft": sum(found[t] for t in soft),
                    "soft_weight": float(weight), "terms": [*hard, *soft], "blocked": blocked,
                })
            yield pa.array(out, pa.struct([
                ("n_strict", pa.int64()), ("n_soft", pa.int64()), ("soft_weight", pa.float64()),
                ("terms", pa.list_(pa.string())), ("blocked", pa.bool_()),
            ]))

    return judge


def filter_urls(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, vocabulary: Vocabulary = DEFAULT, url_col: str = "url",
) -> DataFrame:
    """`pages` with host, path, rule, n_strict, n_soft, soft_weight, terms and verdict (allow or block).

    The longest fitting rule decides; where none fits, the vocabulary does, over the whole url with query and fragment. A null
    url, or one without `://`, has an empty host and path and fits no rule; a null or empty one is allowed. Every row is judged by itself,
    repeated ones alike. Input columns with the names of results are replaced. No shuffle.
    """
    row = f"_{uuid.uuid4().hex}"
    host, path = host_and_path(F.col(url_col).cast("string"))
    judge = F.arrow_udf(
        _judge(vocabulary),
        "struct<n_strict:bigint,n_soft:bigint,soft_weight:double,terms:array<string>,blocked:boolean>",
        F.ArrowUDFType.SCALAR_ITER,
    ).asNondeterministic()
    parts = pages.select("*", F.struct(host.alias("host"), path.alias("path"), judge(F.col(url_col).cast("string")).alias("w")).alias(row))
    at = F.col(row)
    rule = matching_rule(at["host"], at["path"], rules)
    verdict = F.when(at["w"]["blocked"], "block").otherwise("allow")
    for r in rules:
        verdict = F.when(rule == r.name, r.verdict).otherwise(verdict)
    counted = ["n_strict", "n_soft", "soft_weight", "terms"]
    result = F.struct(
        at["host"].alias("host"), at["path"].alias("path"), rule.alias("rule"),
        *(at["w"][c].alias(c) for c in counted), verdict.alias("verdict"),
    )
    return with_result(parts, result, ["host", "path", "rule", *counted, "verdict"]).drop(row)
