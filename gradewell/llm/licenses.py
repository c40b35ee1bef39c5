"""License scan: an exact set-similarity join of text blocks with license templates, in DataFrame operations.

A block is a run of words, over line ends, that begins with a word of the template and is half as long again as the template. It
meets the template if it holds the asked share of the template's distinct tokens, and among them those that tell licenses
apart. Tokens are ordered by how many documents hold them, rarest first. A block that meets a template holds one of the
template's rarest few (the prefix), so blocks are made around those words only; near them there must be enough tokens of the
template at all (the length) and, if the word is the block's rarest, enough that are not rarer than it (the position).
What passes these is counted. A template gives way where one of another label shares all its tokens and more. Beside
it, fixed phrases are found word by word.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from gradewell.llm.common import staged

#: Fixed values of the contract: phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Customary notices, a few for some of the labels.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", "Released under the BSD License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software; you can redistribute it under the terms of the GNU General Public License"),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License"),
    ("agpl", "This work is licensed under the GNU Affero General Public License"),
    ("mpl-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("proprietary", "No part of this publication may be reproduced without the prior written permission of the publisher"),
    ("reserved", "All rights reserved"),
)
_OTHER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class LicenseScan:
    phrases: Mapping[str, str] = field(default_factory=lambda: dict(PHRASES))
    templates: tuple[tuple[str, str], ...] = TEMPLATES
    #: Share of a template's distinct tokens that a block must hold.
    containment: float = 0.8
    #: Score of a text that holds phrases but meets no template.
    phrase_score: float = 0.5
    #: Templates of so many distinct tokens or fewer must be held whole.
    short: int = 7
    #: Words that tell licenses apart: a block must hold those of the template.
    telling: frozenset[str] = frozenset({"affero", "apache", "attribution", "bsd", "cc0", "lesser", "mit", "mozilla", "nc", "nd", "sa"})
    #: Words of a block, as a multiple of the template's words.
    reach: float = 1.5


DEFAULT = LicenseScan()


def template_tokens(p: LicenseScan) -> list[tuple[int, str, list[str], int]]:
    """(number, label, distinct tokens, tokens a block must share) of each template that has tokens."""
    found = [(i, label, sorted({w for w in re.split(_OTHER, text.lower()) if w})) for i, (label, text) in enumerate(p.templates)]
    share = lambda t: 1.0 if len(t) <= p.short else p.containment
    return [(i, label, t, max(1, math.ceil(share(t) * len(t) - 1e-9))) for i, label, t in found if t]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, f"{_OTHER}+"), lambda w: w != "")


def _n_words(text: Column) -> Column:
    """Words of a text, without making the empty ones at its ends."""
    ends = F.when(text.rlike(rf"\A{_OTHER}"), 1).otherwise(0) + F.when(text.rlike(rf"{_OTHER}\z"), 1).otherwise(0)
    return F.when(text == "", 0).otherwise(F.size(F.split(text, f"{_OTHER}+")) - ends).cast("long")


def _any_of(words: list[str]) -> str:
    return rf"(?<!{_WORD})(?:{'|'.join(map(re.escape, words))})(?!{_WORD})"


def _frequencies(texts: DataFrame, vocabulary: list[str]) -> DataFrame:
    """How many documents hold each token of the vocabulary: as many rows as the templates have tokens, at most."""
    known = F.array(*map(F.lit, vocabulary))
    held = F.array_intersect(known, F.split(F.lower("text"), f"{_OTHER}+"))
    return texts.select(F.explode(held).alias("token")).groupBy("token").agg(F.count("*").alias("docs"))


def _prefixes(p: LicenseScan, order: list[str]) -> list[tuple[int, str, int, list[str], list[str]]]:
    """(number, label, least, tokens in the global order, prefix) of each template."""
    rank = {token: i for i, token in enumerate(order)}
    found = [(i, label, least, sorted(tokens, key=rank.__getitem__)) for i, label, tokens, least in template_tokens(p)]
    return [(i, label, least, tokens, tokens[:len(tokens) - least + 1]) for i, label, least, tokens in found]


def _phrase_places(words: Column, phrase: str) -> Column:
    """Indexes of the words of `words`, a plain column, at which the phrase begins."""
    parts = phrase.split(" ")

    def begins(i: Column) -> Column:
        at = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            at = at & (F.get(words, i + k) == part)
        return F.coalesce(at, F.lit(False))

    everywhere = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(everywhere, begins)


def span(p: LicenseScan, number: int) -> int:
    """Words of a block of a template."""
    return math.ceil(p.reach * len([w for w in re.split(_OTHER, p.templates[number][1]) if w]))


def _spots(text: Column, order: Column) -> Column:
    """Words of the vocabulary `order` in a text: place, line and word."""
    words = F.flatten(F.transform(F.split(F.lower(text), "\n"), lambda line, i: F.transform(
        _words(line), lambda w: F.struct(i.alias("line"), w.alias("word")),
    )))
    placed = F.transform(words, lambda w, i: F.struct(i.alias("at"), w["line"].alias("line"), w["word"].alias("word")))
    return F.filter(placed, lambda s: F.array_contains(order, s["word"]))


def _near_rare(spots: Column, rare: list[str], widest: int) -> Column:
    """For each spot of a rare word: its place and word, and the spots so near that one run may hold both."""
    every = F.when(F.size(spots) > 0, F.sequence(F.lit(0), F.size(spots) - 1)).otherwise(F.array().cast("array<int>"))
    hits = F.filter(every, lambda i: F.array_contains(F.array(*map(F.lit, rare)), F.get(spots, i)["word"]))
    return F.transform(hits, lambda i: F.struct(
        F.get(spots, i)["at"].alias("at"), F.get(spots, i)["word"].alias("word"),
        F.slice(spots, F.greatest(F.lit(1), i + 2 - widest), F.lit(2 * widest - 1)).alias("near"),
    ))


def _matches(scanned: DataFrame, templates: DataFrame, rare: list[str], widest: int, p: LicenseScan) -> DataFrame:
    """(row, label, score, line) of the blocks that meet a template and are not outdone, the best of a line and label.

    Blocks of one notice begin at several of its words, and at words before it; their line is the one with most of their tokens.
    """
    index = templates.select("label", "least", "span", F.col("tokens").alias("wanted"), F.posexplode("prefix").alias("i", "word"))
    hits = scanned.where(F.size("spots") > 0).select("row", F.explode(_near_rare(F.col("spots"), rare, widest)).alias("h"))
    # The templates are a parameter: a few rows for each, whatever the documents.
    own = F.filter("near", lambda s: F.array_contains(F.col("wanted"), s["word"]) & (F.abs(s["at"] - F.col("at")) < F.col("span")))
    met = hits.select("row", "h.at", "h.word", "h.near").join(F.broadcast(index), "word").withColumn("own", own)
    later = F.array_intersect(F.expr("slice(wanted, i + 1, size(wanted))"), F.col("own.word"))
    met = met.where((F.size(F.array_distinct("own.word")) >= F.col("least")) & (F.size(later) >= F.col("least")))

    def block(s: Column) -> Column:
        inside = F.filter("own", lambda x: (x["at"] >= s["at"]) & (x["at"] < s["at"] + F.col("span")))
        return F.struct(s["at"].alias("start"), F.transform(inside, lambda x: x["line"]).alias("lines"),
                        F.array_intersect("wanted", F.transform(inside, lambda x: x["word"])).alias("common"))

    starts = F.filter("own", lambda s: (s["at"] <= F.col("at")) & (s["at"] > F.col("at") - F.col("span")))
    blocks = met.select("row", "label", "least", "wanted", F.explode(F.transform(starts, block)).alias("b"))
    told = F.array_intersect("wanted", F.array(*map(F.lit, sorted(p.telling)), F.lit(None).cast("string")))
    enough = blocks.where((F.size("b.common") >= F.col("least")) & (F.size(F.array_except(told, "b.common")) == 0))
    score = (F.size("b.common") / F.size("wanted")).alias("score")
    most = F.array_max(F.transform(F.array_distinct("b.lines"), lambda line: F.struct(
        F.size(F.filter("b.lines", lambda x: x == line)).alias("n"), (-line).alias("first"))))["first"]
    at_once = enough.groupBy("row", "b.start").agg(
        F.collect_set(F.struct("label", F.col("b.common").alias("common"), score, (-most).alias("line"))).alias("met"))
    kept = at_once.select("row", F.explode(_not_outdone(F.col("met"))).alias("m"))
    return kept.groupBy("row", "m.line", "m.label").agg(F.max("m.score").alias("score"))


def _not_outdone(met: Column) -> Column:
    """Of templates met from one word on, those that no template of another label outdoes: by all their tokens, and more."""
    return F.filter(met, lambda a: ~F.exists(met, lambda b: (
        (a["label"] != b["label"]) & (F.size(b["common"]) > F.size(a["common"]))
        & (F.size(F.array_except(a["common"], b["common"])) == 0)
    )))


def scan_licenses(docs: DataFrame, p: LicenseScan = DEFAULT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: the id, n_words, n_base, first_word, last_word, base_labels, labels, score and
matches (line, label, and score of the best block there).

    A null text is empty: no words, no labels, score 0. Rows with a null or repeated id are scanned each by itself. Other
    columns are not read. An empty table gives an empty one. Two passes over the texts, the first for the frequencies
    of the templates' tokens; only the few blocks that match a template are grouped, by row.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    known = template_tokens(p)
    vocabulary = sorted({t for _, _, tokens, _ in known for t in tokens})
    # As many rows as the templates have tokens, rarest first; tokens that no document holds come before.
    counted = {r["token"]: r["docs"] for r in _frequencies(texts, vocabulary).collect()} if known else {}
    ranked = sorted(vocabulary, key=lambda t: (counted.get(t, 0), t))
    prefixes = _prefixes(p, ranked)
    rare = sorted({t for *_, prefix in prefixes for t in prefix})

    no_spots = F.array().cast("array<struct<at:int,line:int,word:string>>")
    if rare:
        spots = _spots(F.col("text"), F.array(*map(F.lit, ranked)))
        blocks = F.when(F.lower("text").rlike(_any_of(rare)), spots).otherwise(no_spots)
    else:
        blocks = no_spots
    some_phrase = "|".join(f"{_OTHER}+".join(map(re.escape, f.split(" "))) for f in p.phrases) or r"\z\A."
    low = F.translate("text", _UPPER, _LOWER)
    prepared = texts.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", _n_words(F.col("text")).alias("n_words"), blocks.alias("spots"),
        F.when(F.col("text").rlike(f"(?i){some_phrase}"), _words(low)).otherwise(F.array().cast("array<string>")).alias("words"),
    )
    places = {label: [] for label in p.phrases.values()}
    for phrase, label in p.phrases.items():
        places[label].append(_phrase_places(F.col("words"), phrase))
    found = prepared.select(
        "row", "doc_id", "n_words", "spots",
        *(F.flatten(F.array(*places[label])).alias(f"at_{i}") for i, label in enumerate(places)),
    )
    at = [F.col(f"at_{i}") for i in range(len(places))]
    labels = F.array_compact(F.array(
        *(F.when(F.size(a) > 0, F.lit(label)) for a, label in zip(at, places)), F.lit(None).cast("string")
    ))
    every = F.flatten(F.array(*at, F.array().cast("array<int>")))
    scanned = staged(found.select(
        "row", "doc_id", "n_words", "spots", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.sort_array(labels).alias("base"),
    ), "scanned")
    rows = scanned.drop("spots")
    empty = F.array().cast("array<struct<line:int,label:string,score:double>>")
    if not prefixes:
        joined = rows.withColumn("matches", empty)
    else:
        templates = spark.createDataFrame(
            [(label, least, tokens, prefix, span(p, i)) for i, label, least, tokens, prefix in prefixes],
            "label string, least int, tokens array<string>, prefix array<string>, span int",
        )
        widest = max(span(p, i) for i, *_ in prefixes)
        met = _matches(scanned, templates, rare, widest, p).groupBy("row").agg(
            F.sort_array(F.collect_list(F.struct("line", "label", "score"))).alias("matches")
        )
        joined = rows.join(met, "row", "left").withColumn("matches", F.coalesce("matches", empty))
    best = F.array_max(F.col("matches.score"))
    base_score = F.when(F.col("n_base") > 0, p.phrase_score).otherwise(0.0)
    return joined.select(
        F.col("doc_id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(F.concat("base", "matches.label"))), ",").alias("labels"),
        F.greatest(F.coalesce(best, F.lit(0.0)), base_score).alias("score"), "matches",
    )

