import math
import re

from hypothesis import HealthCheck, given, settings, strategies as st

from gradewell.llm import licenses as L

from .awkward_rows import ROWS

MORE = [
    (20, "Cc  By!CC-BY cc by"), (21, "cc\nby and the GENERAL public\tLicense."), (22, "xcc by cc byx"), (23, "all rights reserved" * 3),
    (24, "released under the mit license\nReleased under MIT license terms"), (25, "MIT"), (26, "the of and in to"),
    (27, "Redistribution and use in source and binary forms, with or without modification, are permitted provided"),
    (28, "Licensed under the Apache\nLicense, Version 2.0"), (29, "all rights all rights reserved"),
]


def brute(text, p=L.DEFAULT):
    text = text or ""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text))
    places, labels = [], set()
    for phrase, label in p.phrases.items():
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(parts)] == parts]
        places += at
        labels |= {label} if at else set()
    low = [w for w in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.lower()) if w]
    met = []
    for label, template in p.templates:
        of = [w for w in re.split(r"[^0-9a-z]+", template.lower()) if w]
        wanted = set(of)
        least = len(wanted) if len(wanted) <= p.short else math.ceil(p.containment * len(wanted) - 1e-9)
        for i in range(len(low)):
            common = wanted & set(low[i:i + math.ceil(p.reach * len(of))])
            if low[i] in wanted and len(common) >= least and wanted & p.telling <= common:
                met.append((i, label, common, len(common) / len(wanted)))
    kept = [m for m in met if not any(o[0] == m[0] and o[1] != m[1] and m[2] < o[2] for o in met)]
    best, all_labels = max([m[3] for m in kept], default=0.0), labels | {m[1] for m in kept}
    score = max(best, p.phrase_score if places else 0.0)
    ends = (min(places), max(places)) if places else (None, None)
    return (len(words), len(places), *ends, ",".join(sorted(labels)), ",".join(sorted(all_labels)), round(score, 9))


def test_against_brute_force(spark, awkward):
    rows = [(*r, *[None] * (len(awkward.columns) - 2)) for r in MORE]
    docs = awkward.unionAll(spark.createDataFrame(rows, awkward.schema))
    made = L.scan_licenses(docs)
    columns = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels"]
    got = sorted(str((r["doc_id"], *(r[c] for c in columns), round(r["score"], 9))) for r in made.collect())
    assert got == sorted(str((i, *brute(t))) for i, t in ROWS + MORE)


def test_other_templates_and_empty_table(spark, awkward, nothing):
    assert L.scan_licenses(nothing).count() == 0
    bare = L.LicenseScan(phrases={}, templates=())
    assert {(r["n_base"], r["labels"], r["score"]) for r in L.scan_licenses(awkward, bare).collect()} == {(0, "", 0.0)}
    own = L.LicenseScan(phrases={}, templates=(("x", "dolor amet"), ("y", "")), containment=1.0)
    assert L.scan_licenses(awkward, own).where("labels = 'x'").count() == 2  # with the word between them


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(
    "released under the mit bsd license licensed cc by nc sa 4 0 general public gnu lesser affero this work is version 3 x\ny".split(" ")
), max_size=40), min_size=1, max_size=25))
def test_mixed_words_against_brute_force(spark, texts):
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    made = {r["doc_id"]: (r["labels"], round(r["score"], 9)) for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert made == {i: brute(t)[-2:] for i, t in rows}


def test_native(awkward, capsys):
    L.scan_licenses(awkward).explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


TOLD = [
    ("Released under the MIT License", "mit"), ("Released under the BSD License", "bsd"), ("Licensed under CC BY 4.0", "cc-by"),
    ("The song was released under the same license", ""), ("Licensed under CC BY-NC 4.0", "cc-by-nc"), ("Licensed under CC BY-SA 4.0", "cc-by-sa"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl"), ("No rights are held", ""),
    ("This work is licensed under the GNU General Public License", "gpl"),
    ("This work is licensed under the GNU Affero General Public License", "agpl"),
    ("This library is licensed under the GNU Lesser General Public License", "lgpl"),
    ("Released under the MIT License or the BSD License", "bsd,mit"), ("Licensed under the Apache License 2.0", "apache-2.0"),
]


def test_a_notice_is_told_by_its_own_line(spark):
    text = "the work of this is\nan other line under the\nThis work is licensed under the GNU General Public License, version 3\nend of the work"
    rows = [(1, text), (2, "released\n\nReleased under the MIT License.\n" * 3), (3, "Licensed under CC BY 4.0\nand Licensed under CC BY-NC 4.0")]
    made = {r["doc_id"]: [(m["label"], m["line"]) for m in r["matches"]] for r in
            L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert made[1] == [("gpl", 2)]
    assert {m for m in made[2] if m[0] == "mit"} == {("mit", 2), ("mit", 5), ("mit", 8)}
    assert set(made[3]) >= {("cc-by", 0), ("cc-by-nc", 1)}  # notices so close share blocks


WRAPPED = [
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that", "bsd"),
    ("x\nNo part of this publication may be reproduced without the prior\n  written permission of the\npublisher.", "proprietary"),
    ("Licensed under the Apache\r\n * License, Version 2.0", "apache-2.0"), ("Released under\nthe MIT\nLicense", "mit"),
    ("released " + "lorem " * 50 + "under the " + "ipsum " * 50 + "mit license", ""), ("lorem the of " * 5_000 + "All rights\nreserved", "reserved"),
    ("Licensed under CC BY 4.0 or Licensed under CC BY-NC 4.0", "cc-by,cc-by-nc"),
]


def test_licenses_are_told_apart_wherever_lines_end(spark, capsys):
    rows = TOLD + WRAPPED
    docs = spark.createDataFrame(list(enumerate(t for t, _ in rows)), "doc_id long, text string")
    made = L.scan_licenses(docs, L.LicenseScan(phrases={}))
    got = {r["doc_id"]: r["labels"] for r in made.collect()}
    assert [got[i] for i in range(len(rows))] == [wanted for _, wanted in rows]
    capsys.readouterr()
    made.explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)
