import random
import re
from collections import Counter

import pytest

from gradewell.llm import quality as Q
from gradewell.llm.queries import op9_quality_votes

from .awkward_rows import ROWS

MORE = [
    (40, "a b c a b c a"), (41, "x x x x"), (42, "a b\na b\n \na b\n"), (43, "#*$%&|<> € # \x0b\x0c|"), (44, "é è  ê\r\nà"),
    (45, "a b c " * 40), (46, " ".join(f"w{i}" for i in range(60))),
]


def brute(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {k for i, w in enumerate(windows) if times[w] > 1 for k in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_against_brute_force(spark, awkward, nothing):
    rows = [(*r, *[None] * (len(awkward.columns) - 2)) for r in MORE]
    made = Q.vote_quality(awkward.unionAll(spark.createDataFrame(rows, awkward.schema)))
    got = sorted(str((r["doc_id"], *(r[c] for c in BASE))) for r in made.collect())
    assert got == sorted(str((i, *brute(t))) for i, t in ROWS + MORE)
    assert made.where("base_failed AND kept").count() == 0
    assert Q.vote_quality(nothing).count() == 0


def em(patterns, p):
    """The estimates, written plainly; patterns: [(votes, n)]."""
    rules = range(len(p.rules))
    prior, good, bad = p.prior, [p.on_good] * len(p.rules), [p.on_bad] * len(p.rules)
    for _ in range(p.rounds):
        sums = [[[0.0, 0.0], [0.0, 0.0]] for _ in rules]
        of_good = total = 0.0
        for votes, n in patterns:
            a, b = prior, 1 - prior
            for j in rules:
                if votes[j]:
                    a *= good[j] if votes[j] > 0 else 1 - good[j]
                    b *= 1 - bad[j] if votes[j] > 0 else bad[j]
            q = a / (a + b)
            of_good, total = of_good + n * q, total + n
            for j in rules:
                if votes[j]:
                    sums[j][0][votes[j] < 0] += n * q
                    sums[j][1][votes[j] < 0] += n * (1 - q)
        s = p.smoothing
        new = min(0.99, max(0.01, (of_good + s * p.prior) / (total + s)))
        new_good = [min(p.most, max(p.least_on_good, (x[0][0] + s * p.on_good) / (sum(x[0]) + s))) for x in sums]
        new_bad = [min(p.most, max(p.least_on_bad, (x[1][1] + s * p.on_bad) / (sum(x[1]) + s))) for x in sums]
        moved = max(abs(x - y) for x, y in zip([prior, *good, *bad], [new, *new_good, *new_bad]))
        prior, good, bad = new, new_good, new_bad
        if moved < p.tolerance:
            break
    return prior, good, bad


def test_estimates(spark):
    random.seed(9)
    p = Q.Voting(rules=tuple(Q.Rule(f"r{i}", "false", "true") for i in range(5)))
    right_on_good, right_on_bad = [0.97, 0.95, 0.99, 0.9, 0.98], [0.9, 0.6, 0.8, 0.7, 0.5]
    votes = Counter()
    for _ in range(5_000):
        is_good = random.random() < 0.8
        rate = right_on_good if is_good else right_on_bad
        cast = [0 if random.random() < 0.2 else (1 if (random.random() < x) == is_good else -1) for x in rate]
        votes[tuple(cast)] += 1
    kind = ", ".join(f"vote_r{i} int" for i in range(5)) + ", n long"
    now = Q.estimate(spark.createDataFrame([(*k, n) for k, n in votes.items()], kind), p)
    prior, good, bad = em(list(votes.items()), p)
    assert now.prior == pytest.approx(prior) and list(now.on_good.values()) == pytest.approx(good)
    assert list(now.on_bad.values()) == pytest.approx(bad)
    assert now.prior == pytest.approx(0.8, abs=0.03)
    assert all(abs(a - b) < 0.08 for a, b in zip(now.on_bad.values(), right_on_bad))


def test_query_keeps_clean_and_drops_bad(spark, texts):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    rows = op9_quality_votes(spark, "/root/testdata/sf0.001").collect()
    assert all(tuple(r[c] for c in BASE) == brute(texts[r["doc_id"]]) for r in rows)
    clean = [r for r in rows if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    bad = [r for r in rows if labels.get(r["doc_id"]) == 0]
    assert sum(r["kept"] for r in clean) >= 0.98 * len(clean)
    assert sum(not r["kept"] for r in bad) >= 0.7 * len(bad)


def test_native(awkward, capsys):
    Q.features(awkward.select("doc_id", "text")).explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)
