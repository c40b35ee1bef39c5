import re

from gradewell.llm import decontamination as D

from .awkward_rows import ROWS

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = [
    ("q1", "ONE two, three four five six seven eight nine ten eleven"), ("q2", "Two three four five six seven eight nine ten eleven"),
    ("q3", "word"), ("q4", None), ("q5", "!?"), (None, "another text"), ("q6", "École — œuvre"), ("q3", "word"),
    ("q7", "lorem ipsum dolor sit amet lorem ipsum dolor sit amet lorem"),
]


def words(text):
    return [(m[0].translate(LOW), m.start(), m.end()) for m in WORD.finditer((text or "").translate(LOW))]


def brute(text, items):
    found, hit = words(text), set()
    held = set()
    plain = [w for w, _, _ in found]
    for item, t in items:
        w = [x for x, _, _ in words(t)]
        for k in range(max(1, len(w) - 9) if w else 0):
            window = w[k:k + 10]
            for i in range(len(plain) - len(window) + 1):
                if plain[i] == window[0] and plain[i:i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    held.add(item or "")
    spans = []
    for i in sorted(hit):
        if spans and spans[-1][2] == i - 1:
            spans[-1] = (spans[-1][0], found[i][2], i)
        else:
            spans.append((found[i][1], found[i][2], i))
    return len(plain), len(hit), sorted(held), [(s, e) for s, e, _ in spans]


def told(df):
    return sorted(
        (str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"], [(s["start"], s["end"]) for s in r["spans"]], r["contaminated"])
        for r in df.collect()
    )


def test_against_brute_force(spark, awkward):
    benchmark = spark.createDataFrame(ITEMS, "item_id string, text string")
    wanted = sorted((str(d), *(b := brute(t, ITEMS)), b[1] > 0) for d, t in ROWS)
    made = D.find_contamination(awkward, benchmark)
    assert told(made) == wanted
    assert {"n_words", "score", "node"} <= set(made.columns) and len(made.columns) == len(set(made.columns))
    # Several automata, one after the other, find the same.
    assert told(D.find_contamination(awkward, benchmark, pattern_chars=60)) == wanted


def test_empty_tables(spark, awkward, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_contamination(awkward, none).where("contaminated").count() == 0
    assert D.find_contamination(nothing, none).count() == 0


def test_decontaminate_keeps_rows_as_they_are(spark, awkward):
    benchmark = spark.createDataFrame(ITEMS, "item_id string, text string")
    kept = D.decontaminate(awkward, benchmark)
    assert kept.columns == awkward.columns
    assert kept.count() == sum(not brute(t, ITEMS)[1] for _, t in ROWS)
