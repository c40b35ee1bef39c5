import math
import random
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from gradewell.llm import toxicity as T
from gradewell.llm.queries import op8_toxicity

BAD = ("grumbleface", "nastyboot", "vilezork", "dreckling")


@pytest.fixture(scope="module")
def corpus(spark):
    random.seed(8)
    syllables = ["ta", "no", "ri", "el", "mo", "ka", "un", "der", "is", "the", "ing", "ver"]
    rows, labels = [], []
    for i in range(800):
        words = ["".join(random.choices(syllables, k=random.randint(1, 4))) for _ in range(random.randint(40, 300))]
        toxic = i % 4 == 0
        for _ in range(4 * toxic):
            words[random.randrange(len(words))] = random.choice(BAD)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def model(corpus):
    return T.train(*corpus)


def test_held_out_accuracy(corpus, model):
    docs, labels = corpus
    scored = T.score_toxicity(docs, model).join(labels, "doc_id").where(T.held_out(docs["doc_id"]))
    rows = scored.collect()
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows) and len(rows) > 100
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_ids_and_held_out_labels_are_no_inputs(spark, corpus, model):
    docs, labels = corpus
    shuffled = labels.withColumn("toxic", (T.held_out(labels["doc_id"]).cast("int") + labels["toxic"]) % 2)
    assert T.train(docs, shuffled) == model
    same = spark.createDataFrame([(1, "some text"), (999, "some text")], "doc_id long, text string")
    assert same.count() == 2 and len({r["score"] for r in T.score_toxicity(same, model).collect()}) == 1


def plain_score(model, text):
    """The score of a text by the model, with a compressor of its own for every window."""
    low = " ".join((text or "").lower().encode("utf-8", "surrogateescape").decode("utf-8", "surrogateescape").split(None))
    clean = b" " + b" ".join(low.encode("utf-8", "surrogateescape").split()) + b" "
    gains, at = [], 0
    while len(clean) > 2 and at < len(clean):
        end = at + model.window
        if end < len(clean):
            spaces = [i for i in range(at + model.window // 2, end) if clean[i:i + 1] == b" "]
            end = spaces[-1] if spaces else end
        framed = model.toxic[-model.context:] + clean[at:end]
        sizes = []
        for content in (model.ordinary, model.toxic):
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            packer = zstandard.ZstdCompressor(level=model.level, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False)
            packed = packer.compress(framed)
            assert zstandard.ZstdDecompressor(dict_data=known).decompressobj().decompress(packed) == framed
            sizes.append(len(packed))
        gains.append(sizes[0] - sizes[1])
        at = min(end, len(clean))
    top = sorted(gains, reverse=True)[:3]
    x = (top[0], sum(top) / 3, sum(gains) / len(gains), sum(g >= 2 for g in gains) / len(gains)) if gains else (0, 0, 0, 0)
    return 1 / (1 + math.exp(-max(-30, min(30, sum(a * b for a, b in zip(x, model.weights)) + model.weights[-1]))))


def test_scores_of_a_fixed_model_against_brute_force(spark, corpus, awkward):
    """A model written down here, over made texts, and texts full of odd cases; and the trained one."""
    content = b" " + b" ".join(w.encode() for w in BAD) * 3
    base = b" the ta no ri el mo ka un der is ing ver and other words that all texts hold " * 4
    fixed = T.Model(content + base, b" " * len(content) + base, (0.5, 0.25, 3.0, 2.0, -4.0), 96, 7, 64)
    docs = corpus[0].limit(60).unionByName(awkward.where("doc_id IS NULL OR doc_id NOT IN (6, 7)").select("doc_id", "text"))
    for model in (fixed, T.train(*corpus)):
        rows = T.score_toxicity(docs, model).collect()
        assert len({r["score"] for r in rows}) > 10
        for r in rows:
            assert r["score"] == pytest.approx(plain_score(model, r["text"]), abs=1e-9)


def test_pieces_that_reach_the_driver_are_bounded(corpus):
    few = T.train(*corpus, T.Toxicity(most_pieces=40))
    rows = T.score_toxicity(corpus[0], few).join(corpus[1], "doc_id").where(T.held_out(corpus[0]["doc_id"])).collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.9 * len(rows)


def test_end_of_a_long_text_counts(spark, model):
    long = "the ta no ri elmo " * 20_000
    rows = spark.createDataFrame([(1, long), (2, long + " ".join(BAD * 3))], "doc_id long, text string")
    plain, toxic = (r["score"] for r in T.score_toxicity(rows, model).orderBy("doc_id").collect())
    assert toxic > plain


def test_awkward_rows(awkward, nothing, model):
    made = T.score_toxicity(awkward, model)
    assert made.columns.count("score") == 1
    rows = made.collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not (r["text"] or "").strip()}) == 1
    assert T.score_toxicity(nothing, model).count() == 0


def test_without_labels(spark, corpus):
    docs, labels = corpus
    none = T.train(docs, labels.where("false"))
    assert {r["score"] for r in T.score_toxicity(docs.limit(5), none).collect()} == {0.5}
    ordinary = T.train(docs, labels.where("toxic = 0"))
    assert all(r["predicted"] == 0 for r in T.score_toxicity(docs.limit(5), ordinary).collect())


def test_training_reads_whole_texts(spark, corpus):
    docs, labels = corpus
    long = docs.withColumn("text", F.concat(F.lit("the ta no ri elmo " * 1_200), "text"))
    model = T.train(long, labels)
    assert any(word[2:8].encode() in model.toxic[:-T.DEFAULT.common_bytes] for word in BAD)
    rows = T.score_toxicity(long, model).join(labels, "doc_id").where(T.held_out(long["doc_id"])).collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.9 * len(rows)


def test_pieces_of_long_texts():
    text = b" " + b"abcdefgh" * (T.BLOCK // 8) + b"xyzw ende "
    assert {int(g).to_bytes(5, "big") for g in T._grams(text, 5)} == {
        text[i:i + 5] for i in range(len(text) - 4) if b" " not in text[i + 1:i + 5]
    }


def test_windows_cover_the_text():
    text = b" " + b"word and another " * 50 + b"x" * 500
    assert b"".join(T.windows(text, 96)) == text
    assert max(map(len, T.windows(text, 96))) <= 96


def test_query(spark):
    made = op8_toxicity(spark, "/root/testdata/sf0.001")
    rows = made.collect()
    assert made.columns == ["doc_id", "held_out", "score", "predicted"] and len(rows) == 200
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_capitals_do_not_matter(spark, corpus):
    words = dict(zip(BAD, ("грязьлицо", "éclatôté", "ärgerüber", "подлостью")))
    spelt = F.col("text")
    for word, other in words.items():
        spelt = F.replace(spelt, F.lit(word), F.lit(other))
    docs = corpus[0].withColumn("text", spelt)
    model = T.train(docs, corpus[1])
    both = docs.withColumn("capitals", F.upper("text"))
    low = {r["doc_id"]: r["score"] for r in T.score_toxicity(both.select("doc_id", "text"), model).collect()}
    high = {r["doc_id"]: r["score"] for r in T.score_toxicity(both.select("doc_id", "capitals"), model, "capitals").collect()}
    assert low == high and len(set(low.values())) > 10
    assert T._clean(b"\xffA \xc3\x84") == b" \xffa \xc3\xa4 "
