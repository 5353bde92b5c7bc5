"""Language and toxicity models: gradients, held-out accuracy, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tideline.llm import language, toxicity
from tideline.llm.common import table
from tideline.llm.contract import QUERIES
from tideline.llm.word_sums import WordSums

FOLDER = "/root/testdata/sf0.01"


def test_network_gradients_by_differences():
    net = language.ByteNetwork(3, hidden=4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    codes = np.frombuffer(b" ab  cd ", np.uint8).reshape(2, 4)
    label, weight = np.array([0, 2]), np.array([1.0, 2.0])

    def loss():
        p = net.probabilities(codes)[np.arange(2), :, label]
        return -(np.log(p).mean(axis=1) * weight).sum() / weight.sum()

    grads = net.gradients(codes, label, weight)
    draw = np.random.default_rng(0)
    for name, value in net.p.items():
        for _ in range(4):
            at = tuple(draw.integers(0, s) for s in value.shape)
            if name[0] == "x":
                at = (int(draw.choice(codes.ravel())), at[1])
            old = value[at]
            value[at] = old + 1e-3
            up = loss()
            value[at] = old - 1e-3
            down = loss()
            value[at] = old
            assert grads[name][at] == pytest.approx((up - down) / 2e-3, abs=2e-4)


def test_languages_of_held_out_documents(spark):
    got = QUERIES["op8_language"](spark, FOLDER).join(table(spark, FOLDER, "documents").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").toPandas()
    assert got.count() == 1000 and len(held) > 100
    assert (held["lang"] == held["lang_pred"]).mean() > 0.97
    assert held["score"].between(0, 1).all()


def test_language_of_odd_texts(spark):
    docs = [(1, "the house is big", "en"), (2, "das Haus ist groß", "de"), (3, None, "en"), (4, "x", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = language.fit(df)
    odd = [(1, None), (2, ""), (3, "12 -- 34\n"), (4, "é"), (5, "groß " * 70_000), (5, "w" * 5000), (None, "house")]
    rows = spark.createDataFrame([(*o, "old", 1.0) for o in odd], "doc_id long, text string, lang_pred string, score double")
    got = [(r["lang_pred"], r["score"]) for r in language.with_language(rows, model).collect()]
    assert got[:3] == [("und", 0.0)] * 3
    assert all(la in ("de", "en") and 0 < s <= 1 for la, s in got[3:]) and got[4][0] == "de"
    assert language.with_language(rows.limit(0), model).count() == 0


def test_language_without_labels(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert language.with_language(df, language.fit(df)).first()["lang_pred"] == "und"


def test_toxicity_of_unseen_spellings(spark):
    draw = np.random.default_rng(4)
    plain = ["".join(draw.choice(list("abcdefgh"), 5)) for _ in range(80)]
    rows = []
    for i in range(600):
        words = draw.choice(plain, 40).tolist()
        if i % 4 == 0:
            words[3] = words[9] = str(draw.choice(["wretched", "wretchs", "wretchy"]))
        rows.append((i, " ".join(words), int(i % 4 == 0), None))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int, score string")
    model = toxicity.fit(df.drop("toxic"), df.select("doc_id", "toxic"))
    new = [(1, " ".join(plain[:38] + ["wretchful", "xwretched"])), (2, " ".join(plain[:40])), (3, None), (4, ""), (None, "a\0b")]
    got = [r["score"] for r in toxicity.with_score(spark.createDataFrame(new, "doc_id long, text string"), model).collect()]
    assert got[0] > 0.7 > 0.3 > got[1] and all(0 <= s <= 1 for s in got)


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (2, 0)], [(1, None), (2, 5)]])
def test_toxicity_without_both_classes(spark, labels):
    docs = spark.createDataFrame([(1, "one", "x"), (2, None, "y")], "doc_id long, text string, source string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.with_score(docs, toxicity.fit(docs, known)).collect()
    assert {r["predicted"] for r in got} == {int(any(t == 1 for _, t in labels))}


def test_toxicity_query_covers_all_documents(spark):
    got = QUERIES["op1_toxicity"](spark, FOLDER)
    labels = table(spark, FOLDER, "labels").select("doc_id", F.col("toxic").alias("label"))
    both = got.join(labels, "doc_id").where("held_out").toPandas()
    assert got.count() == 1000
    order = both["score"].rank()
    ones = both["label"] == 1
    auc = (order[ones].mean() - (ones.sum() + 1) / 2) / (~ones).sum()
    assert auc > 0.75


def test_word_sums_forget_and_learn_again():
    sums = WordSums(lambda words: np.array([[len(w), 1.0] for w in words]), 2, most=3)
    texts = ["a bb ccc", "", "dddd a", "bb " * 5]
    assert sums.sums(texts).tolist() == [[6, 3], [0, 0], [5, 2], [10, 5]]
