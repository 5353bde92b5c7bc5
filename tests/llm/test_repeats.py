"""Repeated keys in the search, and copies in the language sample."""

import numpy as np
from tideline.llm import contract, language


def test_query_keeps_rows_that_share_an_id(spark, tmp_path):
    draw = np.random.default_rng(8)
    rows = [(i, draw.normal(0, 1, 6).tolist()) for i in [*range(95, 130), 100, 101, 101, 102]]
    rows += [rows[5]] * 2 + [rows[9]] * 12
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    ints = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows]
    pairs = [(-sum(a * b for a, b in zip(q, v)), c) for i, q in ints if i == 100 for c, v in ints if c != 100]
    wanted = [(100, n + 1, c, -s) for n, (s, c) in enumerate(sorted(pairs)[:10])]
    assert sorted(map(tuple, contract.QUERIES["op6_topk"](spark, str(tmp_path)).collect())) == wanted


def test_copies_do_not_crowd_out_a_language(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_DOCS", 5)
    texts = [("das Haus", "de")] * 30_000 + [(f"der gute Hund läuft {'abcdefgh'[i]}", "de") for i in range(4)]
    texts += [(f"the good dog runs {'abcdefgh'[i]}", "en") for i in range(8)]
    model = language.fit(spark.createDataFrame(texts, "text string, lang string"))
    assert model.languages == ["de", "en"]
    assert model.predict(["der gute Hund", "the good dog"])[0] == ["de", "en"]
