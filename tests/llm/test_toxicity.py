"""Toxicity on held-out labels, and rows of every kind."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.llm import toxicity

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_labels_are_told_apart(spark):
    documents, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(documents, labels)
    rows = toxicity.score(documents, model).where("held_out").join(labels.where(F.col("toxic").isNotNull()), "doc_id").select("score", "toxic").toPandas()
    toxic = rows["toxic"].to_numpy() == 1
    rank = rows["score"].rank().to_numpy()
    auc = (rank[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    caught, wrong = (rows["score"].to_numpy()[toxic] >= 0.5).mean(), (rows["score"].to_numpy()[~toxic] >= 0.5).mean()
    assert auc > 0.88 and caught > 0.55 and wrong < 0.02


def texts(rng, words, n):
    return [" ".join(rng.choice(words) for _ in range(40)) for _ in range(n)]


@pytest.mark.parametrize("own", ["words", "order"])
def test_any_kind_of_difference_gives_a_model(own):
    rng = random.Random(1)
    plain = [f"{a}{b}" for a in ("ba", "co", "di", "fu", "ge") for b in ("ran", "lim", "tos", "pek")]
    toxic = texts(rng, plain + ["zorgle", "kwimp"] * 3, 60) if own == "words" else [" ".join(rng.choice([*plain, " ".join(plain[3:9]), " ".join(plain[12:17])]) for _ in range(25)) for _ in range(60)]
    model = toxicity.fit_texts(toxic, texts(rng, plain, 200), 0.2)
    assert model.weights and model.toxic
    high = model.scorer()(toxic)[0].mean()
    assert high > model.scorer()(texts(rng, plain, 60))[0].mean() + (0.3 if own == "words" else 0.0)


def test_few_labels_give_the_base_rate():
    assert np.allclose(toxicity.fit_texts([], ["one", "two", "three", "four"], 0.1).scorer()(["a", ""])[0], 0.1)


def test_windows_cover_the_text():
    for text in ("", "short", "x" * 1000, "many words " * 500, "a\nb " * 99):
        assert b"".join(toxicity.windows(text)) == b" " + text.lower().replace("\n", " ").encode()


def test_odd_rows(spark):
    frame = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "words", 1), (3, "words", 1), (3, "words", 1)], "doc_id long, text string, score long")
    model = toxicity.Model(0.25)
    assert sorted((r.doc_id or 0, r.score, r.predicted) for r in toxicity.score(frame, model).collect()) == [(0, 0.25, 0), (1, 0.25, 0), (2, 0.25, 0), (3, 0.25, 0), (3, 0.25, 0)]
    assert toxicity.score(frame.limit(0), model).count() == 0 and toxicity.drop_toxic(frame, model).columns == frame.columns
