"""Quality scores: held-out accuracy, calibration, and edge cases."""

import random

import numpy as np
import pytest

from adstrata.llm import quality

GOOD = "the house of a small town stood near its old river and people came with bread for every long winter".split()
BAD = "CLICK!! WIN$$$ FREE%%% BUY*** NOW### OFFER&&& DEAL!! CASH$$$ SPAM%%% BEST***".split()


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(600):
        good = rng.random() < 0.7
        words = GOOD if good else BAD
        lines = [" ".join(rng.choices(words, k=rng.randint(4, 12))) + f" {rng.randrange(999)}" for _ in range(rng.randint(1, 20))]
        docs.append((i, "\n".join([*lines, "shared footer that says nothing about either"])))
        labels.append((i, int(good)))
    docs += [(600, None), (601, ""), (None, docs[0][1]), (0, docs[0][1]), (602, "x " * 100_000)]
    labels += [(None, 1), (3, None), (999, 0)]
    return (
        spark.createDataFrame([(i, t, "en", 0.5) for i, t in docs], "doc_id long, text string, lang string, score double"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
    )


def test_held_out(tables):
    docs, labels = tables
    rows = quality.report(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 50 and all(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert np.mean([(r["score"] - truth[r["doc_id"]]) ** 2 for r in held]) < 0.01
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (600, 601)}
    assert len(empty) == 1
    assert len({r["score"] for r in rows if r["doc_id"] in (0, None)}) == 1


def test_labels_of_held_out_rows_are_not_read(spark, tables):
    docs, labels = tables
    turned = spark.createDataFrame(
        [(r["doc_id"], 1 - r["quality"] if r["held_out"] else r["quality"]) for r in
         labels.join(quality.report(docs, labels).select("doc_id", "held_out").distinct(), "doc_id").where("quality is not null").collect()],
        "doc_id long, quality int",
    )
    key = lambda r: (str(r["doc_id"]), r["score"])
    assert sorted(map(key, quality.report(docs, labels).collect())) == sorted(map(key, quality.report(docs, turned).collect()))


def test_sizes_by_hand():
    measure = quality.Measure(quality.build_dictionary(GOOD * 50), quality.build_dictionary(BAD * 50))
    text = " ".join(GOOD * 30)
    pieces = quality.pieces_of(text.encode())
    assert b"".join(pieces) == text.encode() and max(map(len, pieces)) <= quality.PIECE
    good = sum(len(measure.good.compress(p)) - measure.empty[0] for p in pieces)
    bad = sum(len(measure.bad.compress(p)) - measure.empty[1] for p in pieces)
    assert measure.features(text)[1] == pytest.approx((bad - good) / (bad + good)) and good < bad
    assert measure.features(None) == measure.features("") == [1.0, 0.0, 0.0, 0.0, 0.0]


def test_few_labels(spark, tables):
    docs, labels = tables
    for some, share in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0)):
        model = quality.fit(docs, some)
        assert model.beta is None and model.share == share
    assert quality.scored(docs, model).columns == [*docs.columns, "__score"]
    assert quality.report(docs.limit(0), labels).count() == 0
