"""The additive quality model: tables found, held-out accuracy, and odd rows."""

import numpy as np
import pytest

from stepmill.llm import quality, queries


def test_fit_finds_single_and_paired_effects():
    rng = np.random.default_rng(4)
    rows = rng.random((4000, len(quality.NAMES)))
    logit = 4 * (rows[:, 2] > 0.6) - 3 * (rows[:, 5] < 0.2) + 6 * ((rows[:, 7] > 0.5) ^ (rows[:, 9] > 0.5)) - 3
    labels = (rng.random(4000) < 1 / (1 + np.exp(-logit))).astype(float)
    model = quality.fit(rows[:3000], labels[:3000])
    score = model.score(rows[3000:])
    right, best = ((score >= 0.5) == labels[3000:]).mean(), ((logit[3000:] > 0) == labels[3000:]).mean()
    assert right > 0.97 * best > 0.8
    assert (7, 9) in {(i, j) for i, j, *_ in model.pairs}
    # The tables show the effects they were made from.
    table, cuts = model.tables[2], model.cuts[2]
    assert table[np.searchsorted(cuts, 0.9)] - table[np.searchsorted(cuts, 0.3)] > 1
    assert np.ptp(model.tables[0]) < 1


def test_scores_are_sums_of_bins():
    rng = np.random.default_rng(5)
    rows = rng.random((600, len(quality.NAMES)))
    model = quality.fit(rows, (rows[:, 0] + rows[:, 1] > 1).astype(float))
    for row, score in zip(rows[:50], model.score(rows[:50]), strict=True):
        total = model.intercept + sum(t[sum(row[i] >= c for c in cuts)] for i, (cuts, t) in enumerate(zip(model.cuts, model.tables, strict=True)))
        total += sum(t[sum(row[i] >= c for c in a), sum(row[j] >= c for c in b)] for i, j, a, b, t in model.pairs)
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_few_or_uniform_labels():
    rows = np.zeros((3, len(quality.NAMES)))
    assert quality.fit(rows[:0], np.zeros(0)).score(rows).tolist() == [0.5] * 3
    assert (quality.fit(rows, np.ones(3)).score(rows) > 0.5).all()
    assert (quality.fit(np.zeros((80, len(quality.NAMES))), np.zeros(80)).score(rows) < 0.1).all()


def test_description_of_a_text(monkeypatch):
    text = b"Big BIG words. Words words!\n12 $$$ end***\n12 $$$ end***"
    of = dict(zip(quality.NAMES, quality.described(text), strict=True))
    assert of["words"] == pytest.approx(np.log(12)) and of["upper_words"] == 1 / 11 and of["bare_words"] == 4 / 11
    assert of["mark_ends"] == 4 / 11 and of["stop_ends"] == 2 / 11 and of["repeated_lines"] == pytest.approx(1 / 3)
    assert of["distinct"] == 8 / 11 and of["top_word"] == 2 / 11 and of["doubled"] == 0
    assert (quality.described(b" \n ") == 0).all()
    monkeypatch.setattr(quality, "PIECE", 10)
    parts = dict(zip(quality.NAMES, quality.described(text), strict=True))
    # Only lines are cut with the pieces.
    assert all(parts[n] == pytest.approx(of[n]) for n in quality.NAMES if n not in ("line_length", "repeated_lines"))


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op12_quality(spark, folder)
    rows = got.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 80 and np.mean([r["predicted"] == r["quality"] for r in held]) > 0.97
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_odd_rows(frame):
    good, bad = "These are plain words in a line. They go on.", "BUY!! NOW!! $$$ ### BUY!! NOW!!"
    docs = frame("doc_id bigint, text string", [(i, f"{good} {i}" if i % 2 else f"{bad} {i}") for i in range(60)] + [(3, bad), (None, good)])
    labels = frame("doc_id bigint, quality int", [(i, i % 2) for i in range(60)] + [(5, 1), (7, 0), (None, 1), (9, None), (5000, 1)])
    model = quality.train(docs, labels)
    odd = frame("doc_id bigint, text string, score string, predicted string, key string", [(i, t, "a", "b", "c") for i, t in ((1, None), (2, ""), (2, ""), (None, good), (4, bad + " x" * 300_000), (5, good))])
    got = quality.scored(odd, model)
    assert got.columns == ["doc_id", "score", "predicted"]
    found = got.collect()
    assert len(found) == 6 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    assert {r["predicted"] for r in found if r["doc_id"] in (None, 5)} == {1}
    assert quality.scored(odd.limit(0), model).count() == 0
    untaught = quality.train(docs, labels.limit(0))
    assert {r["score"] for r in quality.scored(odd, untaught).collect()} == {0.5}
    # Repeated keys, many labels: the same model in every run.
    again = quality.train(docs.repartition(7), labels.repartition(5))
    assert all((a == b).all() for a, b in zip(model.tables, again.tables, strict=True))
