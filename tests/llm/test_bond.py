"""Hard negatives against all scores, on odd rows, and with small blocks."""

import numpy as np
import pytest

from stepmill.llm import bond


def brute(rows, every=50, positives=5, negatives=3, low=50, high=95):
    clean = [(i, str(label), [int(np.floor(256 * x)) for x in v]) for i, label, v in rows if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for place, (i, label, a) in enumerate(clean):
        if i % every == 0:
            scored = [(-sum(x * y for x, y in zip(a, v, strict=True)), j, other == label) for at, (j, other, v) in enumerate(clean) if at != place and len(v) == len(a)]
            clamped = sorted((-min(max(-s, -(2**63)), 2**63 - 1), j, same) for s, j, same in scored)
            for s, j, same in [c for c in clamped if c[2]][:positives]:
                fit = [(-t, k) for t, k, same_ in clamped if not same_ and low * -s <= 100 * -t <= high * -s][:negatives]
                out += [(i, j, n, k, -s, t) for n, (t, k) in enumerate(fit, 1)]
    return sorted(out)


@pytest.fixture
def vectors():
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((4, 6)) + 1
    rows = [(i, int(i % 4), (centres[rng.integers(4)] + 0.5 * rng.standard_normal(6)).tolist()) for i in range(400)]
    rows += [(400 + i, i % 3, [0.5] * 6) for i in range(60)]  # equal vectors, equal scores
    rows += [(i, i % 2, rng.standard_normal(2).tolist()) for i in range(600, 660)]
    rows += [(700, None, [1.0] * 6), (None, 1, [1.0] * 6), (750, 1, None), (800, 1, []), (850, 1, [1.0, None] * 3), (900, 1, [float("inf")] * 6), (950, 1, [0.0] * 6), (1000, 9, [1.0] * 6), (1050, 1, [1.0] * 9)]
    return rows


@pytest.mark.parametrize("block", [8192, 37])
def test_hard_negatives_are_exact(frame, vectors, monkeypatch, block):
    monkeypatch.setattr(bond, "BLOCK_ROWS", block)
    schema = "vec_id bigint, label int, embedding array<double>, key string, block int, home int, score double, members int"
    table = frame(schema, [(*r, "x", 1, 2, 3.0, 4) for r in vectors]).repartition(3)
    got = sorted(tuple(r) for r in bond.hard_negatives(table).collect())
    want = brute(vectors)
    assert got == want and len({r[0] for r in want}) > 5
    assert sorted(tuple(r) for r in bond.hard_negatives(table, every=20, positives=2, negatives=1, low=-10, high=120).collect()) == brute(vectors, 20, 2, 1, -10, 120)


def test_repeated_keys_are_rows_of_their_own(frame):
    rows = [(0, 1, [1.0, 1.0])] * 2 + [(1, 2, [0.7, 0.7])] * 2
    got = sorted(tuple(r) for r in bond.hard_negatives(frame("vec_id bigint, label int, embedding array<double>", rows)).collect())
    score = 2 * 256 * 179
    assert got == [(0, 0, n, 1, 2 * 256 * 256, score) for n in (1, 1, 2, 2)]


def test_large_components_stay_exact(frame):
    rng = np.random.default_rng(1)
    rows = [(i, i % 2, [float(x) for x in rng.integers(-(2**40), 2**40, 3)]) for i in range(120)] + [(150, 0, [1e300, 1.0, 1.0])]
    got = sorted(tuple(r) for r in bond.hard_negatives(frame("vec_id bigint, label int, embedding array<double>", rows)).collect())
    assert got == brute(rows)


def test_nothing_to_search(frame):
    empty = frame("vec_id bigint, label int, embedding array<double>", [])
    assert bond.hard_negatives(empty).count() == 0
    assert bond.hard_negatives(frame("vec_id bigint, label int, embedding array<double>", [(1, 1, [1.0]), (2, 2, [1.0])])).count() == 0


def test_columns_are_read_only_while_candidates_are_left():
    rng = np.random.default_rng(2)
    columns = rng.integers(-5, 6, (64, 500)).astype(float)
    vec = np.r_[[300.0, -200.0], np.zeros(62)]

    class Read(bond.Descent):
        seen = 0

    way = Read(vec, columns, columns.min(1), columns.max(1))
    calls = []

    def bounds(low, high):
        calls.append(len(low))
        return bond._leading(5, None)(low, high)

    places, scores = way.survivors(np.ones(500, bool), bounds)
    exact = vec @ columns
    assert (scores == exact[places]).all() and set(np.argsort(-exact, kind="stable")[:5]) <= set(places)
    assert calls[-1] < 50  # the two large columns decide at once
