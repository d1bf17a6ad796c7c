"""Periodic runs against a plain search, on odd input, and the query's columns against a plain version."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from stepmill.llm import periodic, queries


def text_of(rng):
    kinds, words = rng.choice([1, 2, 3, 30]), []
    while len(words) < rng.choice([0, 5, 40, 150]):
        if rng.random() < 0.4:
            base = [str(rng.randrange(kinds)) for _ in range(rng.randint(1, 9))]
            words += (base * rng.randint(1, 8))[: rng.randint(1, 60)]
        else:
            words.append(str(rng.randrange(kinds)))
    return " ".join(words).encode()


@pytest.mark.parametrize("power, least", [(4, 6), (2, 1), (3, 10)])
def test_runs_are_those_of_a_plain_search(power, least):
    for seed in range(150):
        rng = random.Random(seed)
        texts = [text_of(rng) for _ in range(rng.randint(1, 8))]
        _, runs, _ = periodic._folded(texts, power, least)
        for text, found in zip(texts, runs, strict=True):
            assert [tuple(r) for r in found.tolist()] == periodic.brute_runs(text.split(), power, least)


def test_small_steps_give_the_same(monkeypatch):
    texts = [text_of(random.Random(seed)) for seed in range(40)]
    whole = periodic._folded(texts, 4, 6)
    monkeypatch.setattr(periodic, "ASKED", 50)
    parts = periodic._folded(texts, 4, 6)
    assert all((a == b).all() for a, b in zip(whole[1], parts[1], strict=True)) and whole[2] == parts[2]


def test_grammar_keeps_the_string_and_answers_extensions():
    for seed in range(60):
        rng = np.random.default_rng(seed)
        size = int(rng.integers(2, 300))
        symbols = rng.integers(0, rng.choice([1, 2, 4, 50]), size)
        symbols = np.r_[1000, symbols, 1001]
        levels = periodic.recompressed(symbols)
        assert len(levels[-1].symbols) == 1
        for below, above in zip(levels, levels[1:], strict=False):
            parts = {}
            for at, name in enumerate(above.symbols.tolist()):
                end = above.first[at + 1] if at + 1 < len(above.first) else len(below.symbols)
                parts.setdefault(name, set()).add(tuple(below.symbols[above.first[at] : end].tolist()))
            # A name stands for one string, and a string has one name.
            assert all(len(p) == 1 for p in parts.values()) and len({next(iter(p)) for p in parts.values()}) == len(parts)
        x, y = rng.integers(1, size + 1, (2, 200))
        x, y = x[x != y], y[x != y]
        text = symbols.tolist()

        def common(a, b, step, text=text):
            n = 0
            while text[a] == text[b]:
                a, b, n = a + step, b + step, n + 1
            return n

        assert periodic.extension(levels, x, y).tolist() == [common(a, b, 1) for a, b in zip(x, y, strict=True)]
        back = periodic.extension(periodic.mirrored(levels), size + 1 - x, size + 1 - y)
        assert back.tolist() == [common(a, b, -1) for a, b in zip(x, y, strict=True)]


def test_odd_rows(frame):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b " * 9), (3, "　x y \n"), (4, "é " * 50_000), (5, "w" * 100_000)]
    docs = frame("doc_id bigint, text string, runs string, key int, n_words int, collapsed string", [(*r, "x", 1, 2, "y") for r in rows])
    got = periodic.periodic_runs(docs)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    found = sorted((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got.collect())
    assert found == [
        (0, 18, [(0, 18, 2)], "a b"), (1, 0, [], ""), (2, 0, [], ""), (2, 0, [], ""), (3, 1, [], "　x y"),
        (4, 50_000, [(0, 50_000, 1)], "é"), (5, 1, [], "w" * 100_000),
    ]
    assert periodic.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, power=1)


def test_query_against_a_plain_version(spark):
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op13_periodic(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            a, g = h // 10 % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = periodic.brute_runs(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        gone = {i for start, length, q in runs for i in range(start + q, start + length)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert got[doc_id] == (len(runs), *first, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))
