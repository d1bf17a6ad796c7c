"""Each operator against a brute-force version, and on odd input: nulls, empty and long texts, ties, copies, no rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stepmill.llm import ann, common, langid, mixing, packing, queries, sharding, simhash, substrings, topk, toxicity, urlfilter
from stepmill.session import release, scratch

ODD = [(1, None), (2, ""), (2, ""), (3, "   \n"), (None, "one"), (4, "Å 中文 \U0001d11e words, here"), (5, "ab " * 60_000), (6, "x" * 3000), (6, "x" * 3000)]


@pytest.fixture
def odd(frame):
    # Columns whose names clash with those the operators add.
    return frame("doc_id bigint, text string", ODD).selectExpr("doc_id", "text", "'a' AS row", "1 AS Shard", "2 AS fp", "3 AS _text", "'s' AS score", "4 AS length", "5 AS slot")


@pytest.fixture
def none(frame):
    return frame("doc_id bigint, text string, source string", [])


def long_of(value):
    return int(np.uint64(value).view(np.int64))


def test_positions_and_sums(frame):
    rows = [(i % 3, random.Random(i).randint(1, 9)) for i in range(500)]
    got = common.with_position(frame("a int, n bigint", rows), [F.col("a")], "at", {"sum": "n"}).orderBy("at").collect()
    total = 0
    assert [r["at"] for r in got] == list(range(500)) and [r["a"] for r in got] == sorted(a for a, _ in rows)
    for r in got:
        total += r["n"]
        assert r["sum"] == total


def test_released_tables_leave_the_catalog(spark):
    with scratch(spark) as tables:
        landed = common.bucketed(spark.range(20), "id", "buckets")
    assert landed.count() == 20
    before = {t.name for t in spark.catalog.listTables() if t.name.startswith("stepmill_")}
    release(spark, tables)
    after = {t.name for t in spark.catalog.listTables() if t.name.startswith("stepmill_")}
    assert len(before - after) == 1


def test_components_of_chains(frame):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (102, 100), (7, 7)]
    got = dict(common.components(frame("a bigint, b bigint", edges)).collect())
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


CLASHING = "position block slot score accepted kept spans _of _start _row _group _end _all _at _first _rows _seq _part _total0 _mix_of _mix_row _mix_first _mix_share".split()


def test_columns_of_inner_names_come_back(frame):
    """Operators that hand on the table's own columns leave those of any name as they are, but for the ones they add."""
    plain = frame("doc_id bigint, text string, source string", [(i, f"text {i % 7}", "ab"[i % 2]) for i in range(30)])
    table = plain.select("*", *[(plain["doc_id"] * 100 + i).alias(n) for i, n in enumerate(CLASHING)])
    for out, added in (
        (mixing.mixed(table, {"a": 2}, block_rows=4), {"block", "slot", "position"}),
        (mixing.in_mix_order(table, {"a": 2}), set()),
        (sharding.sharded(table, 3), {"size", "shard", "slot"}),
        (packing.packed(packing.pieces(table, queries.encoder)), {"sequence_id", "offset"}),
        (packing.packed(packing.pieces(table, queries.encoder), order=["doc_id"]), {"sequence_id", "offset"}),
        (simhash.keep_one(table), set()),
        (common.with_position(table, [F.col("doc_id")], "at", {"sum": "doc_id"}), {"at", "sum"}),
    ):
        same = [n for n in CLASHING if n not in added]
        rows = out.collect()
        assert rows and all([r[n] for n in same] == [r["doc_id"] * 100 + CLASHING.index(n) for n in same] for r in rows)


# Packing

def test_encoder_gives_the_tokenizers_ids():
    import public_tokenizers
    from tokenizers import Tokenizer

    whole, encoder = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER)), queries.encoder()
    texts = ["", "  ", "É’s l’ÉTÉ don'T we'LL 3.14 ÷×ß<|endoftext|>x", "İSTΣ Σ\x1cab \x85", "e \u0301a\u0301", "中文 テ", "a" * 5000, "it's\tso\r\nfine"]
    for text, ids in zip(texts, encoder([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_first_fit_decreasing_is_the_plain_one():
    sizes = np.random.default_rng(1).integers(1, 100, 300)
    bins, offsets = packing.first_fit_decreasing(sizes, 100)
    fill = []
    for i in np.argsort(-sizes, kind="stable"):
        place = next((b for b, used in enumerate(fill) if used + sizes[i] <= 100), len(fill))
        if place == len(fill):
            fill.append(0)
        assert (bins[i], offsets[i]) == (place, fill[place])
        fill[place] += sizes[i]


def test_packing_round_trip(odd, none):
    placed = packing.packed(packing.pieces(odd, queries.encoder, with_ids=True), group_pieces=2)
    rows = placed.collect()
    by_sequence = {}
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r["length"] for r in rows) == sum(len(list(queries.encoder()([(t or "").encode()]))[0]) // 4 + 1 for _, t in ODD)
    for r in packing.sequences(placed).collect():
        assert len(r["ids"]) == 2048 or len(r["ids"]) & (len(r["ids"]) - 1) == 0
    assert packing.packed(packing.pieces(none, queries.encoder)).count() == 0


# Toxicity

def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(20, 400, 30)) for _ in range(900)]
    grades = np.zeros(900, int)
    for i in range(0, 900, 3):
        bad = rng.choice(10, 1 + i % 5, replace=False)
        rows[i] = np.unique(np.r_[rows[i], bad])
        grades[i] = 1 + (len(bad) >= 4)
    model = toxicity.fit(rows, grades, 10)
    above = model.above(rows)
    assert (np.diff(model.thresholds) > 0).all() and (model.weights >= 0).all()
    assert ((above[:, 0] > 0.5) == (grades > 0)).mean() > 0.98 and (above.sum(1).round() == grades).mean() > 0.9


def test_the_fit_is_at_the_top_of_a_plain_likelihood():
    rng = np.random.default_rng(7)
    rows = [np.unique(rng.integers(0, 40, 8)) for _ in range(400)]
    strength = [sum(b < 4 for b in r) + rng.logistic() for r in rows]
    grades = np.array([0 if s < 1.5 else 1 if s < 3 else 2 for s in strength])
    model = toxicity.fit(rows, grades, 6, support=2.0)

    def loss(weights, thresholds):
        total = 2.0 / 1000 * weights.sum()
        for row, grade in zip(rows, grades.tolist(), strict=True):
            above = [1.0, *(1 / (1 + np.exp(t - sum(weights[b] for b in row))) for t in thresholds), 0.0]
            total -= np.log(above[grade] - above[grade + 1])
        return total

    least = loss(model.weights, model.thresholds)
    used = np.flatnonzero(model.weights)
    assert set(range(4)) <= set(used.tolist())
    for step in (-0.1, 0.1):
        for k in range(2):
            moved = model.thresholds.copy()
            moved[k] += step
            assert loss(model.weights, moved) > least - 0.01
        for b in used:
            moved = model.weights.copy()
            moved[b] = max(moved[b] + step, 0)
            assert loss(moved, model.thresholds) > least - 0.01
    # Severity is the expected grade.
    above = model.above(rows[:5])
    assert np.allclose(above.sum(1), [sum(g * (a - b) for g, (a, b) in enumerate(zip([1, *r], [*r, 0], strict=True))) for r in above])


def test_toxicity_on_unseen_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", F.col("toxic").alias("grade"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = toxicity.train(docs, labels.filter(~held))
    assert len(model.thresholds) == 1
    rows = toxicity.graded(docs.join(labels.filter(held).withColumnRenamed("grade", "toxic"), "doc_id"), model).collect()
    found = [r["grade"] for r in rows if r["toxic"]]
    # One in six of the toxic labels stands at a text without any harsh word.
    assert len(found) > 100 and np.mean(found) > 0.8 and np.mean([r["grade"] for r in rows if not r["toxic"]]) < 0.01


def test_toxicity_on_odd_rows(frame, odd, none):
    labels = frame("doc_id bigint, grade int", [(i, i % 2) for i in range(60)] + [(None, 1), (3, None)])
    docs = frame("doc_id bigint, text string", [(i, "you idiot there" if i % 2 else "kind words") for i in range(60)])
    model = toxicity.train(docs, labels)
    got = toxicity.graded(docs, model).collect()
    assert all((r["p_toxic"] > 0.5) == bool(r["doc_id"] % 2) for r in got)
    assert toxicity.graded(odd, model).count() == len(ODD) and toxicity.graded(none, model).count() == 0
    untaught = toxicity.train(none, labels.limit(0))
    assert {r["grade"] for r in toxicity.graded(odd, untaught).collect()} == {0}


# Repeated substrings

def removed(texts, length):
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    spans = [substrings.merged([(i, i + length) for i in range(len(t) - length + 1) if counts[t[i : i + length]] > 1]) for t in texts]
    return [(len(t), s, substrings.without(t, s)) for t, s in zip(texts, spans, strict=True)]


@pytest.mark.parametrize("crowd", [4096, 2])
def test_substrings_as_by_brute_force(frame, odd, crowd):
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdé ") for _ in range(700))
    rows = list(ODD)
    for i in range(60):
        own = "".join(rng.choice("abcdefg ") for _ in range(rng.randint(0, 900)))
        at, to = sorted((rng.randint(0, 700), rng.randint(0, 700)))
        rows.append((100 + i, own + passage[at:to] + own[: rng.randint(0, 300)]))
    docs = odd.limit(0).unionByName(frame("doc_id bigint, text string", rows), allowMissingColumns=True)
    got = Counter((r["doc_id"], r["n_bytes"], tuple((s["begin"], s["end"]) for s in r["spans"]), bytes(r["kept"])) for r in substrings.remove_repeats(docs, crowd=crowd).collect())
    want = removed([(t or "").encode() for _, t in rows], 200)
    assert got == Counter((i, n, tuple(s), k) for (i, _), (n, s, k) in zip(rows, want, strict=True))


def test_substrings_without_rows(none):
    assert substrings.remove_repeats(none).count() == 0


def test_repeated_starts():
    rng = random.Random(5)
    parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(200, 260))) for _ in range(20)]
    parts += [parts[0][10:] + b"zz", b"c" * 230]
    sizes = np.array([len(p) for p in parts])
    again = substrings.repeated_starts(b"".join(parts), np.cumsum(sizes) - sizes, sizes - 199, 200)
    counts = Counter(p[i : i + 200] for p in parts for i in range(len(p) - 199))
    assert again.tolist() == [counts[p[i : i + 200]] > 1 for p in parts for i in range(len(p) - 199)]


# SimHash

def test_fingerprint_by_the_letter():
    for text in ("", "  ", "One", "one TWO", "a b c d a b c", "É é É é"):
        words = text.encode().translate(simhash._LOWER).split()
        shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_trie_join_finds_all_links(frame):
    rng = np.random.default_rng(3)
    prints = {0, 1, 3, 2**64 - 1, 2**63}
    for base in rng.integers(0, 2**64, 12, dtype=np.uint64):
        value = int(base)
        for _ in range(25):
            for _ in range(rng.integers(1, 3)):
                value ^= 1 << int(rng.integers(0, 64))
            prints.add(value)
    prints = sorted(prints)
    rows = frame("key bigint, fp bigint", [(i, long_of(p)) for i, p in enumerate(prints)] + [(900, 0), (None, 0)])
    got = {r["key"]: r["component_id"] for r in simhash.grouped(rows).collect()}
    want = simhash.brute_components(prints)
    assert all(got[i] == w for i, w in enumerate(want)) and got[900] == got[None] == got[0] == want[0]


def test_near_duplicates_on_odd_rows(odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD) and {r["component_id"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "4", "5", "6", "None"]
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


# Language ID

def test_distinct_grams_both_ways():
    for alphabet in ("abc", "".join(chr(0x4E00 + i) for i in range(200))):
        texts = ["".join(random.Random(i).choice(alphabet + " ") for _ in range(300)) for i in range(5)]
        for _, grams, ends in langid._runs(texts):
            kinds, counts, of = langid._distinct(grams, np.r_[0, ends[:-1]])
            assert (kinds[of] == grams).all() and counts.tolist() == np.bincount(of).tolist()


def test_language_models_hold_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op5_langid(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.97 and all(r["accepted"] for r in got)


def test_probabilities_are_those_of_plain_kneser_ney(frame):
    texts = {"en": ["the cat sat on the mat", "a cat, a hat"], "fr": ["le chat est sur le tapis", "chat et chapeau"]}
    rows = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, ts in texts.items() for t in ts)]
    model = langid.train(frame("doc_id bigint, text string, lang string", rows), F.lit(True))
    alphabet = set()
    chances = {}
    for lang, own in texts.items():
        grams = Counter(int(g) for _, part, _ in langid._runs(own) for g in part)
        orders = {4: grams}
        for n in (3, 2, 1):  # lower orders count the different characters in front
            orders[n] = Counter(g & (1 << 16 * n) - 1 for g in orders[n + 1])
        alphabet |= set(orders[1])

        def chance(gram, lang=lang, orders=orders):
            p = 1 / (size + 1)
            for n in range(1, 5):
                counts, suffix = orders[n], gram & (1 << 16 * n) - 1
                once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
                d = min(max(once / max(once + 2 * twice, 1), 0.1), 0.95) if once else 0.5
                same = {g: c for g, c in counts.items() if g >> 16 == suffix >> 16}
                total = sum(same.values())
                if total:
                    p = (max(counts[suffix] - d, 0) + d * len(same) * p) / total
            return p

        chances[lang] = chance
    size = len(alphabet)
    asked = ["the chat sat", "un chapeau", "xyz", "cat"]
    entropy, sizes = model.entropies(asked)
    for i, text in enumerate(asked):
        grams = [int(g) for _, part, _ in langid._runs([text]) for g in part]
        assert sizes[i] == len(grams)
        for k, lang in enumerate(model.languages):
            plain = -np.mean([np.log(max(chances[lang](g), 1e-12)) for g in grams])
            assert entropy[i, k] == pytest.approx(plain, rel=1e-4)
    names, score, best, _ = model.judge(asked)
    assert names == [model.languages[int(k)] for k in entropy.argmin(1)]
    relative = np.exp(-model.sharpness * (entropy - entropy.min(1, keepdims=True)))
    assert np.allclose(score, 1 / relative.sum(1)) and np.allclose(best, entropy.min(1))


def test_equally_likely_languages_go_by_name(frame):
    rows = [(i, "one and the same text", lang) for i, lang in enumerate(["b", "a", "c"] * 3)]
    model = langid.train(frame("doc_id bigint, text string, lang string", rows), F.lit(True))
    got = langid.identify(frame("text string", [("the same text",)]), model).first()
    assert got["lang_pred"] == "a" and got["score"] == pytest.approx(1 / 3)


def test_language_on_odd_rows(frame, odd, none):
    docs = frame("doc_id bigint, text string, lang string", [(i, "the cat sat on the mat" if i % 2 else "der Hund lag auf der Matte", "en" if i % 2 else "de") for i in range(40)] + [(1, None, "en"), (2, "x", None), (None, "der", "de")])
    model = langid.train(docs, F.lit(True))
    got = langid.identify(odd, model).collect()
    assert len(got) == len(ODD)
    for r in got:
        wordless = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == wordless and 0 <= r["score"] <= 1 and not (wordless and r["accepted"])
    junk = frame("text string", [("xqzjk wvbn qqzx " * 20,), ("the cat on the mat " * 5,)])
    assert [r["accepted"] for r in langid.identify(junk, model).collect()] == [False, True]
    empty = langid.train(none.withColumn("lang", F.lit("x")), F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(odd, empty).collect()} == {"und"} and langid.identify(none, model).count() == 0


def test_language_models_keep_all_counts(frame):
    rng = random.Random(3)
    han = "".join(chr(0x4E00 + rng.randrange(20_000)) for _ in range(450_000))
    model = langid.train(frame("doc_id bigint, text string, lang string", [(1, han, "zh"), (2, "the cat sat", "en")]), F.lit(True))
    zh = model.languages.index("zh")
    grams, _, counts = next((g, e, np.unique(g, return_counts=True)) for _, g, e in langid._runs([han]))
    kinds, n = counts
    assert len(kinds) > 400_000
    assert (model.counts[3].rows(kinds, 2)[:, zh] == n).all()
    once, twice = (n == 1).sum(), (n == 2).sum()
    assert model.discounts[3, zh] == min(0.95, once / (once + 2 * twice))
    assert model.totals[3].rows(kinds >> np.uint64(16), 2)[:, zh].min() > 0


def test_rare_languages_have_their_own_limits(spark):
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("the cat sat on the mat").alias("text"), F.lit("en").alias("lang"))
    rng = random.Random(4)
    few = [(100_000 + i, "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(400)), "zh") for i in range(3)]
    model = langid.train(many.unionByName(spark.createDataFrame(few, many.schema)), F.lit(True))
    zh = model.languages.index("zh")
    own = model.entropies([t for _, t, _ in few])[0][:, zh]
    assert model.limits[0, zh] == pytest.approx(np.median(own)) and model.limits[2, zh] == pytest.approx(0.5 + own.max() - np.median(own))
    assert all(r["accepted"] for r in langid.identify(spark.createDataFrame(few, many.schema), model).collect())


# URLs

def test_urls(frame):
    rows = [None, "", "x", "http://", "HTTP://A.Example.ORG/es/q?x#y", "https://org", "http://org/", "http://xorg/", "http://example.org/en/12", "http://a.com/fr/1", "http://free-bets.example/x", "a://b://c", "http://a.b/" + "é𝄞" * 20_000]
    got = urlfilter.judged(frame("url string, Host int", [(u, 1) for u in rows]), queries.RULES).collect()
    want = {"HTTP://A.Example.ORG/es/q?x#y": ("a.example.org", "/es/q", "example.org/es/", "block"), "https://org": ("org", "", None, "allow"), "http://org/": ("org", "/", "org/", "allow"), "http://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"), "http://a.com/fr/1": ("a.com", "/fr/1", "com/fr/", "allow"), "http://free-bets.example/x": ("free-bets.example", "/x", None, "block")}
    for r in got:
        if r["url"] in want:
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == want[r["url"]]
        elif r["url"] in (None, "", "x", "http://"):
            assert (r["host"], r["path"], r["rule"]) == ("", "", None)
    assert len(got) == len(rows)
    assert urlfilter.judged(frame("url string", []), queries.RULES).count() == 0


def test_urls_stay_in_the_jvm(spark):
    plan = queries.op6_urls(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# Vector searches

@pytest.fixture
def vectors(frame):
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(300)] + [(i, [0.5] * 8) for i in range(300, 340)]
    rows += [(340, None), (360, [float("nan")] * 8), (380, [None] + [1.0] * 7), (None, [1.0] * 8), (400, [0.5, 0.25]), (401, [0.5, 0.5]), (420, [0.0] * 8), (440, []), (460, [1e30] * 8), (300, [0.5] * 8)]
    return frame("vec_id bigint, embedding array<double>, dim int, key int", [(*r, 1, 2) for r in rows]), rows


def test_top_k_is_exact(vectors):
    table, rows = vectors
    got = {}
    for r in topk.top_k(table, 5, 20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    clean = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    for place, (i, q) in enumerate(clean):
        if i % 20 == 0 and i != 300:
            scored = sorted((-min(max(sum(a * b for a, b in zip(q, v, strict=True)), -(2**63)), 2**63 - 1), j) for p, (j, v) in enumerate(clean) if p != place and len(v) == len(q))
            assert sorted(got.get(i, [])) == [(n + 1, j, -s) for n, (s, j) in enumerate(scored[:5])]
    assert len(got[300]) == 10 and topk.top_k(table.limit(0), 5, 20).count() == 0


def test_top_k_gathers_bounded_rotations(frame, monkeypatch):
    """The driver gets a quarter of the singular vectors, and of several dimensions those with most rows that fit the limit."""
    rng = np.random.default_rng(8)
    x = [rng.standard_normal((30, 8)) * np.arange(1, 9), rng.standard_normal((20, 12)), rng.standard_normal((25, 8))]
    rows = frame("dim int, vec array<double>", [(m.shape[1], v.tolist()) for m in x for v in m]).repartition(3)
    monkeypatch.setattr(topk, "ROTATION_BYTES", 150, raising=False)
    got = topk.rotations(rows)
    assert {dim: turn.shape for dim, turn in got.items()} == {8: (8, 2)}
    true = np.linalg.svd(np.r_[x[0], x[2]])[2][:2].T
    assert np.allclose(np.abs((got[8] * true).sum(0)), 1, rtol=1e-4) and np.linalg.norm(got[8], 2) <= 1
    assert topk.rotations(rows.limit(0)) == {} and topk.rotations(rows, max_dim=7) == {}


@pytest.mark.parametrize("room", [1 << 20, 0])
def test_top_k_in_a_grid_is_exact(frame, monkeypatch, room):
    """Many bands and stripes, numbers of 16, 32 and 64 bits, ties across blocks, with rotations and without."""
    rng = np.random.default_rng(9)
    x = [*rng.standard_normal((300, 6)) * rng.lognormal(size=(300, 1)), *np.full((60, 6), 0.5), *rng.standard_normal((12, 6)) * 1e4, *rng.standard_normal((6, 6)) * 1e9, *rng.standard_normal((40, 3))]
    ids = rng.permutation(len(x)).tolist()
    for name, value in (("CANDIDATES", 16), ("QUERIES", 8), ("CELL_BYTES", 4096), ("ROTATION_BYTES", room)):
        monkeypatch.setattr(topk, name, value, raising=False)
    table = frame("vec_id bigint, embedding array<double>", [(i, v.tolist()) for i, v in zip(ids, x, strict=True)]).repartition(3)
    whole = [[int(np.floor(256 * c)) for c in v] for v in x]
    want = []
    for i, q in zip(ids, whole, strict=True):
        if i % 3 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in zip(ids, whole, strict=True) if j != i and len(v) == len(q))
            want += [(i, n + 1, j, min(max(-s, -(2**63)), 2**63 - 1)) for n, (s, j) in enumerate(scored[:4])]
    assert sorted(map(tuple, topk.top_k(table, 4, 3).collect())) == sorted(want)


def test_nearest_finds_most(spark, vectors):
    table, rows = vectors
    assert {r["query_id"] for r in ann.nearest(table, 20, 20).collect()} == {*range(0, 340, 20), 400, 460}
    assert ann.nearest(table.limit(0), 20, 20).count() == 0
    found = ann.nearest(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"), 20, 20).toPandas()
    own = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    x, ids = np.array(own["embedding"].tolist(), float), own["vec_id"].to_numpy()
    hits = 0
    for place in np.flatnonzero(ids % 20 == 0):
        score = x @ x[place]
        best = [ids[j] for j in np.lexsort((ids, -score)) if j != place][:20]
        mine = found[found["query_id"] == ids[place]]
        assert sorted(mine["rank"]) == list(range(1, 21)) and np.allclose(sorted(mine["score"]), sorted(score[np.searchsorted(ids, mine["vec_id"])]))
        hits += len({*best} & {*mine["vec_id"]})
    assert hits / len(found) >= 0.9


def test_nearest_beyond_the_sample(spark, monkeypatch):
    """Recall on a table eight times the sample, whose queries the index never saw; more rows make more partitions."""
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((60, 24))
    x = centres[rng.integers(60, size=8000)] + 0.4 * rng.standard_normal((8000, 24))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(4)
    monkeypatch.setattr(ann, "PART_ROWS", 128)
    used = []
    fitted = ann.fitted
    monkeypatch.setattr(ann, "fitted", lambda sample, **o: used.append((len(sample), o["parts"])) or fitted(sample, **o))
    found = ann.nearest(table, 20, 20, sample_rows=1000).toPandas()
    assert used == [(1000, 64)] and len(found) == 400 * 20
    hits = 0
    for i in range(0, 8000, 20):
        score = x @ x[i]
        score[i] = -np.inf
        hits += len({*np.argsort(-score)[:20]} & {*found.loc[found["query_id"] == i, "vec_id"]})
    assert hits / len(found) >= 0.9


def test_partition_is_balanced():
    label = ann.balanced_partition(ann.neighbour_graph(np.random.default_rng(7).standard_normal((700, 6)), 8), 8)
    assert np.ptp(np.bincount(label, minlength=8)) <= 1


# Mixing and sharding

def test_schedule_stays_within_a_block():
    for shares in ([1], [3, 2, 1, 1, 5], [1, 1, 40, 7]):
        total, count = sum(shares), [0] * len(shares)
        for at, (source, block) in enumerate(mixing.period(shares), 1):
            assert block == count[source]
            count[source] += 1
            assert all(abs(c - s * at / total) < 1 for c, s in zip(count, shares, strict=True))


def test_mixing_on_odd_rows(frame, none):
    rows = [(i, "a" if i % 3 else None) for i in range(100)] + [(None, "b"), (5, "a"), (5, "a")]
    docs = frame("doc_id bigint, source string, block string, at int", [(*r, "x", 1) for r in rows])
    got = mixing.mixed(docs, {"a": 3, None: 2}, block_rows=4).collect()
    assert sorted(r["position"] for r in got) == list(range(len(rows)))
    assert Counter((r["doc_id"], r["source"]) for r in got) == Counter(rows)
    assert mixing.mixed(none, {}).count() == 0
    plan = mixing.mixed(docs, {})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_capacity_is_the_smallest():
    for seed in range(60):
        rng = random.Random(seed)
        sizes = [rng.choice([16, 17, 300, 5000]) for _ in range(rng.randint(1, 40))]
        ends, shards = np.cumsum(sizes).tolist(), rng.randint(1, 7)
        low = max(*sizes, -(-ends[-1] // shards)) if len(sizes) > 1 else sizes[0]
        found = sharding.smallest_capacity(ends, low, ends[-1], ends[-1], shards)
        assert all(sharding.walk(ends, c, ends[-1], shards) is None for c in range(low, found))


def test_cuts_through_windows_are_the_same(frame):
    rng = random.Random(8)
    rows, end = [], 0
    for _ in range(3000):
        size = rng.choice([16, 20, 1000, 50])
        end += size
        rows.append((size, end))
    table, ends = frame("size bigint, end bigint", rows), [e for _, e in rows]
    whole = sharding.walk(ends, sharding.smallest_capacity(ends, max(1000, -(-end // 10)), end, end, 10), end, 10)
    for bins, few in ((1 << 14, 1 << 16), (300, 20), (20, 5)):
        assert sharding.minimax_cuts(table, "size", "end", 10, bins, few) == whole


def test_cuts_are_balanced_around_hot_groups(frame):
    for hot in (0, 0.05, 0.1, 1 / 3):
        rng = random.Random(2)
        sizes = [rng.randint(20, 100) for _ in range(4000)]
        if hot:
            sizes[1500] = int(sum(sizes) * hot / (1 - hot))
        ends = np.cumsum(sizes).tolist()
        table = frame("size bigint, end bigint", list(zip(sizes, ends, strict=True)))
        cuts = sharding.balanced_cuts(table, "size", "end", 40)
        greedy = sharding.minimax_cuts(table, "size", "end", 40)
        shards = np.diff([0, *cuts, ends[-1]])
        assert len(cuts) == 39 and set(cuts) < set(ends)
        assert shards.max() == np.diff([0, *greedy, ends[-1]]).max()
        others = np.sort(shards)[: 39 if hot else 40]
        assert others.min() > 0.9 * others.max()
    for seed in range(4):
        rng = random.Random(seed)
        sizes = [rng.choice([16, 17, 300, 5000]) for _ in range(rng.randint(2, 30))]
        ends, shards = np.cumsum(sizes).tolist(), rng.randint(2, 7)
        table = frame("size bigint, end bigint", list(zip(sizes, ends, strict=True)))
        greedy = sharding.minimax_cuts(table, "size", "end", shards)
        got = sharding.balanced_cuts(table, "size", "end", shards)
        assert max(np.diff([0, *got, ends[-1]])) <= max(np.diff([0, *greedy, ends[-1]])) and got == sorted(got)


def test_sharding_on_odd_rows(odd, none):
    got = sharding.sharded(odd, 3).collect()
    assert len(got) == len(ODD) and all(r["size"] == len((r["text"] or "").encode()) + 16 for r in got)
    for shard in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))
    groups = {}
    for r in got:
        groups.setdefault(r["text"] and hashlib.md5(r["text"].encode()).hexdigest(), set()).add(r["shard"])
    assert all(len(s) == 1 for s in groups.values())
    assert sharding.sharded(none, 40).count() == 0


def test_lowest_by_hash_is_the_same_with_and_without_leaving_rows_out(spark):
    from pyspark.sql import functions as F

    rows = spark.range(5000).select(F.col("id").alias("key"))
    want = [r["key"] for r in rows.orderBy(F.xxhash64("key"), "key").limit(100).collect()]
    assert [r["key"] for r in common.lowest_by_hash(rows, ["key"], 100, "key").collect()] == want
    equal = spark.range(5000).select(F.lit(3).cast("long").alias("key"))
    assert common.lowest_by_hash(equal, ["key"], 100, "key").count() == 100
    assert common.lowest_by_hash(rows.limit(0), ["key"], 100, "key").count() == 0


def test_fit_in_runs_equals_the_fit_in_one(monkeypatch):
    random = np.random.default_rng(3)
    rows = [random.choice(200, 12, replace=False) for _ in range(400)]
    grades = np.array([min(2, int((r < 10).sum())) for r in rows])
    whole = toxicity.fit(rows, grades, 8, rounds=40)
    monkeypatch.setattr(toxicity, "RUN", 100)
    parts = toxicity.fit(rows, grades, 8, rounds=40)
    assert np.allclose(whole.weights, parts.weights) and np.allclose(whole.thresholds, parts.thresholds)
