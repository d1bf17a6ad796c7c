"""The pipeline: each stage on its own input, and the whole."""

import random
from collections import Counter

import corpus_pipeline as pipeline
from stepmill.llm import mixing, queries, simhash


OTHER = " ".join(f"other{k * k} words" for k in range(90))


def docs(frame):
    passage = "A passage of words that several documents repeat, to the letter and at some length. " * 5
    rows = [(i, f"Document {i} says " + " ".join(f"thing{(i * 37 + k * k) % 997}" for k in range(80)), "en", f"src{i % 3}", 1) for i in range(40)]
    rows += [(50, rows[3][1], "en", "src0", 1), (51, "12 34 !!", "en", None, 1), (52, None, None, None, None), (53, "É" * 3 + passage + "x", "en", "a", 1), (54, "Ö" + passage + OTHER, "en", "b", 1)]
    return frame("doc_id bigint, text string, lang string, source string, n_chars bigint", rows)


def test_stages(spark, frame):
    start = docs(frame)
    spoken = spark.createDataFrame(pipeline.language(spark, start, "").collect(), start.schema)
    assert {r["doc_id"] for r in start.collect()} - {r["doc_id"] for r in spoken.collect()} == {51, 52}
    single = spark.createDataFrame(pipeline.near_duplicates(spark, spoken, "").collect(), start.schema)
    assert {r["doc_id"] for r in spoken.collect()} - {r["doc_id"] for r in single.collect()} == {50}
    cut = spark.createDataFrame(pipeline.repeated_passages(spark, single, "").collect(), start.schema)
    texts = {r["doc_id"]: r for r in cut.collect()}
    assert texts[53]["text"] == "ÉÉÉx" and texts[54]["text"] == "Ö" + OTHER and texts[53]["n_chars"] == 4
    assert texts[7]["text"] == {r["doc_id"]: r["text"] for r in single.collect()}[7]
    mixed = pipeline.mix(spark, cut, "")
    rows = mixed.collect()
    assert mixed.columns == start.columns and Counter(rows) == Counter(cut.collect())
    packed = pipeline.pack(spark, cut, "").collect()
    tokens = {r["doc_id"]: len(list(queries.encoder()([r["text"].encode()]))[0]) // 4 + 1 for r in rows}
    assert Counter({i: sum(r["length"] for r in packed if r["doc_id"] == i) for i in tokens}) == Counter(tokens)


def test_near_duplicates_are_those_of_brute_force(spark, frame):
    rng = random.Random(5)
    texts = []
    for _ in range(30):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(1, 300))]
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randrange(2)):
                copy[rng.randrange(len(copy))] = f"v{rng.randrange(4000)}"
            texts.append(" ".join(copy))
    texts += ["a b", "A  b", "a c", "", " ", None, "a b c d e", "a b c d e f", texts[3] + " tail"]
    component = simhash.brute_components([simhash.fingerprint(t or "") for t in texts])
    assert any(texts[i] != texts[c] for i, c in enumerate(component))
    got = pipeline.near_duplicates(spark, frame("doc_id bigint, text string", list(enumerate(texts))), "").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(set(component))


def test_near_duplicates_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    component = simhash.brute_components([simhash.fingerprint(r["text"] or "") for r in rows])
    kept = {r["doc_id"] for r in pipeline.near_duplicates(spark, docs, "").collect()}
    assert kept == {rows[c]["doc_id"] for c in set(component)}


CLASHING = "position block slot score accepted entropy lang_pred kept spans n_bytes n_removed fp row key at_file at_row start length sequence_id offset _of _start _row _group _end _all _rows _mix_of _fp _text".split()


def test_stages_keep_columns_of_clashing_names(spark, frame):
    plain = docs(frame)
    extra = plain.select("*", *[(plain["doc_id"] * 100 + i).alias(n) for i, n in enumerate(CLASHING)])
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, extra, "")
        assert out.columns == extra.columns
        rows = out.collect()
        assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in stage(spark, plain, "").collect()}
        assert all([r[n] for n in CLASHING] == [r["doc_id"] * 100 + i for i in range(len(CLASHING))] for r in rows)
    assert pipeline.pack(spark, extra, "").columns == pipeline.pack(spark, plain, "").columns


def test_stages_on_odd_texts(spark, frame):
    rows = [(1, None), (2, ""), (3, "  \n"), (None, "one word"), (4, "the " * 70_000), (4, "the " * 70_000), (5, "x" * 90_000), (6, "Å 中文 words, and 𝄞 here")]
    odd = frame("doc_id bigint, text string, lang string, source string, n_chars bigint", [(i, t, None, None, None) for i, t in rows])
    kept = {}
    for name, stage in pipeline.STAGES:
        kept[name] = sorted(str(r["doc_id"]) for r in stage(spark, odd, "").collect())
    assert kept["language"] == ["4", "4", "5", "6", "None"]  # nothing was learned; texts without a letter go
    assert kept["near_duplicates"] == ["1", "4", "5", "6", "None"]
    assert kept["repeated_passages"] == ["1", "2", "3", "6", "None"]  # of the others every byte repeats
    assert kept["mixing"] == sorted(str(i) for i, _ in rows) and set(kept["packing"]) == {str(i) for i, _ in rows}


def test_sequences_follow_the_mix(spark, frame, tmp_path):
    shares = {"a": 3, "b": 1}
    docs = frame("doc_id bigint, text string, source string", [(i, f"word{i} " * (1 + i % 40), "a" if i % 4 else "b") for i in range(4000)])
    mixing.in_mix_order(docs, shares, block_rows=4).write.parquet(str(tmp_path / "mixed"))
    read = spark.read.parquet(str(tmp_path / "mixed"))
    cut = pipeline.packing.pieces(pipeline._in_given_order(read, ["doc_id", "source", "text"]), queries.encoder).drop("text")
    placed = pipeline.packing.packed(cut, group_pieces=50, order=["at_file", "at_row", "start"]).orderBy("sequence_id", "offset").collect()
    assert len({r["sequence_id"] for r in placed}) > 50
    for size in range(400, 4000, 200):
        # The mix's share of ``b`` is a quarter, up to a run of 200 pieces.
        part = [r["source"] == "b" for r in placed[:size]]
        assert abs(sum(part) - size / 4) <= 200
    held = Counter()
    for r in placed:
        assert r["offset"] == held[r["sequence_id"]]
        held[r["sequence_id"]] += r["length"]
    assert max(held.values()) <= 2048


def test_stages_without_rows(spark, frame):
    empty = docs(frame).limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0


def test_run(spark):
    assert pipeline.run(spark, "/root/testdata/sf0.001").count() > 100
