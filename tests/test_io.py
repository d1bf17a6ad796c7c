import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from stepmill import (
    append_csv,
    append_csv_stream,
    columns,
    dated_path,
    dates,
    extract_csv,
    extract_paged_csv,
    extract_paged_csv_lite,
    fit_steps,
    nulls,
    order,
    profile,
    stage_export,
    strings,
    transform_data,
)
from stepmill.plans.fitted import from_json, to_json
from stepmill.sources import paged
from stepmill.sources.csv import file_parts, unique_header
from stepmill.streaming.run import run_batches, write_parquet_stream
from tests.conftest import values

MODEL = "title string, author string"


def written(path):
    return [p for p in sorted(os.listdir(path)) if p.endswith((".csv", ".csv.gz"))]


# --- append sink -----------------------------------------------------------------------------


def test_append_writes_records(spark, frame, tmp_path):
    path = str(tmp_path / "deep" / "records.csv")
    df = frame(MODEL, [("Book One", "Author One"), ("Book Two", None)]).coalesce(1)
    assert append_csv(df, path) == 2
    (part,) = written(path)
    text = open(os.path.join(path, part), encoding="utf-8").read().splitlines()
    assert text == ["title,author", "Book One,Author One", "Book Two,"]


def test_append_twice_has_one_header_for_the_reader(spark, frame, tmp_path):
    path = str(tmp_path / "records.csv")
    for row in [("Book One", "Author One"), ("Book Two", "Author Two")]:
        assert append_csv(frame(MODEL, [row]), path) == 1
    assert sorted(values(extract_csv(spark, path))) == [("Book One", "Author One"), ("Book Two", "Author Two")]


def test_append_nothing_makes_nothing(frame, tmp_path):
    path = str(tmp_path / "records.csv")
    assert append_csv(frame(MODEL, []), path) == 0
    assert not os.path.exists(path)


def test_append_selects_columns_and_keeps_cells(spark, frame, tmp_path):
    path = str(tmp_path / "records.csv")
    rows = [(1, 'a "b", c\nd', "  x "), (2, "", None)]
    df = frame("id int, title string, author string", rows)
    assert append_csv(df, path, ["author", "title"]) == 2
    assert sorted(values(extract_csv(spark, path)), key=str) == sorted([("  x ", 'a "b", c\nd'), (None, None)], key=str)
    with pytest.raises(ValueError, match="zz"):
        append_csv(df, path, ["zz"])


def test_append_keeps_its_column_list(spark, frame, tmp_path):
    path = str(tmp_path / "records.csv")
    df = frame(MODEL, [("Book", "Writer")])
    append_csv(df, path, ["title", "author"])
    with pytest.raises(ValueError, match="cannot append"):
        append_csv(df, path, ["author", "title"])
    assert append_csv(df, path, ["title", "author"]) == 1
    assert values(extract_csv(spark, path)) == [("Book", "Writer")] * 2


def test_append_by_batch_number_is_made_once(spark, frame, tmp_path):
    path = str(tmp_path / "records.csv")
    first, second = frame(MODEL, [("One", "A"), ("Two", "B")]), frame(MODEL, [("Three", "C")])
    assert append_csv(first, path, batch=1) == 2
    assert append_csv(first, path, batch=1) == 2 and append_csv(second, path, batch=1) == 2  # done already
    assert append_csv(second, path, batch=2) == 1
    assert sorted(values(extract_csv(spark, path))) == [("One", "A"), ("Three", "C"), ("Two", "B")]
    with pytest.raises(ValueError, match="cannot append"):
        append_csv(first.select("author", "title"), path, batch=1)


def test_a_lost_append_is_taken_away_first(spark, frame, tmp_path):
    path = str(tmp_path / "records.csv")
    df = frame(MODEL, [("One", "A")])
    append_csv(df, path, batch=3)
    os.remove(os.path.join(path, "_appended", "batch-3"))  # as after a crash before the note
    open(os.path.join(path, "batch-3-part-99.csv"), "w").write("title,author\nlost,lost\n")
    assert append_csv(df, path, batch=3) == 1
    assert values(extract_csv(spark, path)) == [("One", "A")]


def test_dated_path():
    assert dated_path("/out/", "export", dt.date(2024, 3, 9)) == "/out/export_20240309.csv"
    assert dated_path("/out", output_path="/x.csv") == "/x.csv"


def test_stage_export(spark, frame, tmp_path):
    path = str(tmp_path / "stage")
    stage_export(frame(MODEL, [("a", "b")]).coalesce(1), path)
    assert all(p.endswith(".gz") for p in written(path))
    assert values(extract_csv(spark, path)) == [("a", "b")]


# --- CSV source ------------------------------------------------------------------------------


def csv_file(tmp_path, text):
    path = tmp_path / "in.csv"
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_types_and_null_tokens(spark, tmp_path):
    text = (
        "i,gap,f,b,mixed,day,big,none,s\n"
        '1,5,1.5,True,1,2024-01-05,99999999999999999999,,"x, ""y"""\n'
        "\n"
        "2,N/A,2,false,x,2024-01-06,1,NULL,\"two\nlines\"\n"
        " 3,7,1e3,TRUE,3,nan,2,#N/A,\n"
    )
    out = extract_csv(spark, csv_file(tmp_path, text))
    assert out.dtypes == [
        ("i", "bigint"), ("gap", "bigint"), ("f", "double"), ("b", "boolean"), ("mixed", "string"),
        ("day", "string"), ("big", "string"), ("none", "double"), ("s", "string"),
    ]
    assert values(out) == [
        (1, 5, 1.5, True, "1", "2024-01-05", "99999999999999999999", None, 'x, "y"'),
        (2, None, 2.0, False, "x", "2024-01-06", "1", None, "two\nlines"),
        (3, 7, 1000.0, True, "3", None, "2", None, None),
    ]


def test_headers(spark, tmp_path):
    assert unique_header(["a", "a", None, "b", "a"]) == ["a", "a.1", "Unnamed: 2", "b", "a.2"]
    assert unique_header(["a", "a", "a.1"]) == ["a", "a.2", "a.1"]
    out = extract_csv(spark, csv_file(tmp_path, "a,a,,b c\n1,x,2,3\n"))
    assert out.columns == ["a", "a.1", "Unnamed: 2", "b c"]
    assert values(out) == [(1, "x", 2, 3)]


def test_header_only(spark, tmp_path):
    out = extract_csv(spark, csv_file(tmp_path, "a,b\n"))
    assert out.columns == ["a", "b"] and out.count() == 0


def test_short_and_long_rows(spark, tmp_path):
    assert values(extract_csv(spark, csv_file(tmp_path, "a,b\n1\n2,3\n"))) == [(1, None), (2, 3)]
    with pytest.raises(ValueError, match="more cells"):
        extract_csv(spark, csv_file(tmp_path, "a,b\n1,2\n2,3,4\n"))


def folder_of(tmp_path, files):
    folder = tmp_path / "a folder [1]"
    folder.mkdir()
    for name, text in files.items():
        (folder / name).write_text(text, encoding="utf-8")
    return str(folder).replace("[", "\\[").replace("]", "\\]")


def test_columns_go_by_each_files_header(spark, tmp_path):
    files = {"one 1.csv": "a,b\n1,2\n", "two{2}.csv": "b,a\n20,10\n", "three.csv": 'b,c\n5,"x\ny"\n', "empty.csv": "", "blank.csv": "\n\n", "bom.csv": "\ufeffa,b\n7,8\n"}
    path = folder_of(tmp_path, files)
    out = extract_csv(spark, path)
    assert dict(out.dtypes) == {"a": "bigint", "b": "bigint", "c": "string"}
    assert sorted(values(out.select("a", "b", "c")), key=str) == [(1, 2, None), (10, 20, None), (7, 8, None), (None, 5, "x\ny")]
    typed = extract_csv(spark, path, schema="c STRING, a INT")
    assert sorted(values(typed), key=str) == [("x\ny", None), (None, 1), (None, 10), (None, 7)]
    with pytest.raises(ValueError, match="zz"):
        extract_csv(spark, path, schema="a INT, zz INT")


def test_line_breaks_are_looked_up_file_by_file(spark, tmp_path):
    path = folder_of(tmp_path, {"plain.csv": "a,b\n1,x\n", "other.csv": "a,b\n2,y\n", "broken.csv": 'a,b\n3,"y\nz"\n'})
    parts = file_parts(spark, path)
    assert sorted((p.multi_line, len(p.paths)) for p in parts) == [(False, 2), (True, 1)]
    assert sorted(values(extract_csv(spark, path))) == [(1, "x"), (2, "y"), (3, "y\nz")]


@pytest.mark.parametrize("header, row", [("a,b", "3,4,5"), ("a,b", "1,2,,5"), ("a,b", "1,2,"), ("a,b", '"x,y",2,3'), ("a,b", '"q ""w"", e",2,'), ("a", "1,2")])
def test_too_many_cells_are_an_error_in_both_modes(spark, tmp_path, header, row):
    path = csv_file(tmp_path, f'{header}\n7\n"x,y"\n{row}\n')
    with pytest.raises(ValueError, match="1 rows .* more cells"):
        extract_csv(spark, path)
    schema = ", ".join(f"{c} STRING" for c in header.split(","))
    for use in (lambda df: df.collect(), lambda df: df.count(), lambda df: df.select(df.columns[-1]).collect(), lambda df: df.filter("a = '7'").count()):
        with pytest.raises(Exception, match="more cells"):
            use(extract_csv(spark, path, schema=schema))


def test_quoted_commas_are_not_cells(spark, tmp_path):
    path = csv_file(tmp_path, 'a,b,c\n"x,y",2\n"p ""q"", r"\n , "n\n')
    want = [("x,y", "2", None), ('p "q", r', None, None), (" ", ' "n', None)]
    assert values(extract_csv(spark, path, schema="a STRING, b STRING, c STRING", multi_line=False)) == want


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere.csv"):
        extract_csv(spark, str(tmp_path / "nowhere.csv"))


def test_single_line_files_are_read_in_splits(spark, tmp_path):
    path = csv_file(tmp_path, "a\n" + "\n".join(str(i) for i in range(20_000)) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        out = extract_csv(spark, path)
        assert out.rdd.getNumPartitions() > 3
        assert out.agg(F.sum("a"), F.count("a")).first() == (sum(range(20_000)), 20_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_given_schema(spark, tmp_path):
    out = extract_csv(spark, csv_file(tmp_path, "a,d\n1,2024-01-05\nNA,\n"), schema="a INT, d DATE")
    assert values(out) == [(1, dt.date(2024, 1, 5)), (None, None)]
    with pytest.raises(Exception, match="cannot cast"):
        extract_csv(spark, csv_file(tmp_path, "a\nx\n"), schema="a INT").collect()


# --- paged source ----------------------------------------------------------------------------


@pytest.mark.parametrize(
    "change",
    [
        {"data_source_url": "http://x/data.json"}, {"seed_limit": 0}, {"chunk_limit": 0}, {"chunk_limit": 1001},
        {"chunk_limit": 20, "seed_limit": 10}, {"concurrent_batch_limit": 0}, {"concurrent_batch_limit": 51},
        {"sleep_dur": 0.5}, {"sleep_dur": 10.5},
    ],
)
def test_contract(change):
    with pytest.raises(ValueError):
        paged.PullSettings(**{"data_source_url": "http://x/data.csv", **change})


def test_contract_holds():
    settings = paged.PullSettings("http://x/d.csv", offset=-5, seed_limit=25, chunk_limit=10)
    assert list(settings.offsets) == [-5, 5, 15]


RECORDS = [(i, f"name {i}") for i in range(57)]


def fetch_slice(offset, limit):
    """records[offset : offset + limit]; the second page has another column and texts for numbers."""
    rows = RECORDS[offset : offset + limit]
    if offset == 10:
        return "extra,id,value\n" + "".join(f'"e, {i}",{i},v{i}\n' for i, _ in rows)
    return "id,name,value\n" + "".join(f"{i},{n},{i * 2}\n" for i, n in rows)


def test_pull(spark):
    out = extract_paged_csv(
        spark, data_source_url="x.csv", seed_limit=25, chunk_limit=10, fetch=fetch_slice, keep_position=True
    )
    assert out.dtypes == [
        ("page", "int"), ("row_pos", "int"), ("id", "bigint"), ("name", "string"), ("value", "string"), ("extra", "string"),
    ]
    # the last page is not shortened: 30 rows for a seed of 25
    assert sorted(values(out)) == [
        (i // 10, i % 10, i, None if 10 <= i < 20 else f"name {i}", f"v{i}" if 10 <= i < 20 else str(i * 2),
         f"e, {i}" if 10 <= i < 20 else None)
        for i in range(30)
    ]


def test_pull_past_the_end(spark):
    out = extract_paged_csv(spark, data_source_url="x.csv", offset=50, seed_limit=20, chunk_limit=10, fetch=fetch_slice)
    assert out.columns == ["id", "name", "value"]
    assert sorted(values(out, "id")) == list(range(50, 57))


def test_lite(spark):
    out = extract_paged_csv_lite(spark, data_source_url="x.csv", limit=7, fetch=fetch_slice)
    assert sorted(values(out, "id")) == list(range(7))
    with pytest.raises(ValueError, match="chunk_limit"):
        extract_paged_csv_lite(spark, data_source_url="x.csv", limit=1001, fetch=fetch_slice)


def test_failed_page_fails_the_pull(spark):
    def broken(offset, limit):
        if offset == 10:
            raise OSError("no such page today")
        return fetch_slice(offset, limit)

    with pytest.raises(Exception, match="no such page today"):
        extract_paged_csv(spark, data_source_url="x.csv", seed_limit=30, chunk_limit=10, fetch=broken)


def test_a_pull_of_any_length_has_few_partitions():
    runs = paged.page_runs(len(paged.PullSettings("x.csv", seed_limit=10_000_000_000, chunk_limit=1).offsets), 32)
    assert len(runs) == 32 and runs[0].first == 0 and runs[-1].end == 10_000_000_000
    assert all(a.end == b.first for a, b in zip(runs, runs[1:])) and max(r.end - r.first for r in runs) - min(r.end - r.first for r in runs) <= 1
    assert [(r.first, r.end) for r in paged.page_runs(2, 50)] == [(0, 1), (1, 2)]


def test_few_partitions_and_one_fetch_per_page(spark, tmp_path):
    def counted(offset, limit):
        with open(tmp_path / f"{offset}", "a") as log:
            log.write("x")
        return fetch_slice(offset, limit)

    settings = paged.PullSettings("x.csv", seed_limit=30, chunk_limit=10)
    source = paged.paged_csv_source(counted, settings, 2)
    spark.dataSource.register(source)
    assert spark.read.format(source.name()).load().rdd.getNumPartitions() == 2
    out = extract_paged_csv(spark, data_source_url="x.csv", seed_limit=30, chunk_limit=10, fetch=counted)
    assert out.count() == 30 and out.count() == 30
    assert {p.name: p.read_text() for p in tmp_path.iterdir()} == {"0": "x", "10": "x", "20": "x"}


def test_page_folder(spark, tmp_path):
    root = str(tmp_path / "pages.csv")
    df = spark.range(25).select((F.col("id") / 10).cast("int").alias("p"), "id").selectExpr(
        "p * 10 AS offset", "id % 10 AS row_pos", "id", "'a \"q\"' AS t"
    )
    paged.export_pages(df.repartition(4), root)
    out = extract_paged_csv(spark, data_source_url=root, seed_limit=40, chunk_limit=10, keep_position=True)
    assert sorted(values(out)) == [(i // 10, i % 10, i, 'a "q"') for i in range(25)]
    with pytest.raises(FileNotFoundError, match="complete"):
        paged.PageFolder(str(tmp_path))(0, 10)


def test_page_folder_answers_any_range(spark, tmp_path):
    root = str(tmp_path / "pages.csv")
    pages = spark.range(30).selectExpr("int(id / 10) * 10 AS offset", "id % 10 AS row_pos", "id")
    paged.export_pages(pages, root)
    out = extract_paged_csv(spark, data_source_url=root, offset=3, seed_limit=40, chunk_limit=7)
    assert sorted(values(out)) == [(i,) for i in range(3, 30)]
    assert sorted(values(extract_paged_csv_lite(spark, data_source_url=root, limit=5))) == [(i,) for i in range(5)]
    next((tmp_path / "pages.csv" / "offset=10").glob("*.csv")).unlink()
    with pytest.raises(ValueError, match="page 10"):
        paged.PageFolder(root)(5, 10)
    (tmp_path / "pages.csv" / "offset=10").rename(tmp_path / "gone")
    with pytest.raises(FileNotFoundError, match="lacks"):
        paged.PageFolder(root)(5, 10)


def test_http_pages(monkeypatch):
    seen = []

    class Response:
        def __enter__(self):
            return self

        def __exit__(self, *_):
            return None

        def read(self):
            return b"a\n1\n"

    monkeypatch.setattr(paged, "urlopen", lambda request, timeout: seen.append(request) or Response())
    assert paged.HttpPages("https://host/d.csv", pause=0)(2000, 1000) == "a\n1\n"
    assert seen[0].full_url == "https://host/d.csv?$limit=1000&$offset=2000"
    assert seen[0].get_header("Accept") == "text/csv"


# --- streams ---------------------------------------------------------------------------------


def source_stream(spark, frame, tmp_path):
    path = str(tmp_path / "in")
    rows = [(i, "UNKNOWN" if i % 4 == 0 else " some THING ", "2024-01-05" if i % 3 else "bad", i * 10) for i in range(40)]
    df = frame("id int, status string, day string, n int", rows)
    df.write.parquet(path)
    return df, spark.readStream.schema(df.schema).parquet(path)


STEPS = [
    nulls.nullify_value({"status": "UNKNOWN"}),
    nulls.nullify_range({"n": (0, 300)}),
    strings.normalize_trim_case({"title": ["status"]}),
    dates.parse_date_columns({"day": "%Y-%m-%d"}),
    columns.null_fill({"n": -1}),
    columns.rename_columns({"id": "key"}),
]


def test_stateless_steps_on_a_stream(spark, frame, tmp_path):
    df, stream = source_stream(spark, frame, tmp_path)
    out = transform_data(STEPS, stream)
    path = str(tmp_path / "out")
    write_parquet_stream(out, path, path + "-c").awaitTermination()
    got = spark.read.schema(out.schema).parquet(path)
    assert sorted(values(got), key=str) == sorted(values(transform_data(STEPS, df)), key=str)


def test_html_and_record_steps_on_a_stream(spark, frame, tmp_path):
    from stepmill import listing, union_pages
    from tests.test_crawl import FULL, PAGES, item, page

    path = str(tmp_path / "in")
    rows = [(c, 0, "s", i, 1, page(FULL, item(" "), item(f"B{i}"))) for c in ("History", "Other") for i in range(6)]
    df = frame(PAGES, rows)
    df.write.parquet(path)
    stream = spark.readStream.schema(df.schema).parquet(path)
    out = listing.listing_records()(union_pages([stream, stream]))
    target = str(tmp_path / "out")
    write_parquet_stream(out, target, target + "-c").awaitTermination()
    expected = values(listing.listing_records()(df))
    assert len(expected) == 22
    assert sorted(values(spark.read.schema(out.schema).parquet(target)), key=str) == sorted(expected * 2, key=str)


def test_stream_to_csv(spark, frame, tmp_path):
    df, stream = source_stream(spark, frame, tmp_path)
    path = str(tmp_path / "out.csv")
    append_csv_stream(stream, path, path + "-c", ["id", "status"]).awaitTermination()
    assert sorted(values(extract_csv(spark, path))) == sorted((r.id, r.status) for r in df.collect())


def test_table_steps_on_batches(spark, frame, tmp_path):
    df, stream = source_stream(spark, frame, tmp_path)
    with pytest.raises(ValueError, match="stream"):
        nulls.dropna_by_threshold()(stream)
    steps = [nulls.nullify_value({"status": "UNKNOWN"}), nulls.dropna_by_threshold(0.3), profile.cast_categorical(pct_threshold=0.5)]
    path = str(tmp_path / "out")
    with pytest.raises(ValueError, match="fit"):
        run_batches(stream, steps, lambda batch, number: None, path + "-c")
    fitted = fit_steps(steps, df)
    decisions = [s for s in fitted if s is not steps[0]]
    assert from_json(to_json(decisions)) == decisions and decisions[0].columns == ("id", "status", "day", "n")
    assert profile.categorical_columns(transform_data(fitted, stream)) == ["status", "day"]
    with pytest.raises(Exception, match="cannot run on a stream"):
        run_batches(stream, [lambda batch: order.record_cap(3, ["id"])(batch)], lambda batch, number: None, path + "-d").awaitTermination()
    run_batches(
        stream, fitted, lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/n={number}"), path + "-c"
    ).awaitTermination()
    assert spark.read.parquet(path).count() == 30
