import __spark_entry__ as entry
from stepmill.plans.queries import QUERIES, SQL
from stepmill.session import materialise, shared_folder


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() == 1500
    assert df.columns == [
        "o_orderkey", "status", "created_date", "priority", "o_totalprice", "status_is_category", "priority_is_category",
    ]
    assert df.schema["priority"].metadata.get("categories") == 5


def test_simple_steps_keep_pushdown(spark):
    from stepmill import columns, nulls, strings

    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    out = (
        df.transform(nulls.nullify_value({"o_orderstatus": "P"}))
        .transform(strings.normalize_trim_case({"title": ["o_orderpriority"]}))
        .transform(columns.rename_columns({"o_orderkey": "id"}))
        .filter("id < 10")
        .select("id")
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(o_orderkey,10)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_materialise_uses_the_shared_folder(spark):
    kept = materialise(spark.range(5), "t")
    assert f"{shared_folder(spark)}/stepmill/t-" in kept.inputFiles()[0]
