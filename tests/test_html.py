import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from stepmill.functions import markup
from stepmill.functions.markup import compile_selector, parse_html, select_all
from stepmill.operators import html
from stepmill.operators.html import Locator, RecordSchema, TextField, extract_records, html_text
from stepmill.plans import listing
from tests.conftest import values

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body>
<div class="book sale" id="one" data-kind="x y"><h3>First &amp; best</h3><p>By: Ann<br>Lee</p>
<span class=price>&pound;12.50 or 13.50</span></div>
<div class='book'><h3> </h3><p>By: Bob</div>
<div class="book"><h3>Third</h3><!-- gone --><p>Cy &#8211; Dee&nbsp;</p><template><p>no</p></template><div/>tail</div>
</body>"""


def model(*names):
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def found(selector, page=PAGE):
    return [e.tag + e.text("|") for e in select_all(parse_html(page).descendants(), [compile_selector(selector)])]


@pytest.mark.parametrize(
    "selector, expected",
    [
        ("h3", ["h3First & best", "h3", "h3Third"]),
        ("H3", ["h3First & best", "h3", "h3Third"]),
        (".sale h3", ["h3First & best"]),
        ("#one > p", ["pBy: Ann|Lee"]),
        ("body > h3", []),
        ("div.book.sale p", ["pBy: Ann|Lee"]),
        ("[data-kind='x y'] h3", ["h3First & best"]),
        ("[id=one] .price, title", ["titleT", "span£12.50 or 13.50"]),
        ("div[class=book] h3", ["h3", "h3Third"]),
        ("script", ['scriptvar t="</p>";']),
        ("[data-kind]>h3", ["h3First & best"]),
    ],
)
def test_selectors(selector, expected):
    assert found(selector) == expected


@pytest.mark.parametrize("selector", ["", " ", "a:first-child", "a,", "> a", "a >", "a + b", "[", "a,,b"])
def test_unsupported_selectors(selector):
    with pytest.raises(ValueError):
        compile_selector(selector)


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>a<p>b</p>c</p>d", "a b c d"),
        ("<b>x<i>y</b>z", "x y z"),
        ("a<!-- c -->b", "a b"),
        ("<p>a&amp</p>b", "a& b"),
        ("a &lt;b&gt; &unknown; &amp.", "a <b> &unknown &."),
        ("&#x41;&#66;&#150;", "AB–"),
        ("<style>s</style><script>'</p>'</script>t<template>u</template>", "t"),
        ("</p>x</div>", "x"),
        ("x<br/>y<br></br>z", "x y z"),
        ("<![CDATA[raw]]>", "raw"),
        ("", ""),
        ("  \n <b> </b>\xa0", ""),
    ],
)
def test_text(html, text):
    assert parse_html(html).text() == text


def test_text_without_strip():
    assert parse_html("<p> a </p>\n\n <pre>  </pre>").text("|", strip=False) == " a |\n|  "


def test_html_text(frame):
    df = frame("html string", [(PAGE,), (None,)])
    got = values(df.select(html_text(df.html).alias("t")), "t")
    assert got == ["T First & best By: Ann Lee £12.50 or 13.50 By: Bob Third Cy – Dee tail", None]


def test_records(frame):
    schema = RecordSchema(
        Locator(".none", (".book",)),
        model("name", "author", "price", "shop", "note"),
        {
            "name": TextField(Locator(".title", ("h3",))),
            "author": TextField(Locator("p"), trim_prefix="By:", trim_suffix="Lee"),
            "price": TextField(Locator(".price"), regex_pattern=r"\d+\.(\d+)", trim_prefix="9", default="Free"),
            "shop": TextField(Locator("h3")),
        },
        skip_if_missing=("name",),
        defaults={"note": "-"},
    )
    df = frame("page int, s string, html string", [(1, "S", PAGE), (2, "S", "<p>nothing</p>"), (3, "S", None)])
    out = extract_records(schema, keep=["page"], context={"shop": "s"})(df)
    assert out.columns == ["page", "record_pos", "name", "author", "price", "shop", "note"]
    assert values(out) == [
        (1, 0, "First & best", "Ann", "50", "S", "-"),
        (1, 2, "Third", "Cy – Dee", "Free", "S", "-"),
    ]


def test_context_satisfies_and_fails_the_skip_rule(frame):
    schema = RecordSchema(
        Locator(".book"), model("name", "shop"), {"name": TextField(Locator("h3"))}, ("shop",)
    )
    df = frame("s string, html string", [("S", PAGE), ("", PAGE), (None, PAGE)])
    assert extract_records(schema, context={"shop": "s"})(df).count() == 3


def test_skip_field_without_rule_drops_all(frame):
    schema = RecordSchema(
        Locator(".book"), model("name", "shop"), {"name": TextField(Locator("h3"))}, ("shop",), {"shop": "x"}
    )
    assert extract_records(schema)(frame("html string", [(PAGE,)])).count() == 0


def test_prefix_is_literal(frame):
    def read(html, **rule):
        schema = RecordSchema(Locator("p"), model("v"), {"v": TextField(Locator("b"), **rule)})
        return values(extract_records(schema)(frame("html string", [(f"<p><b>{html}</b></p>",)])), "v")

    assert read("by: x", trim_prefix="By:") == ["by: x"]
    assert read("By: x", trim_prefix="By:") == ["x"]
    assert read("By:", trim_prefix="By:", default="d") == ["d"]
    assert read("By:", trim_prefix="By:") == [None]
    assert read("x .", trim_suffix=".") == ["x"]
    assert read("7.99", regex_pattern=r"(\d+,?\d+\.\d+)", default="Free") == ["Free"]
    assert read("£1,126.50!", regex_pattern=r"(\d+,?\d+\.\d+)", default="Free") == ["1,126.50"]
    assert read("x１２", regex_pattern=r"\d+") == ["１２"]
    assert read("ab", regex_pattern=r"(?P<q>z?)b") == [""]


def test_missing_model_field(frame):
    schema = RecordSchema(Locator("p"), model("a", "b"), {"a": TextField(Locator("b"))})
    with pytest.raises(ValueError, match="b"):
        extract_records(schema)(frame("html string", []))


def tree(element):
    return [
        (c.tag, c.attrs, tree(c)) if isinstance(c, markup.Element) else c for c in element.children
    ]


def both_ways(page):
    """The tree by pattern if the page allows it, and the tree of the tolerant parser."""
    regular = markup._Builder()
    done = markup._read_regular(page, regular)
    regular.flush()
    tolerant = markup._Builder()
    tolerant.feed(page)
    tolerant.close()
    tolerant.flush()
    return (tree(regular.root) if done else None), tree(tolerant.root)


PIECES = st.sampled_from([
    "text", " ", "\n", "é\xa0", "<p>", "</p>", "<b class='x y'>", "</b>", "<br>", "<br/>", "<BR />", "<div id=\"a\" hidden>",
    "</div>", "<a href=x.html>", "</a>", "&amp;", "&nbsp;", "&#65;", "&#x1F600;", "&#150;", "&#0;", "&unknown;", "& ", "&copy",
    "<!-- c -->", "<!---->", "<!-- a - b -->", "<!DOCTYPE html>", "<script>", "var t='</p>';", "</script>", "<style>p{}</style>",
    "<title>", "</title>", "<TITLE>T</title>", "<pre>", "</pre>", "<", ">", "<3", "</ p>", "<p", "<![CDATA[x]]>", "<?pi?>", "<svg:g>",
    "<template>", "</template>", "<textarea>", "</textarea>", "<a b=\"&lt;\">", "<a b='1' b='2'>", "<p/>", "=\"", "'", "<xmp>",
])


@given(st.lists(PIECES, max_size=14).map("".join))
@settings(max_examples=1500, deadline=None)
def test_reading_by_pattern_gives_the_same_tree(page):
    regular, tolerant = both_ways(page)
    assert regular is None or regular == tolerant


def test_usual_pages_are_read_by_pattern():
    regular, tolerant = both_ways(PAGE)
    assert regular == tolerant


# --- schema checks ---------------------------------------------------------------------------

SHOP = model("title", "price", "seller")
RULES = {"title": TextField(Locator("h2")), "price": TextField(Locator(".cost"))}


@pytest.mark.parametrize("skip", [(), ("title",), ("title", "price")])
def test_schema_may_leave_model_fields_out(skip):
    schema = RecordSchema(Locator("li.offer"), SHOP, RULES, skip)
    assert list(schema.fields) == ["title", "price"] and tuple(schema.skip_if_missing) == skip


@pytest.mark.parametrize("skip", [("colour",), ("title", "colour"), ("colour", "size", "price")])
def test_schema_names_unknown_skip_fields(skip):
    with pytest.raises(ValueError, match="colour"):
        RecordSchema(Locator("li.offer"), SHOP, RULES, skip)


def test_schema_names_unknown_fields():
    with pytest.raises(ValueError, match="colour"):
        RecordSchema(Locator("li.offer"), SHOP, {**RULES, "colour": TextField(Locator("i"), default="red")})


def test_named_groups_and_back_references(frame):
    rules = {"title": TextField(Locator("p"), regex_pattern=r"(?P<my_word>\w+) is")}
    page = frame("html string", [("<div><p>tea is hot</p></div>",)])
    assert values(extract_records(RecordSchema(Locator("div"), model("title"), rules), keep=[])(page)) == [(0, "tea")]
    assert html._plain_groups(r"(?P<a_b>x)(?P=a_b)") == r"(x)\1(?:)"


def test_rule_checks():
    with pytest.raises(ValueError):
        Locator("")
    with pytest.raises(ValueError):
        Locator("a", ("",))
    with pytest.raises(ValueError):
        TextField(Locator("a"), regex_pattern="")
    with pytest.raises(ValueError, match="more than one group"):
        TextField(Locator("a"), regex_pattern="(a)(b)")
    assert Locator(".t", ("h1", "[data-testid='t']")).selectors == (".t", "h1", "[data-testid='t']")


# --- plan ------------------------------------------------------------------------------------


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame([(1, "u", PAGE, "x")], "id int, url string, html string, unused string").write.parquet(path)
    schema = RecordSchema(Locator(".book"), model("name"), {"name": TextField(Locator("h3"))})
    out = spark.read.parquet(path).filter("id = 1").transform(extract_records(schema, keep=["id"]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "EqualTo(id,1)" in plan
    assert "ReadSchema: struct<id:int,html:string>" in plan
