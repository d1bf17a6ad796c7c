"""Records out of HTML pages."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmill.operators.html import Locator, RecordSchema, TextField, extract_records, html_text
from stepmill.plans.listing import SENTINEL, listing_records
from stepmill.plans.queries.registry import query, table


def _model(*names):
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _decoded(text):
    """The entities the pages hold, decoded in SQL; the ampersand last. At the end of a piece of
    text, where a tag follows, an entity counts without its semicolon too.
    """
    for entity, character in (("quot", '"'), ("copy", "\xa9"), ("middot", "\xb7"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{entity}(;|$)', '{character}', 'g')"
    return text


def _trimmed(text):
    return f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"


def _pieces(markup):
    """Visible text in SQL: pieces between tags, trimmed, the empty ones dropped."""
    hidden = "<script.*?</script>|<style.*?</style>|<!--.*?-->"
    bare = f"regexp_replace({markup}, '(?s){hidden}', '<x>', 'g')"
    return f"""array_to_string(list_filter(list_transform(
        string_split_regex({bare}, '<[^>]*>'),
        lambda p: {_trimmed(_decoded("p"))}), lambda p: p <> ''), ' ')"""


@query(
    "nav_links",
    f"""
    WITH items AS (SELECT page_id, regexp_extract_all(html, '<li><a [^>]*>(.*?)</a></li>', 1) AS list FROM pages)
    SELECT page_id, pos::INT AS record_pos, {_trimmed(_decoded("list[pos + 1]"))} AS label
    FROM items, unnest(range(len(list))) AS u(pos)
    """,
)
def nav_links(spark, sf_dir):
    schema = RecordSchema(Locator("nav li"), _model("label"), {"label": TextField(Locator("a"))})
    return table(spark, sf_dir, "pages").transform(extract_records(schema, keep=["page_id"]))


@query(
    "page_articles",
    f"""
    SELECT page_id, 0 AS record_pos,
           {_trimmed(_decoded("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))} AS heading,
           {_pieces("regexp_extract(html, '(?s)<article>(.*?)</article>', 1)")} AS body,
           url AS address
    FROM pages
    """,
)
def page_articles(spark, sf_dir):
    """Fallback selectors, a context column that wins over a rule, and the text of a long element."""
    schema = RecordSchema(
        Locator(".no-such-class", ("body",)),
        _model("heading", "body", "address"),
        {
            "heading": TextField(Locator(".title", ("article > h2", "article h1"))),
            "body": TextField(Locator("article")),
            "address": TextField(Locator("footer")),
        },
        skip_if_missing=("heading", "address"),
    )
    return table(spark, sf_dir, "pages").transform(
        extract_records(schema, keep=["page_id"], context={"address": "url"})
    )


@query("page_text", f"SELECT page_id, {_pieces('html')} AS text FROM pages")
def page_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html_text(F.col("html")).alias("text"))


_FOOTER_SQL = f"""
    SELECT page_id, {_pieces("regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1)")} AS text FROM pages
"""


@query(
    "field_rules",
    f"""
    WITH t AS ({_FOOTER_SQL})
    SELECT page_id, 0 AS record_pos,
           CASE WHEN regexp_matches(text, '[a-z.]+[.]example[.](org|net)')
                THEN regexp_extract(text, '[a-z.]+[.]example[.](org|net)', 1) ELSE 'other' END AS ending,
           CASE WHEN regexp_matches(text, '[A-Z][a-z]+') THEN regexp_extract(text, '[A-Z][a-z]+') END AS word,
           trim(substr(text, 2)) AS cut,
           CASE WHEN ends_with(text, '.') THEN trim(left(text, length(text) - 1)) ELSE text END AS stem,
           'none' AS absent
    FROM t
    """,
)
def field_rules(spark, sf_dir):
    footer = Locator("footer")
    schema = RecordSchema(
        Locator("body"),
        _model("ending", "word", "cut", "stem", "absent"),
        {
            "ending": TextField(footer, regex_pattern=r"[a-z.]+[.]example[.](org|net)", default="other"),
            "word": TextField(footer, regex_pattern=r"[A-Z][a-z]+"),
            "cut": TextField(footer, trim_prefix="\xa9"),
            "stem": TextField(footer, trim_prefix="no such prefix", trim_suffix="."),
            "absent": TextField(Locator("aside"), trim_prefix="x", default="none"),
        },
    )
    return table(spark, sf_dir, "pages").transform(extract_records(schema, keep=["page_id"]))


@query("skip_missing", "SELECT page_id FROM pages WHERE regexp_matches(html, '<footer>[^<]*[.]example[.]org')")
def skip_missing(spark, sf_dir):
    """Records without the skip field go: here the pages whose footer names no .org host."""
    schema = RecordSchema(
        Locator("body"),
        _model("heading", "host"),
        {"heading": TextField(Locator("h1")), "host": TextField(Locator("footer"), regex_pattern=r"[a-z.]+[.]example[.]org")},
        skip_if_missing=("host",),
    )
    return table(spark, sf_dir, "pages").transform(extract_records(schema, keep=["page_id"])).select("page_id")


# Listing pages are put together from the parts table: 20 items a page, each in one of 30
# category and subcategory places.
_LISTING_SQL = """
    WITH items AS (
        SELECT *, CASE p_partkey % 3 WHEN 0 THEN 'History' WHEN 1 THEN 'Romance' ELSE 'Fantasy' END AS category,
               (p_partkey % 3)::INT AS category_pos, ((p_partkey // 3) % 10)::INT AS subcategory_pos,
               (p_partkey // 600)::INT AS page, (p_partkey % 600) // 30 AS record_pos
        FROM part),
    crawled AS (
        SELECT category_pos, subcategory_pos, page, record_pos::INT AS record_pos, p_name AS name,
               CASE WHEN p_partkey % 11 <> 0 THEN p_brand END AS author,
               CASE WHEN p_partkey % 5 <> 0 THEN p_type || ' & Co' END AS narrator,
               p_size || ' hrs' AS runtime, NULL::VARCHAR AS release_date, 'English' AS language,
               NULL::VARCHAR AS stars,
               CASE WHEN p_partkey % 4 = 0 AND p_size < 10 THEN 'Free'
                    WHEN p_partkey % 4 = 0 THEN p_size || '.99' ELSE '1,126.50' END AS price,
               category, 'Shelf ' || subcategory_pos AS subcategory
        FROM items
        WHERE p_partkey % 13 <> 0
          AND NOT (category = 'History' AND subcategory_pos = 5)
          AND NOT (category = 'Romance' AND subcategory_pos IN (1, 7, 8))
          AND (category_pos + subcategory_pos + page) % 7 <> 3)
"""


def _listing_pages(spark, sf_dir):
    key = F.col("p_partkey")
    place = (F.floor(key / 3) % 10).cast("int")

    def span(name, label, value, shown=None):
        tag = F.concat(F.lit(f'<li class="bc {name}"> <span>{label}</span> '), value, F.lit("</li>"))
        return tag if shown is None else F.when(shown, tag).otherwise("")

    item = F.concat(
        F.lit('<li class="bc-list productListItem"><ul>'),
        F.when(key % 13 != 0, F.concat(F.lit("<h3><a>"), F.col("p_name"), F.lit("</a>\n</h3>"))).otherwise("<h3> </h3>"),
        span("authorLabel", "By:", F.col("p_brand"), key % 11 != 0),
        span("narratorLabel", "Narrated by:", F.concat("p_type", F.lit("&nbsp;&amp; Co")), key % 5 != 0),
        span("runtimeLabel", "Length:", F.concat(F.col("p_size").cast("string"), F.lit("  hrs"))),
        span("languageLabel", "Language:", F.lit("Ｅnglish​")),
        span("ratingsLabel", "Ratings:", F.lit(" ")),
        F.lit('</ul><div id="adbl-buy-box">'),
        F.when(key % 4 == 0, F.concat(F.lit("\xa3"), F.col("p_size").cast("string"), F.lit(".99"))).otherwise("\xa31,126.50"),
        F.lit("</div></li>"),
    )
    items = table(spark, sf_dir, "part").select(
        F.element_at(F.array(F.lit("History"), F.lit("Romance"), F.lit("Fantasy")), (key % 3 + 1).cast("int")).alias("category"),
        (key % 3).cast("int").alias("category_pos"),
        F.concat(F.lit("Shelf "), place.cast("string")).alias("subcategory"),
        place.alias("subcategory_pos"),
        F.floor(key / 600).cast("int").alias("page"),
        F.struct(key.alias("k"), item.alias("item")).alias("at"),
    )
    pages = items.groupBy("category", "category_pos", "subcategory", "subcategory_pos", "page").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("at")), lambda x: x["item"]), "").alias("items")
    )
    loaded = (F.col("category_pos") + F.col("subcategory_pos") + F.col("page")) % 7 != 3
    return pages.select(
        "category", "category_pos", "subcategory", "subcategory_pos", "page",
        F.concat(
            F.lit("<html><body>"),
            F.when(loaded, f'<div class="{SENTINEL}">').otherwise("<div>"),
            F.col("items"),
            F.lit("</div>"),
        ).alias("html"),
    )


@query("listing", f"{_LISTING_SQL} SELECT * FROM crawled")
def listing(spark, sf_dir):
    return _listing_pages(spark, sf_dir).transform(listing_records(keep_position=True))


@query(
    "listing_capped",
    f"""{_LISTING_SQL} SELECT name, author, narrator, runtime, release_date, language, stars, price, category, subcategory
    FROM crawled WHERE category = 'Fantasy'
    ORDER BY category_pos, subcategory_pos, page, record_pos LIMIT 250""",
)
def listing_capped(spark, sf_dir):
    return _listing_pages(spark, sf_dir).transform(listing_records(target="Fantasy", max_records=250))
