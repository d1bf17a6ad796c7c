import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stepmill import crawl, listing
from tests.conftest import values


def test_sentinel(frame):
    df = frame("id int, html string", [(1, "a MARK b"), (2, "mark"), (3, None)])
    assert values(crawl.keep_loaded_pages("MARK")(df), "id") == [1]
    good, bad = crawl.split_loaded_pages("MARK")(df)
    assert (values(good, "id"), values(bad, "id")) == ([1], [2, 3])


def test_skip_positions(frame):
    rows = [(c, i) for c in ("History", "Other") for i in range(7)] + [(None, 5)]
    df = frame("category string, subcategory_pos int", rows)
    out = crawl.skip_positions({"History": [5, 0], "Absent": [1]})(df)
    assert sorted(values(out), key=str) == sorted([r for r in rows if r not in (("History", 5), ("History", 0))], key=str)
    assert crawl.skip_positions({})(df).count() == len(rows)
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_target(frame):
    df = frame("category string", [("a",), ("b",), ("a",)])
    assert crawl.target_category("a")(df).count() == 2
    assert crawl.target_category(None)(df).count() == 3
    with pytest.raises(ValueError, match=r"\['a', 'b'\]"):
        crawl.target_category("c")(df)


def test_page_count_and_tail(frame):
    df = frame("labels array<string>", [(["1", "2", " 14 ", "Next"],), (["Prev"],), ([],), (["1"],), (["a", "b", "c"],)])
    out = df.select(crawl.page_count(F.col("labels")).alias("n"), crawl.drop_tail(F.col("labels")).alias("k"))
    assert values(out) == [(14, ["1", "2"]), (1, []), (1, []), (1, []), (1, ["a"])]


def item(name, **parts):
    labels = "".join(f'<li class="{k}">{v}</li>' for k, v in parts.items() if k != "price")
    return f'<li class="bc productListItem"><h3>{name}</h3>{labels}<p id="adbl-buy-box">{parts.get("price", "")}</p></li>'


def page(*items, sentinel=listing.SENTINEL):
    return f'<div class="{sentinel}"><ul>{"".join(items)}</ul></div>'


FULL = item(
    "Quiet    Harbours\n ",
    authorLabel="By: Ｍａｒａ\xa0T.\xa0Ｖｏｓｓ​",
    narratorLabel="Narrated by: Ida Brandt",
    runtimeLabel="Length: 7 hrs and 3 mins",
    releaseDateLabel="Release date: 02-11-24",
    languageLabel="Language: English",
    ratingsLabel="Ratings:   ",
    price="£18.40",
)
PAGES = "category string, category_pos int, subcategory string, subcategory_pos int, page int, html string"


def test_listing_record(frame):
    df = frame(PAGES, [("Business & Careers", 0, "Enterprise", 0, 1, page(FULL, item(" "), item("B", price="£7.99")))])
    assert values(listing.listing_records()(df)) == [
        ("Quiet Harbours", "Mara T. Voss", "Ida Brandt", "7 hrs and 3 mins", "02-11-24", "English", None,
         "18.40", "Business & Careers", "Enterprise"),
        ("B", None, None, None, None, None, None, "Free", "Business & Careers", "Enterprise"),
    ]


def test_listing_crawl_rules(frame):
    def pages():
        for c, category in enumerate(["History", "Romance"]):
            for s in range(9):
                for p in (1, 2):
                    loaded = "other" if (s, p) == (2, 1) else listing.SENTINEL
                    names = [item(f"{category}-{s}-{p}-{i}") for i in range(3)]
                    yield category, c, f"S{s}", s, p, page(*names, sentinel=loaded)

    df = frame(PAGES, list(pages())).repartition(4)
    names = [
        f"{category}-{s}-{p}-{i}"
        for category, skipped in (("History", [5]), ("Romance", [1, 7, 8]))
        for s in range(9) if s not in skipped
        for p in (1, 2) if (s, p) != (2, 1)
        for i in range(3)
    ]
    assert sorted(values(listing.listing_records()(df), "name")) == sorted(names)
    assert values(listing.listing_records(max_records=20)(df), "name") == names[:20]
    romance = [n for n in names if n.startswith("Romance")]
    assert values(listing.listing_records(target="Romance", max_records=4)(df), "name") == romance[:4]
    assert listing.listing_records(max_records=0)(df).count() == 0
    with pytest.raises(ValueError, match="History"):
        listing.listing_records(target="Nowhere")(df)


def test_listing_fallback_container(frame):
    html = page(item("A")).replace("productListItem", "bc-list-item")
    assert listing.listing_records()(frame(PAGES, [("c", 0, "s", 0, 1, html)])).count() == 1


def test_listing_needs_a_category(frame):
    df = frame(PAGES, [("", 0, "s", 0, 1, page(item("A")))])
    for use in (lambda d: d.collect(), lambda d: d.select("price").collect(), lambda d: d.count()):
        with pytest.raises(PySparkException, match="category: too short"):
            use(listing.listing_records()(df))
    # a page without records has nothing to judge
    empty = frame(PAGES, [("", 0, "s", 0, 1, page())])
    assert listing.listing_records()(empty).count() == 0
