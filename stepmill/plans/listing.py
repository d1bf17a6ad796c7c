"""The audiobook listing job: a table of crawled listing pages to a table of typed records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stepmill.operators.crawl import keep_loaded_pages, skip_positions, target_category
from stepmill.operators.html import Locator, RecordSchema, TextField, extract_records
from stepmill.operators.order import record_cap
from stepmill.operators.records import conform, normalize_text, nullify_empty
from stepmill.plans.pipeline import Step
from stepmill.session import materialise, require_batch

# The selectors, prefixes, patterns, sentinel and skip positions of the listing site.
CONTAINER = Locator(".productListItem", (".bc-list-item",))
LABELS = {
    "author": (".authorLabel", "By:"),
    "narrator": (".narratorLabel", "Narrated by:"),
    "runtime": (".runtimeLabel", "Length:"),
    "release_date": (".releaseDateLabel", "Release date:"),
    "language": (".languageLabel", "Language:"),
    "stars": (".ratingsLabel", "Ratings:"),
}
PRICE_SELECTOR = "#adbl-buy-box"
PRICE_PATTERN = r"(\d+,?\d+\.\d+)"
PRICE_DEFAULT = "Free"
SENTINEL = "adbl-impression-container"
SKIP_POSITIONS = {
    "Biographies & Memoirs": [2, 5],
    "Literature & Fiction": [10, 11],
    "History": [5],
    "Mystery, Thriller & Suspense": [3],
    "Romance": [1, 7, 8],
    "Sports & Outdoors": [0, 3, 23],
}

LISTING_MODEL = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("name", *LABELS, "price")]
    + [
        T.StructField(name, T.StringType(), nullable=False, metadata={"min_length": 1})
        for name in ("category", "subcategory")
    ]
)

LISTING_SCHEMA = RecordSchema(
    record_container=CONTAINER,
    model=LISTING_MODEL,
    skip_if_missing=("name",),
    fields={
        "name": TextField(Locator("h3")),
        **{
            name: TextField(Locator(selector), trim_prefix=prefix)
            for name, (selector, prefix) in LABELS.items()
        },
        "price": TextField(
            Locator(PRICE_SELECTOR), regex_pattern=PRICE_PATTERN, default=PRICE_DEFAULT
        ),
    },
)

#: What the pages table must hold besides ``html``.
PAGE_ORDER = ("category_pos", "subcategory_pos", "page")


def listing_records(
    *,
    target: str | None = None,
    max_records: int | None = None,
    skip_map: dict[str, list[int]] | None = None,
    sentinel: str = SENTINEL,
    keep_position: bool = False,
    rebalance: bool = True,
) -> Step:
    """Pages ``(category, category_pos, subcategory, subcategory_pos, page, html)`` to records.

    Page filters come first, so skipped pages are never parsed. The cap counts records in crawl
    order after the skip rule. ``keep_position`` leaves the crawl position in the result; for ``rebalance`` see
    :func:`stepmill.operators.html.extract_records`.
    """
    position = [*PAGE_ORDER, "record_pos"]
    model = T.StructType(
        [T.StructField(name, T.IntegerType()) for name in position] + LISTING_MODEL.fields
    )

    def step(pages: DataFrame) -> DataFrame:
        records = (
            pages.transform(target_category(target))
            .transform(skip_positions(SKIP_POSITIONS if skip_map is None else skip_map))
            .transform(keep_loaded_pages(sentinel))
            .transform(
                extract_records(
                    LISTING_SCHEMA,
                    context={"category": "category", "subcategory": "subcategory"},
                    keep=PAGE_ORDER,
                    rebalance=rebalance,
                )
            )
            .transform(normalize_text(LISTING_MODEL.fieldNames()))
            .transform(conform(model))
            .transform(nullify_empty())
        )
        if max_records is not None and max_records > 0:
            require_batch(pages, "record_cap")
            # The cap reads its input several times: pages are parsed once, and capped records come in crawl order.
            records = materialise(records, "listing").transform(record_cap(max_records, position)).orderBy(*position)
        else:
            records = records.transform(record_cap(max_records, position))
        return records if keep_position else records.select(*LISTING_MODEL.fieldNames())

    return step
