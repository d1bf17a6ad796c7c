"""Repeated records out of a table of HTML pages.

The page text goes to Python once, in Arrow batches, and comes back as the raw text of every field
of every container element. All else - patterns, prefixes, defaults, skip rules, context - is plain
column expressions, so filters and unused columns are still handled by the optimizer. Context
columns never leave the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmill.functions.markup import compile_selector, parse_html, select_all, select_one
from stepmill.functions.text import empty_to_null, trim_blanks
from stepmill.plans.pipeline import Step
from stepmill.session import quoted, require_columns


@dataclass(frozen=True)
class Locator:
    """Where an element is: a selector and, if it finds nothing, fallbacks in order."""

    selector: str
    fallback_selectors: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        object.__setattr__(self, "fallback_selectors", tuple(self.fallback_selectors))
        for selector in self.selectors:
            compile_selector(selector)

    @property
    def selectors(self) -> tuple[str, ...]:
        return (self.selector, *self.fallback_selectors)


@dataclass(frozen=True)
class TextField:
    """How a field is read: element text, then a pattern, or a prefix and suffix to cut off."""

    locator: Locator
    regex_pattern: str | None = None
    trim_prefix: str | None = None
    trim_suffix: str | None = None
    default: str | None = None

    def __post_init__(self) -> None:
        if self.regex_pattern == "":
            raise ValueError("regex_pattern must not be empty")
        if self.regex_pattern and re.compile(self.regex_pattern).groups > 1:
            raise ValueError(f"pattern {self.regex_pattern!r} has more than one group")


@dataclass(frozen=True)
class RecordSchema:
    """Repeated blocks of a page: one record of ``model`` per container element."""

    record_container: Locator
    model: T.StructType
    fields: dict[str, TextField]
    skip_if_missing: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)

    def __post_init__(self) -> None:
        object.__setattr__(self, "skip_if_missing", tuple(self.skip_if_missing))
        known = set(self.model.fieldNames())
        for what, names in (
            ("skip_if_missing", self.skip_if_missing),
            ("fields", self.fields),
            ("defaults", self.defaults),
        ):
            unknown = sorted(set(names) - known)
            if unknown:
                raise ValueError(f"{what} names that the model does not have: {unknown}")


def _plain_groups(pattern: str) -> str:
    """Named groups as numbered ones: only the place of a group is used, and Java has other rules for names."""
    numbers = re.compile(pattern).groupindex
    plain = re.sub(r"\(\?P=(\w+)\)", lambda m: f"\\{numbers[m[1]]}(?:)", pattern)
    plain = re.sub(r"\(\?P<\w+>", "(", plain)
    if re.search(r"\(\?\(|\\Z", plain):
        raise ValueError(f"conditional groups and \\Z have no like in Spark's patterns: {pattern}")
    return plain


def field_value(raw: Column, rule: TextField) -> Column:
    """The value of a field from the raw text of its element (null: no element)."""
    text = empty_to_null(raw)
    default = F.lit(rule.default).cast("string")
    if rule.regex_pattern:
        # d: only \n ends a line; U: \d, \w, \s and \b cover all of Unicode.
        pattern = "(?dU)" + _plain_groups(rule.regex_pattern)
        group = re.compile(rule.regex_pattern).groups
        hit = F.when(F.regexp_like(text, F.lit(pattern)), F.regexp_extract(text, pattern, group))
        return F.coalesce(hit, default)
    if rule.trim_prefix:
        prefix = F.lit(rule.trim_prefix)
        rest = F.substr(text, F.lit(len(rule.trim_prefix) + 1))
        text = trim_blanks(F.when(F.startswith(text, prefix), rest).otherwise(text))
    if rule.trim_suffix:
        suffix = F.lit(rule.trim_suffix)
        rest = F.substr(text, F.lit(1), F.length(text) - F.lit(len(rule.trim_suffix)))
        text = trim_blanks(F.when(F.endswith(text, suffix), rest).otherwise(text))
    return F.coalesce(empty_to_null(text), default)


def _raw_text_udf(
    container: Locator, rules: Sequence[TextField], separator: str, strip: bool
):
    blocks = [compile_selector(s) for s in container.selectors]
    places = [[compile_selector(s) for s in rule.locator.selectors] for rule in rules]
    out_type = pa.list_(pa.list_(pa.string()))

    def page_texts(html: str) -> list[list[str | None]]:
        texts = []
        for block in select_all(parse_html(html).descendants(), blocks):
            inside = block.descendants()
            found = [select_one(inside, place) for place in places]
            texts.append([None if e is None else e.text(separator, strip) for e in found])
        return texts

    @F.arrow_udf(T.ArrayType(T.ArrayType(T.StringType())))
    def raw_texts(pages: pa.Array) -> pa.Array:
        return pa.array(
            [page_texts(page.as_py()) if page.is_valid else None for page in pages], type=out_type
        )

    return raw_texts


def extract_records(
    schema: RecordSchema,
    *,
    html_column: str = "html",
    context: dict[str, str] | None = None,
    keep: Sequence[str] = (),
    text_separator: str = " ",
    strip_text: bool = True,
    rebalance: bool = True,
) -> Step:
    """Pages to records: the ``keep`` columns, ``record_pos``, then the model's fields.

    ``context`` maps model fields to page columns; those values win over the field's own rule.
    ``record_pos`` is the position of the container among the containers of its page.

    Parsing costs far more than moving the pages: about a second per megabyte of HTML, so that a
    usual file split would keep one task busy for half an hour. Therefore the pages are first spread
    over partitions of ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, whatever the sizes of
    the files. ``rebalance=False`` leaves that shuffle out, for input that is already split finely.
    """
    context = context or {}
    rules = {name: rule for name, rule in schema.fields.items() if name not in context}

    def step(df: DataFrame) -> DataFrame:
        require_columns(df, [html_column, *context.values(), *keep])
        given = {*schema.fields, *context, *schema.defaults}
        missing = [name for name in schema.model.fieldNames() if name not in given]
        if missing:
            raise ValueError(f"model fields without rule, context or default: {missing}")

        used = dict.fromkeys([*keep, *context.values(), html_column])
        pages = df.select(*[quoted(c) for c in used])
        if rebalance and not df.isStreaming:
            pages = pages.hint("rebalance")
        parse = _raw_text_udf(schema.record_container, list(rules.values()), text_separator, strip_text)
        carried = {name: f"__context_{i}" for i, name in enumerate(context)}
        rows = pages.select(
            *[F.col(quoted(c)) for c in keep],
            *[F.col(quoted(context[name])).alias(alias) for name, alias in carried.items()],
            F.posexplode(parse(F.col(quoted(html_column)))).alias("record_pos", "__texts"),
        )
        values = {name: F.col(alias) for name, alias in carried.items()}
        for i, (name, rule) in enumerate(rules.items()):
            values[name] = field_value(F.col("__texts")[i], rule)
        for name in schema.skip_if_missing:
            value = values.get(name, F.lit(None))
            rows = rows.filter(F.coalesce(value.cast("string"), F.lit("")) != "")
        for name, default in schema.defaults.items():
            values.setdefault(name, F.lit(default))
        return rows.select(
            *[F.col(quoted(c)) for c in keep],
            "record_pos",
            *[values[name].alias(name) for name in schema.model.fieldNames()],
        )

    return step


def html_text(c: Column, text_separator: str = " ", strip_text: bool = True) -> Column:
    """The visible text of a whole page or fragment."""

    @F.arrow_udf(T.StringType())
    def page_text(pages: pa.Array) -> pa.Array:
        return pa.array(
            [
                parse_html(page.as_py()).text(text_separator, strip_text) if page.is_valid else None
                for page in pages
            ],
            type=pa.string(),
        )

    return page_text(c)
