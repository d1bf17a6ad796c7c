import math

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from stepmill import strings
from stepmill.functions import text
from tests.conftest import values


def test_squeeze_keeps_ends_and_other_blanks(frame):
    df = frame("a string", [("  x \t\n y ",), ("p\x0bq\xa0\xa0r",), (None,), ("",)])
    out = strings.trim_regex_whitespace(["a"])(df)
    assert values(out, "a") == [" x y ", "p\x0bq\xa0\xa0r", None, ""]


def test_cases(frame):
    df = frame("t string, c string", [("\xa0 o'neil-smith 3rd　", " hELLO wORLD\t"), ("éCOLE des_arts", "éCOLE"), ("", ""), (None, None)])
    out = strings.normalize_trim_case({"title": ["t"], "capitalize": ["c"], "other": ["zz"]})(df)
    assert values(out) == [
        ("O'Neil-Smith 3Rd", "Hello world"),
        ("École Des_Arts", "École"),
        ("", ""),
        (None, None),
    ]


def test_column_in_both_keys_is_title_cased(frame):
    out = strings.normalize_trim_case({"capitalize": ["a"], "title": ["a"]})(frame("a string", [("x y",)]))
    assert values(out, "a") == ["X Y"]


def test_case_of_numbers(frame):
    out = strings.normalize_trim_case({"title": ["a"]})(frame("a bigint", [(12,), (None,)]))
    assert values(out, "a") == ["12", None]


SAMPLES = ["straße ẞ ß", "ΣΑΣ ΟΔΟΣ", "İstanbul ıi", "ﬁn ŉ ǆ ǅ", "ᾳ ᾀ x", "ⓐⓑ ⅷ", "中a文b", "a͂ᾶ", "mañana ÀÉ", "ªbc", "x１y"]


def test_cases_follow_arrow(frame):
    df = frame("a string", [(s,) for s in SAMPLES]).select(
        "a", text.title(F.col("a")).alias("t"), text.capitalize(F.col("a")).alias("c")
    )
    got = df.toPandas()
    assert list(got["t"]) == pc.utf8_title(pa.array(SAMPLES)).to_pylist()
    assert list(got["c"]) == pc.utf8_capitalize(pa.array(SAMPLES)).to_pylist()


def test_trim_set_follows_arrow(frame):
    texts = [chr(i) + "x" + chr(i) for i in range(0x3100) if not 0xD800 <= i < 0xE000]
    got = frame("a string", [(s,) for s in texts]).select(text.trim_blanks(F.col("a")).alias("a")).toPandas()["a"]
    assert list(got) == pc.utf8_trim_whitespace(pa.array(texts)).to_pylist()


@pytest.mark.parametrize(
    "row, expected",
    [
        (("x", None, "z"), "x//z"),
        ((None, "y", "z"), "y/z"),
        (("x", "y", None), "x/y"),
        ((None, None, None), ""),
        (("/p", "q", "r/"), "p/q/r"),
    ],
)
def test_merge(frame, row, expected):
    out = strings.merge_string_columns(["a", "b", "c"], "m")(frame("a string, b string, c string", [row]))
    assert out.columns == ["m"]
    assert values(out) == [(expected,)]


def test_merge_strips_a_set_and_keeps_its_own_name(frame):
    df = frame("city string, state string, n int", [(", Rome ,", "IT,", 1)])
    out = strings.merge_string_columns(["city", "state"], "city", ", ")(df)
    assert out.columns == ["city", "n"]
    assert values(out) == [("Rome ,, IT", 1)]


def test_merge_without_delimiter(frame):
    out = strings.merge_string_columns(["a", "b"], "m", "")(frame("a string, b string", [(" x", "y ")]))
    assert values(out) == [(" xy ",)]
    with pytest.raises(ValueError):
        strings.merge_string_columns([], "m")


def test_merge_numbers_as_text(frame):
    df = frame("a double, b boolean, c int", [(1e7, True, 3), (12345678.25, False, None), (math.nan, None, 5)])
    out = strings.merge_string_columns(["a", "b", "c"], "m")(df)
    assert values(out, "m") == ["10000000.0/True/3", "12345678.25/False", "5"]


def test_double_text(frame):
    numbers = [0.0, 1.5, 1e16, 1.5e-5, 0.0001, 0.00012345, 0.001, -2e7, 1e22, 1.234e-10, 9007199254740993.0, math.inf, -math.inf]
    out = frame("a double", [(n,) for n in numbers]).select(text.double_text(F.col("a")).alias("t"))
    assert values(out, "t") == [repr(n) for n in numbers]


def test_replace_on_odd_names(frame):
    df = frame("v string", [("a",), ("b",), (None,)]).toDF("a.b")
    assert values(strings.replace_values("a.b", {"a": "b", "b": "a"})(df)) == [("b",), ("a",), (None,)]
