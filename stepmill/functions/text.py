"""Text expressions. All run inside the JVM except :func:`nfkc`, which sends only non-ASCII text."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Code points that Unicode-aware trimming removes.
BLANKS = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E),
            *range(0x1C, 0x21),
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ],
    )
)
# Zero-width code points deleted from copied web text.
ZERO_WIDTH = "".join(map(chr, [0x200B, 0x200C, 0x200D, 0xFEFF]))
# What counts as one run of blanks for the plain squeeze (ASCII, no vertical tab).
ASCII_BLANK_RUN = "[\\t\\n\\f\\r ]+"
# The same blanks as BLANKS, as a pattern class (Z is every space separator).
BLANK_RUN = "[\\t-\\r\\x1c-\\x1f\\x85\\p{Z}]+"
# A character with case, i.e. one that belongs to a title-case word.
CASED = "\\p{Lu}\\p{Ll}\\p{Lt}\\u0345\\u2160-\\u217f\\u24b6-\\u24e9"
# Letters whose upper case is one letter, although upper() spells it with two.
_GREEK = [*range(0x1F80, 0x1F88), *range(0x1F90, 0x1F98), *range(0x1FA0, 0x1FA8)]
_LOWER_ONLY = "ß" + "".join(map(chr, [*_GREEK, 0x1FB3, 0x1FC3, 0x1FF3]))
_UPPER_ONLY = "ẞ" + "".join(map(chr, [*(p + 8 for p in _GREEK), 0x1FBC, 0x1FCC, 0x1FFC]))
# How a number may be spelled in text.
INTEGER_TEXT = "^[\\t-\\r ]*[+-]?[0-9]+[\\t-\\r ]*$"
DECIMAL_TEXT = "^[\\t-\\r ]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[\\t-\\r ]*$"
INFINITE_TEXT = "^[\\t-\\r ]*[+-]?([iI][nN][fF]|[iI][nN][fF][iI][nN][iI][tT][yY])[\\t-\\r ]*$"


def trim_blanks(c: Column) -> Column:
    """Trim every Unicode blank at both ends (``trim`` alone knows only U+0020)."""
    return F.btrim(c, F.lit(BLANKS))


def squeeze_ascii(c: Column) -> Column:
    """Each run of ASCII blanks becomes one space; the ends are not trimmed."""
    return F.regexp_replace(c, ASCII_BLANK_RUN, " ")


def squeeze_blanks(c: Column) -> Column:
    """Each run of Unicode blanks becomes one space, then the ends are trimmed."""
    return F.btrim(F.regexp_replace(c, BLANK_RUN, " "), F.lit(" "))


def lower_simple(c: Column) -> Column:
    """Lower case letter by letter: no word-final sigma, no two-letter dotted i."""
    return F.lower(_without(_without(c, "Σ", "σ"), "İ", "i"))


def _without(c: Column, old: str, new: str = "") -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def upper_letter(c: Column) -> Column:
    """Upper case of a one-letter text that stays one letter."""
    upper = F.upper(c)
    # The rare letters come last: they are only looked up when upper() gave two letters.
    return F.when(F.length(upper) == 1, upper).otherwise(F.translate(c, _LOWER_ONLY, _UPPER_ONLY))


def capitalize(c: Column) -> Column:
    """First character upper, the rest lower."""
    return F.concat(upper_letter(F.substring(c, 1, 1)), lower_simple(F.substr(c, F.lit(2))))


#: Marks the words' first letters for ``initcap``; texts that hold it take the long way.
_MARK = "\x01 "


def title(c: Column) -> Column:
    """Title case where every run of cased letters is a word: ``o'neil`` becomes ``O'Neil``."""
    # Plain ASCII: a mark with a blank before words that follow no blank lets one built-in do all words.
    marked = F.regexp_replace(F.lower(c), "([^a-z ])([a-z])", f"$1{_MARK}$2")
    plain = _without(F.initcap(marked), _MARK)
    easy = (F.octet_length(c) == F.length(c)) & ~F.contains(c, F.lit(_MARK[0]))

    simple = _without(c, "Σ", "σ")
    words = F.regexp_extract_all(simple, F.lit(f"[{CASED}]+|[^{CASED}]+"), F.lit(0))
    others = F.array_join(
        F.transform(
            words,
            lambda w: F.concat(
                upper_letter(F.substring(w, 1, 1)), F.lower(_without(F.substr(w, F.lit(2)), "İ", "i"))
            ),
        ),
        "",
    )
    return F.when(easy, plain).otherwise(others)


def drop_zero_width(c: Column) -> Column:
    for character in ZERO_WIDTH:
        c = _without(c, character)
    return c


#: About so many characters of a batch are Python objects at a time; the rest of it stays in Arrow.
_PIECE_CHARS = 1 << 18


@F.arrow_udf(T.StringType())
def _nfkc(values: pa.Array) -> pa.Array:
    pieces, start, piece, chars, changed, any_changed = [], 0, [], 0, False, False
    for at, value in enumerate(values, 1):
        text = value.as_py()
        normal = None if text is None else unicodedata.normalize("NFKC", text)
        changed |= normal != text
        piece.append(normal)
        chars += len(normal or "")
        if chars > _PIECE_CHARS or at == len(values):
            # A piece that is normal already stays where it is.
            pieces.append(pa.array(piece, type=values.type) if changed else values.slice(start, at - start))
            any_changed |= changed
            start, piece, chars, changed = at, [], 0, False
    if not any_changed:
        return values
    out = pa.concat_arrays(pieces)
    del pieces
    # Else each batch leaves its pieces' memory with the worker.
    pa.default_memory_pool().release_unused()
    return out


def nfkc(c: Column) -> Column:
    """NFKC form. Pure ASCII text (as many bytes as characters) is already normal, so only other
    text is sent to Python. ``c`` is repeated in the result: pass a plain column.
    """
    ascii_only = F.octet_length(c) == F.length(c)
    return F.when(ascii_only, c).otherwise(_nfkc(F.when(~ascii_only, c)))


def clean_characters(c: Column) -> Column:
    """NFKC, no-break space to space, zero-width characters removed. Pass a plain column."""
    return drop_zero_width(_without(nfkc(c), "\xa0", " "))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def to_number(c: Column, dtype: T.DataType) -> Column:
    """Lenient number: text that does not spell a number, and NaN, become null."""
    if isinstance(dtype, T.NumericType) or isinstance(dtype, T.BooleanType):
        number = c.cast("double")
    else:
        number = F.when(
            F.regexp_like(c, F.lit(DECIMAL_TEXT)) | F.regexp_like(c, F.lit(INFINITE_TEXT)),
            c.try_cast("double"),
        )
    return F.nanvl(number, F.lit(None).cast("double"))


def double_text(c: Column) -> Column:
    """Text of a double: positional from 1e-4 up to 1e16, otherwise ``1.5e-05`` style."""
    size = F.abs(c)
    raw = c.cast("string")
    large = F.regexp_replace(c.try_cast("decimal(38,10)").cast("string"), "0+$", "")
    small = F.regexp_replace(c.try_cast("decimal(38,30)").cast("string"), "0+$", "")
    mantissa = F.regexp_replace(F.regexp_extract(raw, "^(.*)E", 1), "[.]0$", "")
    sign = F.when(F.contains(raw, F.lit("E-")), F.lit("e-")).otherwise(F.lit("e+"))
    exponent = F.regexp_extract(raw, "E-?([0-9]+)$", 1)
    return (
        F.when((size >= 1e7) & (size < 1e16), F.regexp_replace(large, "[.]$", ".0"))
        .when((size >= 1e-4) & (size < 1e-3), small)
        .when(F.contains(raw, F.lit("E")), F.concat(mantissa, sign, F.regexp_replace(exponent, "^([0-9])$", "0$1")))
        .when(raw == F.lit("Infinity"), F.lit("inf"))
        .when(raw == F.lit("-Infinity"), F.lit("-inf"))
        .otherwise(raw)
    )


def as_text(c: Column, dtype: T.DataType) -> Column:
    """Text of any column; null and NaN stay null."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.BooleanType):
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    if isinstance(dtype, T.DoubleType):
        return double_text(F.nanvl(c, F.lit(None).cast("double")))
    if isinstance(dtype, T.FloatType):
        return F.nanvl(c, F.lit(None).cast("float")).cast("string")
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    return c.cast("string")
