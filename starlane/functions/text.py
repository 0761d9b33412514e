"""Text cleaning expressions (FN-8..11, FN-14..16, FLT-5) and header rules (PRJ-1/2)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from starlane.schema import PAYMENT_MAP, REASON_TYPE_DEFAULT, REASON_TYPE_RULES


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- header names (driver-side, once per schema, never per row) ------------

def normalise_header(name: str) -> str:
    """Logical name of a raw header: its words (letters, digits, underscores;
    other marks vanish) joined by single underscores, in lower case."""
    words = "".join(ch for ch in name if ch.isalnum() or ch == "_" or ch.isspace()).split()
    return "_".join(words).lower()


def normalise_headers(names: Iterable[str], rule=normalise_header) -> list[str]:
    """Normalise a list of names; two inputs mapping to one name is an error."""
    names = list(names)
    out = [rule(n) for n in names]
    seen: dict[str, str] = {}
    for raw, new in zip(names, out):
        if new in seen:
            raise ValueError(
                f"header collision: {seen[new]!r} and {raw!r} both normalise to {new!r}")
        seen[new] = raw
    return out


# ---- value expressions ------------------------------------------------------

# Unicode white space (what a text feed may pad its values with).
WHITE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                          0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column | str) -> Column:
    """Remove white space of every kind from both ends (no regex per row).

    Trimming with a list of characters is dear, so a text that neither begins
    nor ends with any is passed on as it is, and one that is only padded with
    spaces loses those; ends that are printable ASCII are known by comparing
    bytes.  ``c`` is written several times: bind a longer expression to a
    column first."""
    x, white = _c(c), F.lit(WHITE)
    text = x.cast("string")     # a feed of inferred types has numbers and dates
    bare = F.trim(text)
    last = F.substring(text, -1, 1)
    padded = F.contains(white, F.substring(x, 1, 1)) | F.contains(white, last)
    return F.when(_ends_in_print(text), x).when(_ends_in_print(bare), bare) \
        .when(padded, F.btrim(x, white)).otherwise(x)


def _ends_in_print(text: Column) -> Column:
    """Whether the first and the last character are printable ASCII (the last
    byte is looked at: finding the last character counts all of them)."""
    last = F.substring(text.cast("binary"), -1, 1)
    return (text >= "!") & (text < "\x7f") & (last >= F.lit(b"!")) & (last < F.lit(b"\x7f"))


def blank_to_null(c: Column | str) -> Column:
    """Empty string -> NULL (FN-15)."""
    return F.nullif(_c(c), F.lit(""))


def clean_text(c: Column | str) -> Column:
    """Strip, then empty -> NULL (FN-10 + FLT-5)."""
    return F.nullif(strip(c), F.lit(""))


def strip_quotes(c: Column | str) -> Column:
    """Remove leading/trailing runs of double quotes from an id (FN-11).

    ``btrim(x, '"')`` equals ``regexp_replace(x, '^"+|"+$', '')`` and needs
    no regex engine per row; an id without quotes at its ends is not searched.
    """
    text = _c(c).cast("string")
    return F.when(text.startswith('"') | text.endswith('"'), F.btrim(text, F.lit('"'))).otherwise(text)


# Separator inserted after every non-letter that precedes a letter, so that
# ``initcap`` (which starts words only after a space) starts a word there too;
# removed again afterwards.  A private-use code point never found in text.
_WORD_MARK = "\ue000 "


def title_case(c: Column | str) -> Column:
    """Word-wise title case: a letter run starts upper, continues lower.

    Every maximal run of letters is one word, so ``no-show o'neil`` becomes
    ``No-Show O'Neil`` and ``3rd`` becomes ``3Rd`` (``initcap`` alone would
    give ``No-show O'neil``).  Built from codegen'd ``regexp_replace`` and
    ``initcap``; no arrays or lambdas per row.  Letters and spaces alone need no
    marks.  ``c`` is written twice.
    """
    x = _c(c)
    marked = F.regexp_replace(F.lower(x), r"(\P{L})(?=\p{L})", "$1" + _WORD_MARK)
    return F.when(~x.rlike("[^A-Za-z ]"), F.initcap(x)) \
        .otherwise(F.regexp_replace(F.initcap(marked), _WORD_MARK, ""))


def map_payment(c: Column | str) -> Column:
    """Map known payment spellings on the stripped text, pass the stripped text otherwise."""
    return map_stripped_payment(strip(c))


def map_stripped_payment(t: Column) -> Column:
    """``map_payment`` of a text that is stripped already."""
    expr = None
    for src, dst in PAYMENT_MAP.items():
        expr = (F.when(t == src, F.lit(dst)) if expr is None
                else expr.when(t == src, F.lit(dst)))
    return expr.otherwise(t)


def reason_type(c: Column | str) -> Column:
    """Classify a reason by its wording (FN-14)."""
    low = F.lower(_c(c))
    expr = None
    for word, label in REASON_TYPE_RULES:
        cond = low.contains(word)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(REASON_TYPE_DEFAULT))


def first_non_blank(*cols: Column | str) -> Column:
    """Falsy coalesce ``a or b`` (FN-16 / JOIN-6)."""
    return F.coalesce(*[blank_to_null(x) for x in cols])
