"""Column expressions for the text rules of the legacy system (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def title_case(col: Column | str) -> Column:
    """Python ``str.title()``: upper-case the first letter of every run of letters, lower the rest.

    ``initcap`` only splits on spaces ("O'neil", "3m"); splitting into letter / non-letter runs
    gives "O'Neil", "3M" like Python.
    """
    runs = F.regexp_extract_all(_c(col), F.lit(r"(\p{L}+|\P{L}+)"), 0)
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def capitalize(col: Column | str) -> Column:
    """Python ``str.capitalize()``: first character upper, the rest lower."""
    c = _c(col)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def keep_right(col: Column | str, n: int) -> Column:
    """``RIGHT(REPLICATE('0', n) + s, n)``: fixed width, keeps the rightmost n characters."""
    return F.right(F.concat(F.lit("0" * n), _c(col).cast("string")), F.lit(n))


def zfill(col: Column | str, n: int) -> Column:
    """Python ``zfill`` / ``f'{x:0n}'``: pad with zeros to at least n characters, never cut."""
    s = _c(col).cast("string")
    return F.lpad(s, F.greatest(F.lit(n), F.length(s)), "0")


def cut(col: Column | str, n: int) -> Column:
    """Python slice ``[:n]`` (NULL stays NULL)."""
    return F.substring(_c(col), 1, n)


def decimal14_text(col: Column | str) -> Column:
    """Document number stored as a number, printed as integer text (``DECIMAL(14,0)`` -> text)."""
    return _c(col).cast("decimal(14,0)").cast("string")


def doc_pad_a(col: Column | str) -> Column:
    """Supplier-load padding: 12 -> '00'+, 13 -> '0'+, 10 -> '0'+, otherwise unchanged."""
    s = _c(col)
    n = F.length(s)
    return (F.when(n == 12, F.concat(F.lit("00"), s))
            .when(n == 13, F.concat(F.lit("0"), s))
            .when(n == 10, F.concat(F.lit("0"), s))
            .otherwise(s))


def doc_pad_b(col: Column | str) -> Column:
    """Lookup padding: 12-13 characters -> zfill 14; under 11 -> zfill 11."""
    s = _c(col)
    n = F.length(s)
    return (F.when((n > 11) & (n < 14), F.lpad(s, 14, "0"))
            .when(n < 11, F.lpad(s, 11, "0"))
            .otherwise(s))


def doc_type(col: Column | str) -> Column:
    """11 characters -> '02' (person), 14 -> '01' (company), otherwise '03'."""
    n = F.length(_c(col))
    return F.when(n == 11, F.lit("02")).when(n == 14, F.lit("01")).otherwise(F.lit("03"))


def doc_mask(col: Column | str) -> Column:
    """11 -> ddd.ddd.ddd-dd, 14 -> dd.ddd.ddd/dddd-dd, otherwise unchanged (slices, like the source)."""
    s = _c(col)
    n = F.length(s)

    def part(p: int, k: int) -> Column:
        return F.substring(s, p, k)

    eleven = F.concat(part(1, 3), F.lit("."), part(4, 3), F.lit("."), part(7, 3), F.lit("-"), part(10, 2))
    fourteen = F.concat(part(1, 2), F.lit("."), part(3, 3), F.lit("."), part(6, 3), F.lit("/"), part(9, 4),
                        F.lit("-"), part(13, 2))
    return F.when(n == 11, eleven).when(n == 14, fourteen).otherwise(s)


def doc_unmask(col: Column | str) -> Column:
    """Remove '.', '/' and '-' from a masked document."""
    return F.translate(_c(col), "./-", "")


def lot_item_number(lot: Column | str, item: Column | str, lots: Column | str | None = None) -> Column:
    """Item number that carries its lot.

    With a single lot the item keeps its number; otherwise lot digits are prefixed. When the lot
    exceeds 9 or the item exceeds 99 a '0' separates them: (lot 12, item 5) -> 1205.
    """
    lot_c, item_c = _c(lot), _c(item)
    joined = F.concat(lot_c.cast("string"), item_c.cast("string"))
    sep = F.concat(lot_c.cast("string"), F.lit("0"), item_c.cast("string"))
    base = item_c.cast("string") if lots is None else F.when(_c(lots) == 1, item_c.cast("string")).otherwise(joined)
    return F.when((lot_c > 9) | (item_c > 99), sep).otherwise(base).cast("long")


def year_mod_2000(year: Column | str) -> Column:
    """``year % 2000`` printed without padding (2005 -> '5', 1999 -> '1999')."""
    return (_c(year) % 2000).cast("string")


def year_2digits_fmt(year: Column | str) -> Column:
    """``format(year % 2000, '00')``: at least two digits (2005 -> '05', 1998 -> '1998')."""
    return zfill(_c(year) % 2000, 2)


def year_chars_3_4(year: Column | str) -> Column:
    """``str(year)[2:4]``: third and fourth characters (1998 -> '98', 2005 -> '05')."""
    return F.substring(_c(year).cast("string"), 3, 2)
