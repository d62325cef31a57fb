"""Text helpers: case/accent folding, literal containment, regex groups, and
parsing of money and date text (N11-N15, AL-7, AL-8, SR-4 value parsing).

Everything here is a built-in Column expression, so it stays inside
whole-stage codegen.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The combining marks that folding drops.
MARKS = range(0x300, 0x370)


@lru_cache(maxsize=1)
def _accents() -> tuple[str, str]:
    """(characters, what they become): a canonical decomposition with the marks dropped.

    Every character of the basic plane whose decomposition leaves one
    character once its marks are gone becomes that one; the marks themselves
    come last and so have no counterpart, which drops them.
    """
    table = {}
    for code in (c for c in range(0x80, 0x10000) if not 0xD800 <= c < 0xE000):
        bare = "".join(x for x in unicodedata.normalize("NFD", chr(code)) if ord(x) not in MARKS)
        if len(bare) == 1 and bare != chr(code):
            table[chr(code)] = bare
    return "".join(table) + "".join(map(chr, MARKS)), "".join(table.values())


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_accents(c) -> Column:
    """Combining marks off, in composed and in decomposed letters; a text of ASCII alone is passed on as it is.

    Letters that decompose into several others (Hangul syllables) stay composed.
    """
    c = _c(c)
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(F.translate(c, *_accents()))


def fold(c) -> Column:
    """Case and accent folded text (N15): the form used for fuzzy matching."""
    return F.lower(strip_accents(c))


def norm_name(c) -> Column:
    """Upper case, accents removed, trimmed: the name-matching key."""
    return F.trim(F.upper(strip_accents(F.coalesce(_c(c), F.lit("")))))


def squeeze_spaces(c) -> Column:
    """Collapse every whitespace run to one space and trim (N12: ``\\s``, not POSIX)."""
    return F.trim(F.regexp_replace(_c(c), r"\s+", " "))


def fold_spaces(c) -> Column:
    """Lower case with whitespace runs collapsed: text compared modulo layout."""
    return F.lower(squeeze_spaces(c))


def ilike_any(c, patterns) -> Column:
    """``c ILIKE '%p1%' OR c ILIKE '%p2%' ...`` with literal substrings."""
    low = F.lower(_c(c))
    out = None
    for p in patterns:
        t = F.contains(low, F.lit(p.lower()))
        out = t if out is None else (out | t)
    return out if out is not None else F.lit(False)


def contains_ci(a, b) -> Column:
    """Literal case-insensitive containment; ``%``/``_`` are not wildcards."""
    return F.contains(F.lower(_c(a)), F.lower(_c(b)))


def group_or_null(c, pattern: str, idx: int = 1) -> Column:
    """``substring(s from re)`` then ``NULLIF(trim(..), '')``.

    ``regexp_extract`` gives '' when nothing matches, which becomes null here.
    """
    g = F.regexp_extract(_c(c), pattern, idx)
    return F.nullif(squeeze_spaces(g), F.lit(""))


# The ``dd/mm/yyyy-dd/mm/yyyy`` period written into sale lines.
SPAN_RE = r"(\d{2}/\d{2}/\d{4})-(\d{2}/\d{2}/\d{4})"


def make_date_or_null(y: Column, m: Column, d: Column) -> Column:
    """``make_date`` that gives null for impossible dates (31/02) without
    raising: the day is checked against the month's length first."""
    ok_m = (m >= 1) & (m <= 12) & (y >= 1)
    first = F.when(ok_m, F.make_date(y, m, F.lit(1)))
    ok = ok_m & (d >= 1) & (d <= F.dayofmonth(F.last_day(first)))
    return F.when(ok, F.make_date(y, m, d))


def parse_dmy(s: Column) -> Column:
    """``dd/mm/yyyy`` text -> DATE, null when empty or impossible."""
    ok = s.rlike(r"^\d{2}/\d{2}/\d{4}$")
    d = F.when(ok, F.substring(s, 1, 2).cast("int"))
    m = F.when(ok, F.substring(s, 4, 2).cast("int"))
    y = F.when(ok, F.substring(s, 7, 4).cast("int"))
    return make_date_or_null(y, m, d)


def with_span(df, text: str, start: str = "span_start", end: str = "span_end"):
    """Add the two dates of a ``dd/mm/yyyy-dd/mm/yyyy`` span as columns.

    Built in steps (raw text, then numbers, then dates) so each regex runs
    once per row instead of once per use inside a CASE expression.
    """
    out = df.withColumn("__sp1", F.regexp_extract(_c(text), SPAN_RE, 1)) \
            .withColumn("__sp2", F.regexp_extract(_c(text), SPAN_RE, 2))
    for raw, tag in (("__sp1", "a"), ("__sp2", "b")):
        # the regex guarantees digits, so a plain cast is safe once non-empty
        # (a failing try_cast costs an exception per row)
        has = F.col(raw) != ""
        out = out.withColumn(f"__d{tag}", F.when(has, F.substring(raw, 1, 2).cast("int"))) \
                 .withColumn(f"__m{tag}", F.when(has, F.substring(raw, 4, 2).cast("int"))) \
                 .withColumn(f"__y{tag}", F.when(has, F.substring(raw, 7, 4).cast("int")))
    out = out.withColumn(start, make_date_or_null(F.col("__ya"), F.col("__ma"), F.col("__da"))) \
             .withColumn(end, make_date_or_null(F.col("__yb"), F.col("__mb"), F.col("__db")))
    return out.drop("__sp1", "__sp2", "__da", "__ma", "__ya", "__db", "__mb", "__yb")


def span_start(c) -> Column:
    """First date of a ``dd/mm/yyyy-dd/mm/yyyy`` span, null when absent or invalid."""
    return parse_dmy(F.regexp_extract(_c(c), SPAN_RE, 1))


def span_end(c) -> Column:
    return parse_dmy(F.regexp_extract(_c(c), SPAN_RE, 2))


def parse_money_text(c) -> Column:
    """``R$ 1.234,56`` / ``1234,5`` / ``1234.5`` -> double; empty or junk -> null."""
    s = F.trim(F.regexp_replace(F.coalesce(_c(c).cast("string"), F.lit("")), r"(?i)R\$\s?", ""))
    both = F.contains(s, F.lit(",")) & F.contains(s, F.lit("."))
    comma = F.contains(s, F.lit(","))
    s = (F.when(both, F.regexp_replace(F.regexp_replace(s, r"\.", ""), ",", "."))
         .when(comma, F.regexp_replace(s, ",", "."))
         .otherwise(s))
    # parseFloat reads the leading number only.
    lead = F.regexp_extract(s, r"^[+-]?(\d+\.?\d*|\.\d+)", 0)
    return F.when(lead != "", lead.try_cast("double"))


# The spreadsheet day-zero used by serial dates.
SERIAL_EPOCH = "1899-12-30"


def parse_date_text(c) -> Column:
    """Mixed date text -> DATE: serial number, ``d/m/yyyy``, ``d/m/yy``, ISO; else null."""
    s = F.trim(F.coalesce(_c(c).cast("string"), F.lit("")))
    serial = F.when(s.rlike(r"^\d+(\.\d+)?$"),
                    F.date_add(F.lit(SERIAL_EPOCH).cast("date"),
                               F.floor(s.try_cast("double")).cast("int")))
    br = F.regexp_extract(s, r"^(\d{1,2})[/\-](\d{1,2})[/\-](\d{2,4})", 0)
    bd = F.lpad(F.regexp_extract(s, r"^(\d{1,2})[/\-](\d{1,2})[/\-](\d{2,4})", 1), 2, "0")
    bm = F.lpad(F.regexp_extract(s, r"^(\d{1,2})[/\-](\d{1,2})[/\-](\d{2,4})", 2), 2, "0")
    by = F.regexp_extract(s, r"^(\d{1,2})[/\-](\d{1,2})[/\-](\d{2,4})", 3)
    by = F.when(F.length(by) == 2, F.concat(F.lit("20"), by)).otherwise(by)
    brd = F.when(br != "", F.try_to_date(F.concat_ws("-", by, bm, bd), "yyyy-MM-dd"))
    iso = F.regexp_extract(s, r"^(\d{4})[/\-](\d{1,2})[/\-](\d{1,2})", 0)
    iy = F.regexp_extract(s, r"^(\d{4})[/\-](\d{1,2})[/\-](\d{1,2})", 1)
    im = F.lpad(F.regexp_extract(s, r"^(\d{4})[/\-](\d{1,2})[/\-](\d{1,2})", 2), 2, "0")
    idd = F.lpad(F.regexp_extract(s, r"^(\d{4})[/\-](\d{1,2})[/\-](\d{1,2})", 3), 2, "0")
    isod = F.when(iso != "", F.try_to_date(F.concat_ws("-", iy, im, idd), "yyyy-MM-dd"))
    return F.coalesce(serial, brd, isod)
