"""Value normalisation as column expressions.

Every function takes and returns a ``Column`` (a string is read as a column name), so a
projection built from them stays in one stage. Text that cannot be read becomes null, never an
error, also under ANSI mode.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed as fx

SPACES = "[\\s\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
#: The first character that is no space tells a filled text.
FILLED = "[^" + SPACES[1:-2] + "]"
MONEY = "decimal(18,2)"


def _c(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def squeeze(value) -> Column:
    """Collapse every run of white space, no-break spaces included, to one space and trim."""
    return F.trim(F.regexp_replace(_c(value), SPACES, " "))


def no_spaces(value) -> Column:
    return F.regexp_replace(_c(value), SPACES, "")


def is_null_marker(value) -> Column:
    """True for null and for the texts that stand for it."""
    value = _c(value).cast("string")
    return value.isNull() | F.upper(squeeze(value)).isin(fx.NULL_MARKERS)


def is_blank(value) -> Column:
    value = _c(value).cast("string")
    return value.isNull() | ~value.rlike(FILLED)


def blank_to_null(value) -> Column:
    value = _c(value)
    return F.when(~is_blank(value), value)


def first_present(*values) -> Column:
    """First value that is neither null nor blank."""
    return F.coalesce(*[blank_to_null(v) for v in values])


def let(value, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(_c(value)), body), F.lit(0))


# ---------------------------------------------------------------- invoice numbers

def invoice_number(value) -> Column:
    """``VF`` or ``AAF`` followed by digits, spaces and case ignored, ``FVF`` read as ``VF``; such a number passes untouched."""
    value = _c(value)
    text = F.regexp_replace(F.upper(no_spaces(value)), "^FVF", "VF")
    return F.when(value.rlike(r"\A(?:VF|AAF)[0-9]+\z"), value).when(text.rlike("^(?:VF|AAF)[0-9]+$"), text)


def document_type(value) -> Column:
    text = F.upper(no_spaces(value))
    return (
        F.when(text.rlike("^F?VF[0-9]+$"), fx.FACTURE)
        .when(text.rlike("^AAF[0-9]+$"), fx.AVOIR)
        .otherwise(fx.UNKNOWN)
    )


def kind_of_number(number) -> Column:
    """Document type of an already normalised invoice number."""
    return F.when(F.startswith(_c(number), F.lit("AAF")), fx.AVOIR).otherwise(fx.FACTURE)


# ---------------------------------------------------------------- amounts

_DIGITS = r"[0-9]+(?:[.,][0-9]+)*"


def amount(value) -> Column:
    """French amount text to decimal: ``1.189.358,56``, ``865,79-``, ``(12,00)``, ``1 234 MAD``.

    The cleaned text and its digits are bound once; spelt out per rule they would be matched again
    and again.
    """
    text = F.regexp_replace(no_spaces(value), r"(?i)mad|dhs?|eur|euro|\$", "")

    def read(text: Column) -> Column:
        balanced = F.startswith(text, F.lit("(")) == F.endswith(text, F.lit(")"))
        negative = F.contains(text, F.lit("-")) | F.contains(text, F.lit("("))
        number = F.regexp_extract(text, r"^\(?[+-]?(" + _DIGITS + r")-?\)?$", 1)
        sign = F.when(balanced, F.when(negative, -1).otherwise(1))
        return let(number, lambda n: (_decimal(n) * sign).cast(MONEY))

    return let(text, read)


def _decimal(number: Column) -> Column:
    plain = (
        # decimal comma: dots before it are thousands marks
        F.when(number.rlike(r"^[0-9.]+,[0-9]+$"), F.translate(number, ",.", "."))
        .when(number.rlike(r"^[0-9]{1,3}\.[0-9]{3}$"), F.translate(number, ".", ""))
        .when(number.rlike(r"^[0-9]+(?:\.[0-9]+)?$"), number)
        .when(number.rlike(r"^[0-9]+(?:\.[0-9]{3}){2,}$"), F.translate(number, ".", ""))
    )
    return plain.try_cast(MONEY)


def money(value, dtype: str) -> Column:
    """Amount of a column of any type: numbers are rounded to cents, text is parsed."""
    if dtype == "string":
        return amount(value)
    if dtype == "boolean":
        return F.lit(None).cast(MONEY)
    return _c(value).try_cast(MONEY)


def signed(value, kind) -> Column:
    """Credit notes are negative, invoices positive, other documents keep their sign."""
    value = _c(value)
    factors = F.create_map(F.lit(fx.AVOIR), F.lit(-1), F.lit(fx.FACTURE), F.lit(1))
    factor = F.coalesce(F.try_element_at(factors, _c(kind)), F.signum(value).cast("int"))
    return (F.abs(value) * factor).cast(MONEY)


def lenient_number(value, drop_commas: bool = False) -> Column:
    """Number or null for empty, unreadable, NaN and infinite text."""
    text = F.trim(_c(value).cast("string"))
    if drop_commas:
        text = F.translate(text, ",", "")
    number = text.try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


# ---------------------------------------------------------------- dates

def _iso(year: Column, month: Column, day: Column) -> Column:
    text = F.concat(year, F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(day, 2, "0"))
    return F.when(year != "0000", text.try_cast("date"))


def excel_serial(value) -> Column:
    """Days since 1899-12-30; null when not positive, infinite or past year 9999."""
    days = F.floor(_c(value).cast("double"))
    usable = (_c(value).cast("double") > 0) & (days <= fx.EXCEL_LAST_DAY)
    return F.when(usable, F.date_add(F.lit(fx.EXCEL_EPOCH).cast("date"), days.cast("int")))


_CLOCK = r"(?:[01][0-9]|2[0-3])(?::[0-5][0-9](?::[0-5][0-9](?:[.,][0-9]+)?)?)?(?:Z|[+-][0-9]{2}:?[0-9]{2})?"
_BARE_CLOCK = r"(?:[01][0-9]|2[0-3])(?:[0-5][0-9](?:[0-5][0-9](?:[.,][0-9]+)?)?)?(?:Z|[+-][0-9]{2}:?[0-9]{2})?"
_TIME = f"(?:(?s:.)(?:{_CLOCK}|{_BARE_CLOCK}))"
_ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}" + _TIME + "?$"
#: Without marks only with a time: eight digits alone are a serial number.
_ISO_BARE = r"^[0-9]{8}" + _TIME + "$"
_ISO_WEEK = r"^([0-9]{4})(?:-W([0-9]{2})(?:-([1-7]))?|W([0-9]{2})([1-7])?)" + _TIME + "?$"
_DAY_FIRST = r"^[0-9]{1,2}([/.-])[0-9]{1,2}\1(?:[0-9]{4}|[0-9]{2})$"
_YEAR_FIRST = r"^[0-9]{4}([/-])[0-9]{1,2}\1[0-9]{1,2}$"
_YEAR_FIRST_CLOCK = (
    r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} (?:2[0-3]|[01]?[0-9]):[0-5]?[0-9]:(?:6[01]|[0-5]?[0-9])$"
)


def _full_year(year: Column) -> Column:
    # two digits: 69 and later belong to the 1900s
    return F.when(F.length(year) == 4, year).when(year >= "69", F.concat(F.lit("19"), year)).otherwise(
        F.concat(F.lit("20"), year)
    )


def iso_week_day(text: Column) -> Column:
    """The day of a week of the ISO calendar, Monday if none is named: week 1 is the one with the year's first Thursday."""
    group = lambda *n: F.coalesce(*[F.nullif(F.regexp_extract(text, _ISO_WEEK, i), F.lit("")) for i in n])
    year, week, weekday = group(1), group(2, 4).cast("int"), F.coalesce(group(3, 5), F.lit("1")).cast("int")
    fourth = F.concat(year, F.lit("-01-04")).try_cast("date")
    day = F.date_add(fourth, week * 7 + weekday - 8 - F.weekday(fourth))
    return F.when((week > 0) & (F.date_part(F.lit("YEAROFWEEK"), day) == year.cast("int")) & (year != "0000"), day)


def date_value(value) -> Column:
    """Date of a text cell: Excel serial, ISO (time and zone dropped) or day-first forms."""

    def read(text: Column) -> Column:
        serial = F.translate(text, ",", ".").try_cast("double")
        pieces = lambda use: let(F.split(text, "[/. -]"), lambda p: use(*[F.get(p, F.lit(i)) for i in range(3)]))
        year_first = text.rlike(_YEAR_FIRST) | text.rlike(_YEAR_FIRST_CLOCK)
        return (
            F.when(text.rlike(r"^[0-9]+(?:[.,][0-9]+)?$"), excel_serial(serial))
            .when(text.rlike(_DAY_FIRST), pieces(lambda d, m, y: _iso(_full_year(y), m, d)))
            .when(text.rlike(_ISO), F.when(~F.startswith(text, F.lit("0000")), F.substring(text, 1, 10).try_cast("date")))
            .when(text.rlike(_ISO_BARE), _iso(F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)))
            .when(text.rlike(_ISO_WEEK), iso_week_day(text))
            .when(year_first, pieces(_iso))
        )

    return let(squeeze(value), read)


def day(value, dtype: str) -> Column:
    """Date of a column of any type."""
    if dtype == "date":
        return _c(value)
    if dtype.startswith("timestamp"):
        return _c(value).cast("date")
    if dtype == "string":
        return date_value(value)
    if dtype == "boolean" or dtype == "void":
        return F.lit(None).cast("date")
    return excel_serial(value)


def date_token(token) -> Column:
    """Eight digits, ``yyyyMMdd`` or ``ddMMyyyy``, in the plausible years.

    Digits that start like a year are only tried as a year.
    """
    token = _c(token)
    first, last = map(str, fx.FEED_YEARS)
    piece = lambda start, n: F.substring(token, start, n)
    in_range = lambda year, read: F.when(year.between(first, last), read)
    return F.when(
        F.length(token) == 8,
        F.when(piece(1, 2).isin("19", "20"), in_range(piece(1, 4), _iso(piece(1, 4), piece(5, 2), piece(7, 2)))).when(
            piece(5, 2).isin("19", "20"), in_range(piece(5, 4), _iso(piece(5, 4), piece(3, 2), piece(1, 2)))
        ),
    )


def table_date(value) -> Column:
    """Date of a bank table cell: the usual forms, else an eight-digit token."""
    text = F.trim(_c(value))
    return F.coalesce(date_value(value), F.when(text.rlike("^[0-9]{8}$"), date_token(text)))


# ---------------------------------------------------------------- text

def text_value(value) -> Column:
    return F.upper(squeeze(F.coalesce(_c(value), F.lit(""))))


def optional_text(value) -> Column:
    """Trimmed upper-case text, blank as null, ``123.0`` as ``123``."""
    text = F.regexp_replace(F.upper(squeeze(value)), r"^([0-9]+)\.0$", "$1")
    return F.nullif(text, F.lit(""))


def _folds() -> tuple[str, str, list[tuple[str, str]]]:
    """How characters lose their marks and compatibility forms: one to one over all of Unicode but the composed Hangul
    syllables, and the characters that become several."""
    source, target, longer = [], [], []
    for point in range(0xA0, 0x30000):
        if _HANGUL <= point < 0xE000:
            continue
        char = chr(point)
        form = unicodedata.normalize("NFKD", char)
        if form == char:
            continue
        plain = "".join(x for x in form if not unicodedata.combining(x))
        if len(plain) == 1:
            source.append(char)
            target.append(plain)
        elif plain:
            longer.append((char, plain))
    return "".join(source), "".join(target), longer


#: Composed Hangul syllables by code point: the first one, and how many begin, middle and end consonants and vowels make them up.
_HANGUL, _BEGINS, _MIDDLES, _ENDS = 0xAC00, 19, 21, 28
#: Characters of which nothing is left without marks: those that change the one before them. A pattern of so many ranges
#: would test them one by one for every character of a text; translation looks each character up once.
_COMBINING = "".join(chr(p) for p in range(0x300, 0x30000) if all(map(unicodedata.combining, unicodedata.normalize("NFKD", chr(p)))))
_FOLD_FROM, _FOLD_TO, _FOLD_LONGER = _folds()
_FOLD_TABLE = "\x00".join(["", *(a + b for a, b in _FOLD_LONGER), ""])
_SEVERAL = "".join(a for a, _ in _FOLD_LONGER)
_SYLLABLES = f"[{chr(_HANGUL)}-{chr(_HANGUL + _BEGINS * _MIDDLES * _ENDS - 1)}]"


def _syllable(char: Column) -> Column:
    """The letters of a composed Hangul syllable, by arithmetic on its code point."""
    index = F.ascii(char) - _HANGUL
    letters = lambda first, n: F.lit("".join(map(chr, range(first, first + n))))
    begin = F.substring(letters(0x1100, _BEGINS), F.floor(index / (_MIDDLES * _ENDS)).cast("int") + 1, F.lit(1))
    middle = F.substring(letters(0x1161, _MIDDLES), F.floor(index / _ENDS).cast("int") % _MIDDLES + 1, F.lit(1))
    end = F.when(index % _ENDS > 0, F.substring(letters(0x11A8, _ENDS - 1), index % _ENDS, F.lit(1))).otherwise("")
    return F.concat(begin, middle, end)


def _spelt_out(text: Column) -> Column:
    """Characters that become several, such as ligatures, signs, fractions and Hangul, spelt out; few texts hold any."""

    def spelt(char: Column) -> Column:
        at = F.instr(F.lit(_FOLD_TABLE), F.concat(F.lit("\x00"), char))
        listed = F.substring_index(F.substring(F.lit(_FOLD_TABLE), at + 2, F.lit(32)), "\x00", 1)
        code = F.ascii(char)
        hangul = (code >= _HANGUL) & (code < _HANGUL + _BEGINS * _MIDDLES * _ENDS)
        # the table is searched for characters only that it lists
        several = F.translate(char, _SEVERAL, "") == ""
        return F.when(code < 0xA0, char).when(hangul, _syllable(char)).when(several, listed).otherwise(char)

    whole = F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), spelt), "")
    return F.when((F.translate(text, _SEVERAL, "") != text) | text.rlike(_SYLLABLES), whole).otherwise(text)


def without_accents(value) -> Column:
    """Letters without marks, in their compatibility form; plain ASCII text passes through untouched."""
    text = _c(value)
    folded = F.translate(text, _FOLD_FROM + _COMBINING, _FOLD_TO)
    return F.when(text.rlike(r"[^\x00-\x7F]"), _spelt_out(folded)).otherwise(text)


def folded_name(value) -> Column:
    """Accent-free, single-spaced, upper-case name; empty when null."""
    return F.upper(squeeze(without_accents(F.coalesce(_c(value).cast("string"), F.lit("")))))


def _no_leading_zeros(text: Column) -> Column:
    # only where nothing but digits follows, and one digit is left
    return F.regexp_replace(text, "^0+(?=[0-9]+$)", "")


def reference_code(value) -> Column:
    """Folded name reduced to letters and digits; leading zeros dropped from numbers."""
    return _folded_code(folded_name(value))


def _folded_code(folded: Column) -> Column:
    return _no_leading_zeros(F.regexp_replace(folded, "[^A-Z0-9]", ""))


def feed_dealer(value) -> Column:
    """Dealer code of a bank table: ``SAP`` and leading zeros dropped."""
    text = F.regexp_replace(F.replace(F.upper(squeeze(value)), F.lit("SAP"), F.lit("")), "[^A-Z0-9]", "")
    return F.nullif(_no_leading_zeros(text), F.lit(""))


def statement_dealer(value) -> Column:
    """Dealer code of a statement line: zeros kept."""
    return F.nullif(F.regexp_replace(F.upper(squeeze(value)), "[^A-Z0-9]", ""), F.lit(""))


def header_key(value) -> Column:
    """Canonical form of a column title: ``N° facture`` and ``No facture`` meet as ``numerofacture``."""
    text = F.lower(without_accents(value))
    text = F.replace(F.replace(text, F.lit("n°"), F.lit("numero")), F.lit("nº"), F.lit("numero"))
    text = F.regexp_replace(text, r"\bno\.?\b", "numero")
    text = F.regexp_replace(text, r"\bnum\.?\b", "numero")
    text = F.regexp_replace(text, r"\bn\b", "numero")
    return F.regexp_replace(text, "[^a-z0-9]+", "")


def alias_key(text: str) -> str:
    """`header_key` of an unaccented alias, for building lookup arrays."""
    text = re.sub(r"\b(?:no|num)\b\.?|\bn\b", "numero", text.lower())
    return re.sub("[^a-z0-9]+", "", text)


def word_key(text: str) -> str:
    """`reference_key` of an unaccented title word."""
    return re.sub("[^a-z0-9]+", "", text.lower())


def reference_key(value) -> Column:
    """Canonical form of a coverage-list title."""
    return folded_key(folded_name(value))


def folded_key(folded) -> Column:
    """`reference_key` of a name that is folded already."""
    return F.regexp_replace(F.lower(_c(folded)), "[^a-z0-9]+", "")


def boolean(value, default: bool | None = None) -> Column:
    """Boolean of a text; ``default`` when it is empty or not understood."""
    text = F.lower(F.trim(_c(value).cast("string")))
    read = F.when(text.isin(fx.YES_WORDS), True).when(text.isin(fx.NO_WORDS), False)
    return read if default is None else F.coalesce(read, F.lit(default))


def looks_like_name(value) -> Column:
    return let(folded_name(value), lambda text: (F.length(text) >= 2) & text.rlike("[A-Z]"))


def looks_like_code(value) -> Column:
    def shaped(code: Column) -> Column:
        shape = F.when(code.rlike("[0-9]"), code.rlike("^[A-Z0-9]{2,20}$")).otherwise(code.rlike("^[A-Z]{2,5}$"))
        return (code != "") & shape

    return let(folded_name(value), lambda name: ~F.contains(name, F.lit(" ")) & let(_folded_code(name), shaped))


def raw_line(cells) -> Column:
    """Non-blank cells joined by `` | ``."""
    return F.array_join(F.filter(_c(cells), lambda x: ~is_blank(x)), " | ")
