import unicodedata
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lettrage.functions import fixed as fx
from lettrage.functions import scalars as s


def values(spark, function, cases):
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(cases)], "i int, x string")
    return [r.y for r in frame.select("i", function("x").alias("y")).orderBy("i").collect()]


def test_invoice_number(spark):
    cases = [" FVF 385380 ", "aaf31700", None, "", "ABC123", "VF 38/5380", "nan", "VF 12"]
    assert values(spark, s.invoice_number, cases) == ["VF385380", "AAF31700", None, None, None, None, None, "VF12"]


def test_document_type(spark):
    assert values(spark, s.document_type, ["VF1", "fvf 2", "AAF3", "ZZ123", None]) == [
        "FACTURE", "FACTURE", "AVOIR", "UNKNOWN", "UNKNOWN"]


@pytest.mark.parametrize("text, expected", [
    ("1.189.358,56", "1189358.56"), ("865,79-", "-865.79"), ("-865,79", "-865.79"), (" 1 189 358,56 ", "1189358.56"),
    ("1 189,5", "1189.50"), ("(12,00)", "-12.00"), ("1.234", "1234.00"), ("1234.567", "1234.57"), ("123.45", "123.45"),
    ("10 MAD", "10.00"), ("10 dhs", "10.00"), ("+7", "7.00"), ("1.234.567", "1234567.00"), ("10 euro", None), (None, None),
    ("", None), ("abc", None), ("12,34,56", None), ("1,234.56", None), ("1.2.3", None), ("(5", None), ("--5", None), ("NaN", None),
])
def test_amount(spark, text, expected):
    assert values(spark, s.amount, [text]) == [None if expected is None else Decimal(expected)]


def test_date_value(spark):
    day = date(2026, 5, 15)
    cases = ["15/05/26", "15/05/2026", "15.05.2026", "15-5-26", "46157", "46157,9", "2026-05-15T23:30:00-05:00",
             "2026-05-15 10:00", "2026/5/15", " 15/05/2026 "]
    assert values(spark, s.date_value, cases) == [day] * len(cases)
    bad = [None, "", "texte", "31/02/2026", "20260515", "2026-05", "-5", "0", "2026-05-15T25:00"]
    assert values(spark, s.date_value, bad) == [None] * len(bad)
    assert values(spark, s.date_value, ["1/1/69", "1/1/68"]) == [date(1969, 1, 1), date(2068, 1, 1)]


def test_date_token(spark):
    cases = ["20260515", "15052026", "99999999", "18000101", "2026051"]
    assert values(spark, s.date_token, cases) == [date(2026, 5, 15), date(2026, 5, 15), None, None, None]
    assert values(spark, s.table_date, ["15/05/2026", "20260515", "x"]) == [date(2026, 5, 15)] * 2 + [None]


def test_names_and_codes(spark):
    assert values(spark, s.folded_name, ["Société  Étoile", None, "Œuvre"]) == ["SOCIETE ETOILE", "", "ŒUVRE"]
    assert values(spark, s.reference_code, ["000123", "0", "00A1", "50-41"]) == ["123", "0", "00A1", "5041"]
    assert values(spark, s.feed_dealer, ["SAP050413060", "", "000"]) == ["50413060", None, "0"]
    assert values(spark, s.statement_dealer, ["000009", " - "]) == ["000009", None]
    assert values(spark, s.optional_text, ["123.0", " ab  c ", " "]) == ["123", "AB C", None]


def test_header_keys_agree_with_the_python_form(spark):
    titles = [a for aliases in (fx.ERP_ALIASES, fx.RCI_ALIASES) for names in aliases.values() for a in names]
    assert values(spark, s.header_key, titles) == [s.alias_key(a) for a in titles]
    words = fx.REFERENCE_CODE_WORDS + fx.REFERENCE_NAME_WORDS
    assert values(spark, s.reference_key, words) == [s.word_key(a) for a in words]
    assert values(spark, s.header_key, ["N° Facture", "No. facture", "Code département"]) == [
        "numerofacture", "numerofacture", "codedepartement"]


def test_no_alias_belongs_to_two_targets():
    for aliases in (fx.ERP_ALIASES, fx.RCI_ALIASES):
        keys = [k for names in aliases.values() for k in {s.alias_key(n) for n in names}]
        assert len(keys) == len(set(keys))


def test_signed_and_booleans(spark):
    frame = spark.createDataFrame([("AVOIR", 5.0), ("FACTURE", -5.0), ("X", -5.0), (None, 0.0)], "k string, v double")
    assert [float(r[0]) for r in frame.select(s.signed("v", "k")).collect()] == [-5.0, 5.0, -5.0, 0.0]
    assert values(spark, s.boolean, ["Oui", "off", "?"]) == [True, False, None]
    assert values(spark, lambda c: s.lenient_number(c, True), ["1,234.5", "inf", ""]) == [1234.5, None, None]
    assert values(spark, lambda c: s.raw_line(F.array(c, F.lit(" "), F.lit("z"))), ["a"]) == ["a | z"]


def test_names_fold_like_compatibility_forms_over_all_of_unicode(spark):
    """Every code point that Python's tables know, alone and inside a name."""
    points = [p for p in range(1, 0x110000) if not 0xD800 <= p < 0xE000]
    rows = spark.createDataFrame([(p, "a" + chr(p) + "b") for p in points], "point int, value string")
    plain = lambda text: "".join(x for x in unicodedata.normalize("NFKD", text) if not unicodedata.combining(x))
    got = {r.point: r.folded for r in rows.select("point", s.without_accents("value").alias("folded")).collect()}
    assert [(hex(p), got[p]) for p in points if got[p] != plain("a" + chr(p) + "b")] == []


def test_signs_in_names_and_titles(spark):
    row = spark.createDataFrame([("№ 5 ½ ﬁ 한국어 …",)], "v string").select(s.folded_name("v").alias("name"), s.header_key(F.lit("№ facture")).alias("key")).first()
    assert row.name == "NO 5 1⁄2 FI 한국어 ...".replace("한국어", unicodedata.normalize("NFKD", "한국어")) and row.key == "numerofacture"


def test_weeks_and_bare_dates_like_fromisoformat(spark):
    day, cases = date(1990, 1, 1), []
    while day.year < 2101:
        year, week, weekday = day.isocalendar()
        cases += [f"{year}-W{week:02}-{weekday}", f"{year}W{week:02}{weekday}"]
        day += timedelta(days=3)
    cases += [f"{y}-W{w}" for y in range(1990, 2101) for w in ("00", "01", "52", "53", "54")]
    cases += ["20260515T10", "20260515T103000", "20260515 10:30", "20260515T10:30:00.5+02:00", "20261301T10", "2026-W05T10:30", "2026-W05-2 10", "2026W052T1030",
              "2026-W051", "2026W05-1", "2026-W05-8", "2026-W05-0", "0000-W05", "2026-w05", "2026-05-15T1030", "2026-W5"]

    def read(text):
        try:
            return datetime.fromisoformat(text).date()
        except ValueError:
            return None

    got = values(spark, s.date_value, cases)
    assert [(c, g, read(c)) for c, g in zip(cases, got) if g != read(c)] == []


def test_folding_looks_characters_up(spark):
    # a pattern of hundreds of ranges takes a fold many times as long; the one that is left squeezes
    plan = spark.range(1).select(s.folded_name(F.col("id").cast("string")).alias("y"))._jdf.queryExecution().optimizedPlan().toString()
    texts = values(spark, s.folded_name, ["e\u0301 \ufb01\uac01", "\u0300", "x\U0001d165y", "\ufdfa\u00bd\x00\u00e9"])
    assert plan.count("regexp_replace(") == 1
    assert texts == [
        "E FI\u1100\u1161\u11a8", "", "X" + "\U0001d165" * (unicodedata.combining("\U0001d165") == 0) + "Y",
        unicodedata.normalize("NFKD", "\ufdfa\u00bd") + "\x00E"]


def test_reading_a_name_folds_it_once(spark):
    for function in (s.looks_like_name, s.looks_like_code):
        plan = spark.range(1).select(function(F.col("id").cast("string")).alias("y"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("upper(") == 1


def test_blank_texts_and_numbers_that_pass_untouched(spark):
    spaces = ["", " ", "\t\n\x0b\f\r", "\u0085\u00a0\u1680\u2003\u2028\u2029\u202f\u205f\u3000", "\x1c", "\u200b", " x ", "\U0001f600", None]
    blank = [r.b for r in spark.createDataFrame([(x,) for x in spaces], "x string").select(s.is_blank("x").alias("b")).collect()]
    assert blank == [True] * 4 + [False] * 4 + [True]
    numbers = {"VF12": "VF12", "AAF7": "AAF7", "VF12\n": "VF12", "fvf 12": "VF12", "FVF12": "VF12", "VF": None, "VF1x": None, "VF\u0661": None, " aaf 7": "AAF7"}
    frame = spark.createDataFrame([(x,) for x in numbers], "x string").select("x", s.invoice_number("x").alias("n"))
    assert {r.x: r.n for r in frame.collect()} == numbers
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert r"\A(?:VF|AAF)[0-9]+\z" in plan
