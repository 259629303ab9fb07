"""Cleaning and parsing expressions on edge rows, and against plain Python on random text."""

from __future__ import annotations

import datetime as dt
import hashlib
import random
import re
from decimal import Decimal

from pyspark.sql import functions as F

from tillworks import functions as fn

D = dt.date


def test_parse_form_date(evaluate):
    cases = {
        "05/04/2025": D(2025, 5, 4),
        "5/4/2025": D(2025, 5, 4),
        "25/12/2025": D(2025, 12, 25),
        "12/25/2025": D(2025, 12, 25),
        "2025-05-04": D(2025, 5, 4),
        " 2025-05-04 ": D(2025, 5, 4),
        " 2025-5-4\t": D(2025, 5, 4),
        "2025-05-04 10:00:00": D(2025, 5, 4),
        "2025-05-04T23:59:59.5Z": D(2025, 5, 4),
        "2025-05-04 23:00:00-05:00": D(2025, 5, 5),
        "5/4/2025 9:05:00": D(2025, 5, 4),
        "25/12/2025 09:05:00": D(2025, 12, 25),
        "2/29/2024": D(2024, 2, 29),
        "29/2/2024": D(2024, 2, 29),
        "2/30/2025": None, "30/2/2025": None, "n/a": None, "": None, None: None, "2025": None, "2025-05": None,
        "today": None, "10:00": None, "5/4/25": None, "13/13/2025": None, "2025-13-01": None, "5/4/2025 25:00:00": None,
    }
    assert evaluate(fn.parse_form_date, cases) == list(cases.values())


def test_parse_form_timestamp(evaluate):
    cases = {
        "5/4/2025 9:05:00": dt.datetime(2025, 5, 4, 9, 5),
        "25/12/2025 09:05:07": dt.datetime(2025, 12, 25, 9, 5, 7),
        "2025-05-04 10:00:00": dt.datetime(2025, 5, 4, 10),
        "2025-05-04": dt.datetime(2025, 5, 4),
        "5/4/2025": None, "10:00": None, "now": None, None: None,
    }
    shown = evaluate(lambda c: fn.parse_form_timestamp(c).cast("string"), cases)
    assert shown == [v and str(v) for v in cases.values()]


def test_parse_numbers(evaluate):
    cases = {
        "1,200": ("1200", 1200), "KES 280": ("280", 280), "280.00": ("280", 280), "2.5": ("2.5", 3),
        "-2.5": ("-2.5", -3), "0.4": ("0.4", 0), "0.5": ("0.5", 1), "Ksh. 500": ("0.5", 1), "1e3": ("13", 13),
        "5-10": None, "1.2.3": None, "-": None, "abc": None, "": None, None: None,
    }
    numbers = evaluate(fn.parse_form_number, cases)
    integers = evaluate(fn.parse_form_int, cases)
    assert numbers == [v and Decimal(v[0]) for v in cases.values()]
    assert integers == [v and v[1] for v in cases.values()]


def test_dates_and_numbers_against_python(evaluate):
    rng = random.Random(7)
    texts = []
    for _ in range(3000):
        y, m, d = rng.randint(1990, 2030), rng.randint(0, 33), rng.randint(0, 33)
        sep = rng.choice(["/", "-", "/", "."])
        shape = rng.choice(["{0}{3}{1:02d}{3}{2:02d}", "{1}{3}{2}{3}{0}", "{1:02d}{3}{2:02d}{3}{0}", "{1}{3}{2}{3}{0} 1:02:03"])
        texts.append(" " * rng.randint(0, 2) + shape.format(y, m, d, sep) + " " * rng.randint(0, 1))

    def python_date(text):
        t = text.strip()
        for pattern, form in (
            (r"\d{4}-\d\d?-\d\d?", "%Y-%m-%d"), (r"\d\d?/\d\d?/\d{4}", "%m/%d/%Y"), (r"\d\d?/\d\d?/\d{4}", "%d/%m/%Y"),
            (r"\d\d?/\d\d?/\d{4} .*", "%m/%d/%Y %H:%M:%S"), (r"\d\d?/\d\d?/\d{4} .*", "%d/%m/%Y %H:%M:%S"),
        ):
            if re.fullmatch(pattern, t):
                try:
                    return dt.datetime.strptime(t, form).date()
                except ValueError:
                    pass
        return None

    found = evaluate(fn.parse_form_date, texts)
    assert found == [python_date(t) for t in texts]
    assert sum(v is not None for v in found) > 300

    alphabet = "0123456789.,- KESe"
    noisy = ["".join(rng.choices(alphabet, k=rng.randint(0, 8))) for _ in range(3000)]

    def python_number(text):
        kept = re.sub(r"[^0-9.\-]", "", text)
        return Decimal(kept) if re.fullmatch(r"-?(\d+\.?\d*|\.\d+)", kept) else None

    assert evaluate(fn.parse_form_number, noisy) == [python_number(t) for t in noisy]


def test_text_cleaning(evaluate):
    slugs = {"Locks - Moment": "locks_moment", "Grass - 10mm": "grass_10mm", "- Foo": "_foo", "###": "", " A  b\tC ": "a_b_c",
             "Café №5": "caf_5", None: None}
    assert evaluate(fn.product_key_slug, slugs) == list(slugs.values())
    parts = {"Locks - Moment": ("Locks", "Moment"), "A - B - C": ("A", "B"), "Glue": ("Glue", None), "A-B": ("A-B", None)}
    assert evaluate(fn.product_family, parts) == [v[0] for v in parts.values()]
    assert evaluate(fn.product_variant, parts) == [v[1] for v in parts.values()]
    blanks = {" x ": "x", " ": None, "": None, "　": None, None: None}
    assert evaluate(fn.blank_to_null, blanks) == list(blanks.values())
    assert evaluate(fn.null_to_blank, blanks) == ["x", "", "", "", ""]
    assert evaluate(fn.upper_name, [" ann ", None]) == ["ANN", None]


def test_phones(evaluate):
    cases = {"0712345678": "0712345678", " 0112345678 ": "0112345678", "0712345678\n": "0712345678", "712345678": None,
             "254712345678": None, "07123456789": None, "0812345678": None, None: None}
    assert evaluate(fn.validate_phone, cases) == list(cases.values())
    assert evaluate(fn.mask_phone, ["0712345678", None]) == ["0712****78", None]


def test_flags_and_defaults(evaluate):
    flags = {"Yes": True, " TRUE ": True, "1": True, "No": False, "y": False, None: False}
    assert evaluate(fn.parse_bool_flag, flags) == list(flags.values())
    assert evaluate(lambda c: fn.default_if_unparsable(fn.parse_form_int(c), 5), ["", "10", "x", None]) == [5, 10, 5, 5]


def test_surrogate_key(evaluate):
    def digest(text):
        return hashlib.md5(text.encode()).hexdigest()

    key = evaluate(lambda c: fn.surrogate_key(c, F.lit(None), F.lit("z")), ["a", None, ""])
    assert key == [digest("a||z"), digest("||z"), digest("||z")]


def test_division(spark):
    rows = [(Decimal("1"), Decimal("3")), (Decimal("5"), Decimal("0")), (Decimal("5"), None), (Decimal("-1"), Decimal("8"))]
    df = spark.createDataFrame(rows, "a decimal(18,2), b decimal(18,2)")
    got = df.select(fn.safe_divide(F.col("a"), F.col("b")).alias("q"), fn.ratio_pct(F.col("a"), F.col("b")).alias("p")).collect()
    assert [r.q for r in got] == [Decimal("0.3333"), 0, 0, Decimal("-0.1250")]
    assert [r.p for r in got] == [Decimal("33.3"), None, None, Decimal("-12.5")]


def test_rounding_is_half_away_from_zero(spark):
    units = spark.createDataFrame([(1, Decimal("0.125")), (1, Decimal("-0.125")), (3, Decimal("0.335"))], "u bigint, p decimal(27,9)")
    got = [r.v for r in units.select(fn.line_amount(F.col("u"), F.col("p")).alias("v")).collect()]
    assert got == [Decimal("0.13"), Decimal("-0.13"), Decimal("1.01")]


def test_calendar(spark):
    df = spark.createDataFrame([(D(2025, 5, 4),), (D(2025, 5, 5),)], "d date")  # a Sunday and the Monday after it
    got = df.select(fn.day_of_week(df.d), fn.week_start_monday(df.d), fn.month_start(df.d), fn.days_between(F.lit(D(2025, 5, 10)), df.d))
    assert [tuple(r) for r in got.collect()] == [
        (1, D(2025, 4, 28), D(2025, 5, 1), 6), (2, D(2025, 5, 5), D(2025, 5, 1), 5),
    ]
