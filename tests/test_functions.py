"""Functions against the Python standard library on hand-written and generated texts."""

import random
import re
from datetime import datetime
from decimal import Decimal, InvalidOperation

from rowmill import functions as R
from rowmill.functions.dates import DATE_FORMATS
from rowmill.functions.numbers import is_decimal_text, is_integer_text
from rowmill.functions.text import WS_CHARS
from rowmill.operators.normalize import normalise_dates, normalise_decimals


def test_strip(apply):
    texts = [f"{w}a{w}b{w}" for w in WS_CHARS] + ["", "  ", "é ", "​a", None, "x"]
    assert apply(texts, R.strip) == [t if t is None else t.strip() for t in texts]
    assert apply([" ", "\t\n", "a"], R.strip_or_null) == [None, None, "a"]


def python_decimal(text):
    try:
        return str(Decimal(text))
    except InvalidOperation:
        return None


def expected_decimal(text):
    if text is None or not text.strip():
        return None
    v = text.strip()
    dots, commas = v.count("."), v.count(",")
    if dots and commas:
        v = v.replace(",", "") if v.rfind(".") > v.rfind(",") else v.replace(".", "").replace(",", ".")
    elif commas > 1:
        v = v.replace(",", "")
    elif dots > 1:
        v = v.replace(".", "")
    return python_decimal(v)


def staged(spark, texts, function, *args):
    """A column function that works in projections of its own, on two columns of odd names."""
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "i int, `a b` string, `x.y` string")
    rows = function(df, ["a b", "x.y"], *args).orderBy("i").collect()
    assert all(r["a b"] == r["x.y"] for r in rows)
    return [r["x.y"] for r in rows]


def test_decimal(spark, apply):
    random.seed(7)
    texts = [
        "1,000.50", "1.000,50", "1,000,000", "1.000.000", "1,50", "$5", "1.50", "", " ", None, "+5", ".5", "5.",
        "-.5", "007", "-0", "0.000001", "0.0000001", "0.0000000", "0.00000012", "1e3", "1E-10", "1.5e+2", "inf",
        "-Infinity", "NaN", "snan12", "nan007", "1_000", "1__0", "_1", "1d", "1f", "0x1", "1 000", "--1", ".", "-",
        "123456789012345678901234567890.123456789", "1,2,3.4", "1.2.3,4", "1,2.3,4", "\t12\n", "1e", "e5", "0E5",
    ]
    texts += ["".join(random.choice("0159.,-+eE") for _ in range(random.randint(1, 9))) for _ in range(1500)]
    for got in (apply(texts, R.normalize_decimal), staged(spark, texts, normalise_decimals)):
        wrong = [(t, g, expected_decimal(t)) for t, g in zip(texts, got) if g != expected_decimal(t)]
        assert not wrong, wrong[:10]
    given = apply(texts, lambda c: R.normalize_decimal(c, ",", "."))
    assert staged(spark, texts, normalise_decimals, ",", ".") == given


def test_number_grammars(apply):
    random.seed(8)
    texts = ["5", " 5 ", "5.0", "1_000", "1__0", "_1", "+5", "-5", "", None, "1d", "abc", "1e3", "inf", "nan"]
    texts += ["".join(random.choice("0159._-+e ") for _ in range(random.randint(1, 6))) for _ in range(800)]

    def ok(kind):
        def test(t):
            try:
                kind(t)
                return True
            except (ValueError, TypeError, InvalidOperation):
                return False

        return test

    assert apply(texts, is_integer_text) == [ok(int)(t) for t in texts]
    assert apply(texts, is_decimal_text) == [ok(Decimal)(t) for t in texts]
    doubles = apply(texts, R.to_double)
    for t, got in zip(texts, doubles):
        want = float(t) if ok(float)(t) else None
        assert got == want or (got != got and want != want), t


def expected_date(text, source=None):
    if not text:
        return None
    t = text.strip()
    if re.match(r"^\d{4}-\d{2}-\d{2}", t):
        return t[:10]
    for fmt in ([source] if source else []) + list(DATE_FORMATS):
        try:
            return datetime.strptime(t, fmt).strftime("%Y-%m-%d")
        except ValueError:
            continue
    return None


def test_date(spark, apply):
    random.seed(9)
    texts = [
        "2024-99-99", "05/03/2024", "12/31/2024", "20240105", "2024115", "2024-1-5", "31.12.2024", "31/02/2024",
        "2024/2/30", "1/1/2024 5:6:7", "1/1/2024  05:06:61", "2024-1-5 10:00:00", "soon", "", None, " 2024-01-05x ",
        "13/13/2024", "01-02-2003", "30-30-2003",
    ]
    texts += [
        random.choice(["{0}/{1}/{2}", "{0}-{1}-{2}", "{2}/{1}/{0}", "{0}.{1}.{2}", "{2}{1}{0}", "{2}-{1}-{0}"]).format(
            random.randint(0, 40), random.randint(0, 14), random.choice([1999, 2024, 123, 20241])
        )
        for _ in range(1200)
    ]
    for got in (apply(texts, R.normalize_date), staged(spark, texts, normalise_dates)):
        wrong = [(t, g, expected_date(t)) for t, g in zip(texts, got) if g != expected_date(t)]
        assert not wrong, wrong[:10]
    for source in ("%m/%d/%Y", "%d %b %Y", "%y%m%d", "%Y.%m-%d"):
        some = texts + ["5 Jan 2024", "240105", "2024.01-05"]
        want = [expected_date(t, source) for t in some]
        assert apply(some, lambda c: R.normalize_date(c, source)) == want == staged(spark, some, normalise_dates, source)


def test_iso_moment(apply):
    random.seed(10)
    texts = [
        "2024-01-05", "20240105", "2024-01-05T10:11", "2024-01-05 10:11:12.5Z", "2024-01-05T10:11:12,123456789+05:30",
        "2024-W01", "2024-W53-1", "2020-W53-7", "2024W011", "2024-02-30", "2024-1-5", "2024", "2024-01",
        "2024-01-05T24:00", "2024-01-05T1011", "2024-01-05T10", "2024-01-05x10:11", "0000-01-01", "2024-01-05T10:1",
        "2024-01-05T10:60", "20240105T101112", "2024-01-05T10:11:12+0530", "2024-01-05\n", "", None, "2024-01-05T23",
    ]
    texts += [
        f"20{random.randint(0, 30):02}-{random.randint(0, 13):02}-{random.randint(0, 32):02}"
        + random.choice(["", f"T{random.randint(0, 25):02}:{random.randint(0, 61):02}"])
        for _ in range(600)
    ]

    def hour(t):
        try:
            return datetime.fromisoformat(str(t)).hour
        except ValueError:
            return None

    got = apply(texts, R.iso_hour)
    wrong = [(t, g, hour(t)) for t, g in zip(texts, got) if g != hour(t)]
    assert not wrong, wrong[:10]


def test_small_functions(apply):
    assert apply([" A@B.Co ", "a@b", "x", None], R.normalize_email) == ["a@b.co", None, None, None]
    assert apply(["(1) 2-3", "n/a", None], R.normalize_phone) == ["123", None, None]
    assert apply([" Yes", "OFF", "?", None], R.normalize_boolean) == [True, False, None, None]
    assert apply([" a \n b ", " ", None], R.collapse_text) == ["a b", None, None]
    assert apply(["abcdef", "ab"], lambda c: R.truncate(c, 5)) == ["ab...", "ab"]
    assert apply(["my Password", "api_key token", "ok"], R.redact) == [
        "[REDACTED: password]", "[REDACTED: token]", "ok",
    ]
    assert apply(["Order-ID #1", "Größe_2!"], R.normalize_header) == ["orderid 1", "größe_2"]
