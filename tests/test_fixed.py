"""Quotients that are cut off, against Python's decimal with ROUND_DOWN."""

import decimal
import random
from decimal import ROUND_DOWN, ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from procura.checks.registry import pipeline_for
from procura.config import ExtractConfig
from procura.functions import fixed
from procura.functions import formulas as fm

CFG = ExtractConfig.fixture()
CUT = CFG.with_(decimal_division="truncate")
KINDS = [((36, 18), (18, 6)), ((38, 6), (3, 0)), ((38, 7), (3, 0)), ((18, 6), (18, 6)), ((18, 6), (10, 0)), ((9, 2), (5, 5)),
         ((38, 18), (28, 4)), ((5, 0), (3, 1)), ((12, 12), (4, 0))]


def _number(rnd, kind, most):
    digits = rnd.randint(0, min(kind[0], most))
    return Decimal(rnd.choice([1, -1]) * rnd.randint(0, 10**digits - 1 if digits else 0)).scaleb(-kind[1])


@pytest.mark.parametrize(("a", "b"), KINDS)
def test_quotients_against_decimal(spark, a, b):
    rnd = random.Random(f"{a}{b}")
    precision, scale = fixed.quotient_kind(a, b)
    with decimal.localcontext(decimal.Context(prec=120)):
        pairs = [(_number(rnd, a, 38), _number(rnd, b, 38)) for _ in range(300)]
        edge = Decimal(10**b[0] - 1).scaleb(-b[1])
        pairs += [(Decimal(0), edge), (Decimal(1).scaleb(-a[1]), edge), (Decimal(10**a[0] - 1).scaleb(-a[1]), edge)]
        pairs = [(x, y) for x, y in pairs if y and abs(x / y) < Decimal(10) ** (precision - scale)]
        want = {(x, y): (x / y).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_DOWN) for x, y in pairs}
    df = spark.createDataFrame(pairs, f"a decimal({a[0]},{a[1]}), b decimal({b[0]},{b[1]})")
    out = fixed.with_quotient(df, "q", "a", a, "b", b)
    assert out.columns == ["a", "b", "q"] and out.schema["q"].dataType.simpleString() == f"decimal({precision},{scale})"
    assert out.schema["q"].dataType == df.select((F.col("a") / F.col("b")).alias("q")).schema["q"].dataType
    got = {(r.a, r.b): r.q for r in out.collect()}
    wrong = {k: (got.get(k), w) for k, w in want.items() if got.get(k) != w}
    assert len(pairs) > 100 and not wrong


def test_nulls_and_zero_divisors(spark):
    df = spark.createDataFrame([(Decimal(1), Decimal(0)), (None, Decimal(0)), (Decimal(1), None)], "a decimal(36,18), b decimal(18,6)")
    assert [r.q for r in fixed.with_quotient(df, "q", "a", (36, 18), "b", (18, 6)).collect()] == [None] * 3
    strict = fixed.with_quotient(df, "q", "a", (36, 18), "b", (18, 6), null_on_zero=False)
    assert strict.filter("a IS NULL OR b IS NULL").select("q").distinct().collect() == [(None,)]
    with pytest.raises(Exception, match="ZERO"):
        strict.collect()
    with pytest.raises(ValueError):
        fixed.with_quotient(df, "q", "a", (36, 18), "b", (38, 6))


def _down(x, n):
    return x.quantize(Decimal(1).scaleb(-n), rounding=ROUND_DOWN)


def _nearest(x, n):
    return x.quantize(Decimal(1).scaleb(-n), rounding=ROUND_HALF_UP)


def _expected(st, ext, d, a, q, p, sq, stx, pct):
    """The formulas step by step, each with its type's scale: quotients cut off, products rounded."""
    if st not in (0, 1):
        return None, None, None
    material = ext == 1
    over = q if material else p
    share = _down((d if material else a) / over, 14) if over else None
    if share is None:
        return (pct if st else None), None, None
    if st == 0:
        part = _nearest(share * sq, 6)
        tax = _nearest((part if material else share) * stx, 6)
        net = _nearest(part * p, 6) if material else part
        return (_nearest(part, 4) if material else part), _nearest(net + tax, 3), tax
    tax = _nearest(share * stx, 6)
    net = _down(_nearest(_nearest(pct * d, 7) * p, 6) / 100, 6) if material else _down(_nearest(pct * a, 7) / 100, 7)
    return pct, _nearest(_nearest(net + tax, 6), 3), tax


def test_formula_grid(spark):
    rnd, rows = random.Random(2), []
    for st in (0, 1, 2):
        for ext in (1, 2, 3):
            for _ in range(40):
                number = lambda hi, places: Decimal(rnd.randint(-hi, hi)).scaleb(-places)
                rows.append((st, ext, number(10**9, 6), number(10**9, 7), rnd.choice([number(10**8, 6), Decimal(0), Decimal(3)]),
                             rnd.choice([number(10**8, 6), Decimal(0), Decimal(7)]), number(10**16, 6), number(10**16, 6), number(10**8, 6)))
    names = ("st", "ext", "d", "a", "q", "p", "sq", "stx", "pct")
    df = spark.createDataFrame(rows, "st int, ext int, d decimal(36,18), a decimal(36,18), q decimal(18,6), p decimal(18,6), "
                                     "sq decimal(18,6), stx decimal(18,6), pct decimal(18,6)")
    st, ext, d, a, q, p, sq, stx, pct = names
    cut = fm.with_cut_quotients(df, st, ext, d, a, q, p, pct, CUT)
    columns = lambda cfg: (fm.split_quantity(st, ext, d, a, q, p, sq, pct, cfg).alias("qty"),
                           fm.split_item_total(st, ext, d, a, q, p, sq, stx, pct, cfg).alias("total"),
                           fm.split_tax(st, ext, d, a, q, p, sq, stx, cfg).alias("tax"))
    with decimal.localcontext(decimal.Context(prec=100)):
        for r in cut.select(*names, *columns(CUT)).collect():
            assert (r.qty, r.total, r.tax) == _expected(*r[:9]), r
    rounded = {r[:9]: tuple(r[9:]) for r in df.select(*names, *columns(CFG)).collect()}
    assert any(tuple(r[9:]) != rounded[r[:9]] for r in cut.select(*names, *columns(CUT)).collect())


def test_truncated_extract_differs_in_last_digits_only(spark):
    p = pipeline_for(spark, SF_SMALL)
    a = {r.order_split_item_id: r for r in p.split_lines.collect()}
    b = {r.order_split_item_id: r for r in p.split_lines_truncated.collect()}
    assert a.keys() == b.keys()
    assert all((a[k].tax is None) == (b[k].tax is None) and (a[k].tax is None or abs(a[k].tax - b[k].tax) < Decimal("0.01")) for k in a)


def test_setting_is_checked():
    with pytest.raises(ValueError):
        CFG.with_(decimal_division="floor")
