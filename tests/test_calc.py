import pytest
from pyspark.sql import functions as F

from gridspark.functions.calc import band_names, compile_calc, fill_cast


def run(spark, text, rows, names="A double, B double"):
    df = spark.createDataFrame(rows, names)
    out = compile_calc(text, {c: F.col(c) for c in df.columns})
    return [tuple(r) for r in df.select(*(c.alias(f"v{i}") for i, c in enumerate(out))).collect()]


@pytest.mark.parametrize("text, want", [("A+1", 1), ("A+1*5", 5), ("A*5+1", 1), ("1*(A>(-5.57))", 1), ("-A + B", 2), ("A//B", 0), ("B%2", 0), ("np.where(A>0, A, B)", 2), ("np.maximum(A, B)", 2), ("np.clip(B, 0, 1)", 1), ("(A==0)&(B==2)", 1), ("(A + 6) & 3", 2), ("(A + 6) | 8", 14), ("(A + 6) ^ 3", 5), ("~(A + 6)", -7), ("~(A > 0)", 1), ("1*(B & 3)", 2), ("np.logical_and(B, B)", 1)])
def test_expressions(spark, text, want):
    assert run(spark, text, [(0.0, 2.0)])[0][0] == want


def test_masks_propagate(spark):
    for text in ("A+B", "A/0", "np.log(A*0)", "np.sqrt(0-B)", "(A>0)|(B>0)", "np.ma.masked_where(B>0, B)"):
        assert run(spark, text, [(None, 3.0)])[0][0] is None


def test_bits_need_whole_numbers(spark):
    assert run(spark, "A & 1", [(None, 3.0)])[0][0] is None
    with pytest.raises(Exception, match="not whole"):
        run(spark, "A & 1", [(0.5, 3.0)])


def test_several_bands(spark):
    assert run(spark, "np.ma.array([A+B, A*B, A-B])", [(2.0, 3.0)]) == [(5.0, 6.0, -1.0)]


@pytest.mark.parametrize("text", ["__import__('os')", "A.real", "open('x')", "lambda: 1", "X+1", "[a for a in A]", "'text'"])
def test_nothing_else_is_allowed(spark, text):
    with pytest.raises((ValueError, SyntaxError)):
        run(spark, text, [(1.0, 2.0)])


def test_fill_and_wrap(spark):
    df = spark.createDataFrame([(300.0,), (-1.7,), (None,)], "v double")
    one = lambda dtype, no_data=None: [r[0] for r in df.select(fill_cast(F.col("v"), no_data, dtype)).collect()]
    assert one("uint8", 0) == [44, 255, 0]
    assert one("int8", 5) == [44, -1, 5]
    assert one("uint8") == [44, 255, None]


def test_band_names():
    assert band_names(1) == ["A"] and band_names(27)[-1] == "AA" and band_names(26)[-1] == "Z"
