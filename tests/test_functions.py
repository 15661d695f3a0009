import hashlib

from pyspark.sql import functions as F

from codeloom.functions import levels, parse, text
from codeloom.functions.pricing import PRODUCT_PRICES, TRANSACTION_PRICES, estimate_cost


def one(spark, value, build, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(build(F.col("v")).alias("r")).first()["r"]


def test_strip_removes_every_kind_of_whitespace(spark):
    for raw in ("  a b ", "\ta b\n", "\xa0a b ", "\x1ca b\x0b"):
        assert one(spark, raw, text.strip) == raw.strip() == "a b"


def test_squeeze_and_nullify(spark):
    assert one(spark, " a \n\t b ", text.squeeze) == "a b"
    assert one(spark, "nan", text.nullify) is None
    assert one(spark, "NAN", text.nullify) == "NAN"
    assert one(spark, None, text.nullify) is None


def test_canon_knows_every_empty_token(spark):
    for raw in (None, "", "  ", "None", "NAN", " null", "N/A "):
        assert one(spark, raw, text.canon) == "__null__"
    assert one(spark, " Fee Item ", text.canon) == "fee item"


def test_sanitize_cuts_last(spark):
    raw = "a\x00b\x1f\x7f\x9f\\c" + "x" * 300
    wanted = "".join(c for c in raw if not (ord(c) < 32 or 127 <= ord(c) <= 159)).replace("\\", "\\\\")
    assert one(spark, raw, text.sanitize_description) == wanted
    assert one(spark, raw, lambda c: text.sanitize_description(c, 200)) == wanted[:200]


def test_surrogate_id_ignores_case_and_space(spark):
    wanted = hashlib.sha256(b"AB").hexdigest()[:32]
    assert one(spark, " ab ", text.surrogate_id) == wanted


def test_names_labels_tokens(spark):
    assert one(spark, "Account# (x)", text.sanitize_name) == "Account___x_"
    assert one(spark, None, lambda c: text.path_label(F.lit("A"), c)) == "A > None"
    assert one(spark, "x" * 11, text.estimate_tokens) == 2
    assert one(spark, "nan", text.describe_or_placeholder) == "(no description)"
    assert one(spark, 1234567, text.thousands, "bigint") == "1,234,567"


def test_numbers_and_states(spark):
    for raw, wanted in (("1", 1.0), (" 2.50 ", 2.5), ("1e3", 1000.0), ("abc", None), ("1d", None), ("", None), (None, None)):
        assert one(spark, raw, parse.to_number) == wanted
    for raw, wanted in (("01", 1), ("3.0", 3), ("3.5", None), ("x", None)):
        assert one(spark, raw, parse.to_status) == wanted


def test_mixed_dates(spark):
    for raw, wanted in (
        ("2026-01-26", "2026-01-26"), ("1/5/2024", "2024-01-05"), ("01/26/2026", "2026-01-26"), ("20240105", "2024-01-05"),
        ("2024-01-05 10:11:12", "2024-01-05"), ("05-Mar-2021", "2021-03-05"), ("nonsense", None), (None, None),
    ):
        got = one(spark, raw, parse.to_date_mixed)
        assert (str(got) if got else None) == wanted


def test_lenient_and_strict_match(spark):
    df = spark.createDataFrame([("a", None), ("a", "n/a"), (None, "a"), (" A", "a "), (None, None), ("a", "b")], "p string, t string")
    got = [tuple(r) for r in df.select(levels.match_lenient("p", "t"), levels.match_strict("p", "t")).collect()]
    assert got == [(True, False), (True, False), (False, False), (True, True), (True, True), (False, False)]


def test_cost_of_unknown_model_is_zero(spark):
    def cost(model, prices):
        return one(spark, model, lambda m: estimate_cost(F.lit(1000), F.lit(2000), m, prices))

    assert abs(cost("large", TRANSACTION_PRICES) - 0.165) < 1e-12
    assert abs(cost("large", PRODUCT_PRICES) - 0.055) < 1e-12
    assert cost("other", TRANSACTION_PRICES) == 0.0
