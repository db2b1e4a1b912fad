from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import text as X


def apply(spark, function, *values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_fold_text(spark):
    got = apply(
        spark, X.fold_text, "TÓMBOLA", "tombola", "Tómbola", "Año Ñandú", None, "ＡＢ", "Über", ""
    )
    assert got == ["tombola", "tombola", "tombola", "ano nandu", "", "ab", "uber", ""]


def test_es_amount(spark):
    got = apply(spark, X.es_amount, "1.234,56", " 12 ", "-1.000.000,5", "abc", "", None, "1.234,50")
    assert got == [
        Decimal("1234.56"), Decimal("12.00"), Decimal("-1000000.50"), None, None, None, Decimal("1234.50")
    ]


def test_dayfirst(spark):
    got = apply(
        spark, X.dayfirst_ts, "05/03/2025 10:11:12", "5/3/2025", "31/02/2025", "2025-03-05 01:02:03",
        "05-03-2025 10:11", "soon", None, "12345", "05/03/2025 25:00:00",
    )
    assert got == [
        datetime(2025, 3, 5, 10, 11, 12), datetime(2025, 3, 5), None, datetime(2025, 3, 5, 1, 2, 3),
        datetime(2025, 3, 5, 10, 11), None, None, None, None,
    ]


def test_keys(spark):
    assert apply(spark, X.doc_key, "DNI 00123.0", "000", "", None, "7", "x") == [123, None, None, None, 7, None]
    assert apply(spark, X.numeric_id, "123", "123.0", "DNI 5", " 8 ", None) == [123, 123, None, 8, None]


def test_strip_and_money(spark):
    assert apply(spark, X.strip_text, "  a b\t\n") == ["a b"]
    assert apply(spark, X.money_text, 1234567.5, kind="double") == ["$1,234,567.50"]


@pytest.mark.parametrize("zone", ["America/Sao_Paulo", "Asia/Tokyo"])
def test_times_ignore_the_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # Midnight of this day does not exist in Sao Paulo.
        assert apply(spark, X.dayfirst_ts, "04/11/2018 00:30:00") == [datetime(2018, 11, 4, 0, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_folding_other_scripts(spark):
    got = apply(spark, X.fold_text, "Йод ﬁn Ά ½", "ÆØ Ł ﷺ", "ｶﾞ ①", "ÁÉ ñ", "K")
    plain = [X.fold_plain(t).lower() for t in ("Йод ﬁn Ά ½", "ÆØ Ł ﷺ", "ｶﾞ ①", "ÁÉ ñ", "K")]
    assert got == plain


def test_folding_syllables_and_letters_beyond_the_first_plane(spark):
    texts = ["한글 각 뷁 가", "𝐀𝛀 ①ﬁ 한", "丽 𝔘ber 🄐", "é\U000E0100x", "힣 ½ ñ", "日本語"]
    assert apply(spark, X.fold_text, *texts) == [X.fold_plain(t).lower() for t in texts]


def test_short_years_and_half_days(spark):
    got = apply(
        spark, X.dayfirst_ts, "05/07/25 10:00", "05/07/85", "5/7/2025 1:30:00 PM", "05/07/2025 12:15 a. m.",
        "05/07/25 12:00 pm", "05/07/2025 13:00 PM", "05/07/25 11:59:59 p.m.",
    )
    assert got == [
        datetime(2025, 7, 5, 10), datetime(1985, 7, 5), datetime(2025, 7, 5, 13, 30), datetime(2025, 7, 5, 0, 15),
        datetime(2025, 7, 5, 12), None, datetime(2025, 7, 5, 23, 59, 59),
    ]


def test_ids_as_numbers_and_text(spark):
    assert apply(spark, X.numeric_id, "12.345.678", "1.2", "1.7", "12.0", "1.234") == [12345678, None, None, 12, None]
    assert apply(spark, X.text_id, " TX-1 ", "007", "12.0", "", None, "1.2") == ["TX-1", "7", "12", None, None, "1.2"]
