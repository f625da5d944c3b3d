from __future__ import annotations

import math
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from railweave.functions import geo, rules, text, times


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("v"))).collect()]


def folded(s):
    if s is None:
        return ""
    plain = "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn").lower()
    return " ".join(w for w in re.sub("[^a-z0-9]", " ", plain).split() if w not in text.STOP_WORDS)


def test_names(spark):
    values = [None, "", "Gare de Lyon", "Saint-Étienne  Châteaucreux", "Łódź ĳ", "LA LE L", "A" + chr(0x301) + "vila 2", "İstanbul ß ﬁ", "K"] + ["".join(map(chr, range(a, a + 500))) for a in range(0x80, 0xD000, 500)]
    assert column(spark, values, text.normalized_name) == [folded(v) for v in values]


def test_codes(spark):
    values = [None, "", "StopPoint:OCE-87686006", "1234567", "123456789", "x 12345 y", "STOP_12345", "12345é", "é12345", "123456"]
    assert column(spark, values, text.uic_code) == ["", "", "87686006", "1234567", "12345678", "7112345", "", "", "", ""]
    assert column(spark, ["٨٧٦٨٦٠٠٦", "x ١٢٣٤٥ y"], text.uic_code) == ["٨٧٦٨٦٠٠٦", "71١٢٣٤٥"]
    assert column(spark, ["OP_12a3", "none", None], text.first_digits) == ["12", None, None]


def test_train_numbers(spark):
    assert column(spark, ["EUROSTAR_9012-0301", "12", None, "a123456"], text.first_train_number) == ["9012", "12", "", "12345"]
    rows = spark.createDataFrame([(0, " 00123 ", "x"), (1, "AVE 5", "x"), (2, None, "t00123x"), (3, " ", "12"), (4, "000", "x"), (5, None, None)], "i int, s string, t string")
    got = [r[0] for r in rows.orderBy("i").select(text.short_or_train_number(F.col("s"), F.col("t"))).collect()]
    assert got == ["123", "AVE 5", "123", "", "0", ""]


def test_code_variants(spark):
    rows = spark.createDataFrame([(0, "1234567", None), (1, " 123 ", "87654321"), (2, "", "12345678"), (3, None, None)], "i int, a string, b string")
    got = [r[0] for r in rows.orderBy("i").select(text.code_variants(F.col("a"), F.col("b"))).collect()]
    assert got == [["1234567", "81234567"], ["123", "87654321", "7654321"], ["12345678"], []]


def test_times(spark):
    assert column(spark, ["08:05:59", "25:10", None, "", "0805", "-1:30"], times.minutes_of_day) == [485, 1510, 0, 0, 0, -30]
    assert column(spark, ["20240229", "20240230", None, "2024-01-01"], times.iso_date) == ["2024-02-29", None, None, None]
    with pytest.raises(Exception, match="(?i)parse|cast|date"):
        column(spark, ["20240230"], lambda c: times.iso_date(c, strict=True))
    window = column(spark, ["2024-01-01", "2023-12-31", "2024-03-01", "2024-03-02", None], lambda c: F.coalesce(times.in_window(c, "2024-01-01"), F.lit(False)))
    assert window == [True, False, True, False, False]
    assert column(spark, ["1.5", "x", None], times.lenient_double) == [1.5, None, None]
    assert column(spark, [" 2 ", None], times.strict_int) == [2, None]
    with pytest.raises(Exception, match="(?i)cast"):
        column(spark, ["two"], times.strict_int)


def test_distance_and_cells(spark):
    points = [(48.85, 2.35, 48.8509, 2.35), (0.0, 179.9999, 0.0, -179.9999), (89.9999, 0.0, 89.9999, 180.0), (1.0, 1.0, None, 1.0), (float("nan"), 1.0, 1.0, 1.0)]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, a double, b double, c double, d double")
    near = F.exists(geo.around(geo.cell(F.col("c"), F.col("d"))), lambda x: x == geo.cell(F.col("a"), F.col("b")))
    got = rows.orderBy("i").select(geo.haversine_m(*map(F.col, "abcd")), near).collect()
    assert got[0][0] == pytest.approx(100.0754, abs=1e-3)
    assert got[1][0] == pytest.approx(2 * math.radians(1e-4) * geo.EARTH_M, rel=1e-6) and got[1][1]
    assert got[2][0] == pytest.approx(2 * math.radians(1e-4) * geo.EARTH_M, rel=1e-6) and got[2][1]
    assert got[3][0] == got[4][0] == math.inf


def test_rules(spark):
    stops = ["StopPoint:OCETGV INOUI-1", "ouigo", "Train TER", "INTERCITES", "ICE", "rer", "Thalys", "bus", None]
    assert column(spark, stops, rules.type_of_stop_id) == ["TGV InOui", "OUIGO", "TER", "TER", "ICE", "TER" if "TER" in "RER" else "Transilien", "Eurostar", "", ""]
    by_stop = lambda c: rules.type_of_agency_or_stop(F.lit(""), F.coalesce(c, F.lit("")), F.array(F.lit("Car TER")))
    assert column(spark, ["car ter 1", "INTERCITES", "lyria", "tram train", "x", None], by_stop) == ["Car TER", "INTERCITES", "Lyria", "TramTrain", "Car TER", "Car TER"]
    by_agency = lambda c: rules.type_of_agency_or_stop(F.coalesce(c, F.lit("")), F.lit(""), F.array().cast("array<string>"))
    assert column(spark, ["eurostar_continental", "EUROSTAR_CHANNEL", None], by_agency) == ["Thalys", "Eurostar", "Train"]
    assert column(spark, ["Thalys Int", "x", None], lambda c: rules.type_of_merged_agency(F.coalesce(c, F.lit("")))) == ["Eurostar (ex-Thalys)", "Eurostar", "Eurostar"]
    assert column(spark, ["CHANNEL", "continental", None], lambda c: rules.type_of_single_feed_agency(F.coalesce(c, F.lit("")))) == ["EUROSTAR CHANNEL", "EUROSTAR CONTINENTAL", "EUROSTAR"]
    names = lambda c: rules.type_of_route_names(F.lit(""), c, F.lit("1"))
    assert column(spark, ["Avlo x", "ALVIA", "Costa", "", None], names) == ["Avlo", "Alvia", "Costa", "Train Renfe", "nan"]
    assert column(spark, [None], lambda c: rules.type_of_route_names(F.lit(""), c, F.lit("1"), strict=False)) == ["Train Renfe"]
