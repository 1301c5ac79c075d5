import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from saltmarsh.functions import dates, geo, numbers, text
from saltmarsh.functions.documents import append_to_json_array, parse_records


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_masking_keeps_only_the_allowed_parts(spark):
    df = spark.createDataFrame(
        [("Anna", "13812345678", "a_b@mail.example"), ("B", "12345", "no-mail"), (None, None, None)],
        "name string, phone string, mail string",
    )
    out = df.select(text.mask_name(F.col("name")), text.mask_phone(F.col("phone")), text.mask_email(F.col("mail"))).collect()
    assert [tuple(r) for r in out] == [("A*", "138*", "*@mail.example"), ("B*", None, None), (None, None, None)]


def test_pseudonym_only_of_valid_values(spark):
    got = one(spark, text.pseudonym(F.lit("13812345678"), text.PHONE_PATTERN), text.pseudonym(F.lit("x"), text.PHONE_PATTERN))
    assert len(got[0]) == 32 and got[1] is None


def test_last_token_ignores_trailing_separators(spark):
    assert one(spark, text.last_token(F.lit("a,b,")), text.last_token(F.lit("solo")), text.last_token(F.lit(""))) == ("b", "solo", "")


def test_hash_bucket_and_override(spark):
    import hashlib

    want = f"{int(hashlib.md5(b'key').hexdigest()[-3:], 16) % 16:04d}"
    assert one(spark, text.hash_bucket(F.lit("key"), 16), text.hash_bucket(F.lit("key"), 16, {"key": "0099"})) == (want, "0099")


def test_first_letter_case_and_array_text(spark):
    got = one(
        spark, text.upper_first(F.lit("abc")), text.lower_first(F.lit("ABC")), text.array_text(F.array(F.lit(1), F.lit(2))),
        text.array_text(F.lit(None).cast("array<int>")), text.cut(F.lit("x" * 300)),
    )
    assert got == ("Abc", "aBC", "[1,2]", "[]", "x" * 255)


def test_rule_texts(spark):
    args = [F.lit("100"), F.lit("3"), F.lit("20"), F.lit("8")]
    assert one(spark, text.activity_rule(F.lit("3101"), *args), text.activity_rule(F.lit("3103"), *args), text.coupon_rule(F.lit("3203"), *args)) == (
        "满100元减20元", "打8折", "减20元")


@pytest.mark.parametrize("birthday,sign,age", [
    ("2000-12-22", "摩羯座", 24), ("2000-01-19", "摩羯座", 25), ("2000-01-20", "水瓶座", 25), ("2000-02-29", "双鱼座", 25),
    ("2000-08-01", "狮子座", 25), ("2000-08-02", "狮子座", 24),
])
def test_zodiac_and_age(spark, birthday, sign, age):
    b, on = dates.as_date(birthday), dates.as_date("2025-08-01")
    assert one(spark, dates.zodiac_sign(b), dates.age_years(b, on), dates.birth_decade(b)) == (sign, age, 2000)


@pytest.mark.parametrize("hour,label", [(0, "凌晨"), (5, "凌晨"), (6, "早晨"), (11, "上午"), (12, "中午"), (14, "下午"), (21, "晚上"), (22, "夜间")])
def test_time_slot_boundaries(spark, hour, label):
    assert one(spark, dates.time_slot(F.lit(dt.datetime(2024, 1, 1, hour, 59)))) == (label,)


def test_compact_stamp_and_epoch_forms(spark):
    got = one(
        spark, dates.compact_stamp_to_millis(F.lit("20240101080000")), dates.compact_stamp_to_millis(F.lit("2024")),
        dates.compact_stamp_to_millis(F.lit("20241399999999")), dates.seconds_or_millis(F.lit("1700000000")),
        dates.seconds_or_millis(F.lit("1700000000000")), dates.seconds_or_millis(F.lit("bad")), dates.epoch_day(F.lit(1)),
    )
    assert got == (1704067200000, 0, 0, 1700000000000, 1700000000000, None, dt.date(1970, 1, 2))


def test_exact_ratio_rounds_half_up_and_guards_zero(spark):
    def r(a, b, scale=2):
        return numbers.exact_ratio(F.lit(a), F.lit(b), scale)

    got = one(spark, r(57, 200), r(1, 8), r(1, 0), r(1, 3, 4), numbers.percent(F.lit(1), F.lit(0)), numbers.ratio(F.lit(1), F.lit(0), 2, 0.0))
    assert [None if g is None else float(g) for g in got] == [0.29, 0.13, None, 0.3333, 100.0, 0.0]


def test_amount_parsing(spark):
    got = one(spark, numbers.parse_amount(F.lit("1.005")), numbers.parse_amount(F.lit("n/a")), numbers.parse_amount(F.lit(None).cast("string")),
              numbers.clamp_zero(F.lit(-1).cast("decimal(18,2)")))
    assert [float(g) for g in got] == [1.01, 0.0, 0.0, 0.0]


def test_dirty_json_is_marked(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("{oops",), ("plain",), (None,)], "v string")
    out = parse_records(df, "v", "a int").select("v", "rec.a", "is_dirty").collect()
    assert [(r["a"], r["is_dirty"]) for r in out] == [(1, False), (None, True), (None, True), (None, False)]


def test_json_array_append(spark):
    assert one(spark, append_to_json_array(F.lit('["a"]'), F.lit("b")), append_to_json_array(F.lit(None).cast("string"), F.lit("b"))) == ('["a","b"]', '["b"]')


def test_clean_text(spark):
    got = one(spark, text.is_clean_text(F.lit("好abc1")), text.is_clean_text(F.lit("tab\t")), text.is_clean_text(F.lit("")), text.is_clean_text(F.lit(None).cast("string")))
    assert got == (True, False, False, False)


def test_ellipsoid_known_lengths():
    # one degree of longitude on the equator and of latitude from the equator
    got = geo.ellipsoid_metres([0.0, 0.0, 10.0, 0.0], [0.0, 0.0, 20.0, 179.5], [0.0, 1.0, 10.0, 0.0], [1.0, 0.0, 20.0, -179.5])
    assert got[0] == pytest.approx(111319.491, abs=0.01)
    assert got[1] == pytest.approx(110574.389, abs=0.01)
    assert got[2] == 0.0
    assert got[3] == pytest.approx(111319.491, abs=0.01)  # the short way across the date line


def test_ellipsoid_does_not_converge_for_antipodes():
    assert np.isnan(geo.ellipsoid_metres([0.0], [0.0], [0.3], [179.9])[0])


def test_native_ellipsoid_equals_arrays(spark):
    rng = np.random.default_rng(7)
    lat, lon = rng.uniform(-90, 90, (2, 300)), rng.uniform(-180, 180, (2, 300))
    lat[1, :100], lon[1, :100] = lat[0, :100] + 0.001, lon[0, :100] - 0.002
    points = [*zip(lat[0], lon[0], lat[1], lon[1]), (0.0, 0.0, 0.3, 179.9), (10.0, 20.0, 10.0, 20.0), (0.0, 179.5, 0.0, -179.5), (90.0, 0.0, -90.0, 0.0), (0.0, 0.0, 0.0, 180.0)]
    points = [tuple(float(x) for x in p) for p in points]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)] + [(len(points), None, 1.0, 2.0, 3.0)], "i int, a double, b double, c double, d double")
    got = [r[0] for r in df.select("i", geo.ellipsoid_distance(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("m")).orderBy("i").select("m").collect()]
    assert got[-1] is None
    want = geo.ellipsoid_metres(*zip(*points))
    assert np.isnan(want[300]) and want[301] == 0.0
    # both stop once a step is below 1e-12 radians, some micrometres on the ground
    assert np.allclose(np.array(got[:-1], dtype="float64"), want, atol=1e-4, rtol=0, equal_nan=True)
