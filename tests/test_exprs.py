import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import exprs as X
from ledgerloom.functions.sql import register_sql_functions


def rows(spark, values, *columns):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    return [tuple(r) for r in df.select(*columns).collect()]


def digits_by_hand(base):
    for weights in (X.WEIGHTS_FIRST, X.WEIGHTS_SECOND):
        total = sum((ord(c) - 48) * w for c, w in zip(base, weights))
        base += "0" if total % 11 < 2 else str(11 - total % 11)
    return base[-2:]


def test_check_digits(spark):
    bases = ["12ABC34501DE", "112223330001", "000000000000", "ZZZZZZZZZZZZ", "short", None]
    got = [r[0] for r in rows(spark, bases, X.check_digits("c"))]
    assert got == [digits_by_hand(b) if b and len(b) == 12 else None for b in bases]


def test_key_reasons(spark):
    good = "12ABC34501DE" + digits_by_hand("12ABC34501DE")
    cases = {good: "ok", good.lower(): "ok", "": "empty", None: "empty", "12": "bad_length", good + "!": "bad_character", "11111111111111": "repeated", good[:12] + "00": "bad_digits", good[:13] + "X": "bad_pattern", good + "\n": "bad_character"}
    assert [r[0] for r in rows(spark, list(cases), X.key_reason("c"))] == list(cases.values())
    assert rows(spark, ["11111111111111"], X.is_valid_key("c", "pattern"), X.is_valid_key("c", "format")) == [(True, False)]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ABCZ0189", min_size=14, max_size=14), min_size=1, max_size=20))
def test_mask_and_back(spark, keys):
    assert [r[0] for r in rows(spark, keys, X.normalize_key(X.mask_key("c")))] == keys


def test_values(spark):
    got = rows(spark, ["20240509", "20240509\n", "x", None], X.guarded_date("c"))
    assert got == [("2024-05-09",), ("20240509\n",), ("x",), ("",)]
    assert rows(spark, ["1.234,56", "-7,5", "abc", None], X.money("c").cast("string")) == [("1234.56",), ("-7.50",), (None,), (None,)]
    assert rows(spark, ["a,,b", "", None], X.split_list("c")) == [(["a", "", "b"],), ([],), ([],)]
    assert rows(spark, ["Sim", "n", None], X.truth("c")) == [(True,), (False,), (False,)]
    assert rows(spark, ["2024-05-09 10:00:00", "junk", None], X.month("c")) == [("2024-05",), (None,), (None,)]
    assert rows(spark, ["1", None], X.json_text(F.col("c"), F.lit(None).cast("string").alias("n"))) == [('{"c":"1","n":null}',), ('{"c":null,"n":null}',)]


def test_inject_key(spark):
    texts = ['{"a":1}', "{}", '"{\\"a\\":\\"é\\"}"', "[1]", "{bad", None]
    got = [r[0] for r in rows(spark, texts, X.inject_key("c", F.lit('k"1')))]
    assert got == ['{"a":1,"cnpj":"k\\"1"}', '{"cnpj":"k\\"1"}', '{"a":"é","cnpj":"k\\"1"}', None, None, None]


def test_parts(spark):
    good, bad = rows(spark, ["12.345.678/0001-90", "12"], X.key_parts("c"))
    assert tuple(good[0]) == ("12345678", "0001", "90", None) and bad[0]["base"] is None and bad[0]["problem"] == "length 2"


def test_sql_functions(spark):
    assert register_sql_functions(spark) == ["clean_key", "normalize_key", "has_key_format", "first_key_digit", "second_key_digit", "is_valid_key", "mask_key"]
    r = spark.sql("SELECT clean_key('a-1/b'), normalize_key('a.b-1'), is_valid_key('12ABC34501DE35'), is_valid_key(null), mask_key('12abc34501de35')").first()
    assert tuple(r) == ("a1b", "AB1", True, False, "12.ABC.345/01DE-35")


def test_label_rejects_unknown_fallback():
    with pytest.raises(KeyError):
        X.label(F.lit("1"), {"1": "x"}, "other")


def test_levels_in_sql(spark):
    from ledgerloom.functions.sql import register_sql_functions

    register_sql_functions(spark)
    keys = ["12ABC34501DE35", "12.ABC.345/01DE-35", "12ABC34501DE36", "11111111111111", "x", None]
    got = spark.createDataFrame([(k,) for k in keys], "c string").selectExpr("has_key_format(c) AS f", "is_valid_key(c) AS v").collect()
    want = rows(spark, keys, F.coalesce(X.is_valid_key("c", "format"), F.lit(False)), F.coalesce(X.is_valid_key("c"), F.lit(False)))
    assert [(r.f, r.v) for r in got] == [tuple(r) for r in want]


def test_key_is_set_once(spark):
    texts = ['{"cnpj":"old","a":1}', '{"a":{"cnpj":2}}', None]
    assert [r[0] for r in rows(spark, texts, X.inject_key("c", F.lit("k"), strict=True))] == ['{"a":1,"cnpj":"k"}', '{"a":{"cnpj":2},"cnpj":"k"}', None]
    with pytest.raises(Exception, match="no JSON object"):
        rows(spark, ["[1]"], X.inject_key("c", F.lit("k"), strict=True))


def test_separators_and_blanks(spark):
    assert rows(spark, ["a|b"], X.split_list("c", "|"))[0][0] == ["a", "b"] and rows(spark, ["a.b"], X.split_list("c", "."))[0][0] == ["a", "b"]
    assert [r[0] for r in rows(spark, [" 12345678000195 "], X.key_reason("c", "pattern"), X.key_reason("c"))][0] == "ok"


def test_inject_key_on_odd_payloads(spark):
    texts = ['{"a":"x"}}', '{"a":1} x', '{"a":1,"a":2}', '{"cnpj":"o","n":1.10,"b":{"cnpj":[1.0,{}],"t":"q\\"u,}"},"e":[]}', '"{\\"a\\":1.50}"', '{ }', '{"cnpj":1}', '"{"', ""]
    got = [r[0] for r in rows(spark, texts, X.inject_key("c", F.lit("k")))]
    assert got == [None, None, None, '{"n":1.10,"b":{"cnpj":[1.0,{}],"t":"q\\"u,}"},"e":[],"cnpj":"k"}', '{"a":1.50,"cnpj":"k"}', '{"cnpj":"k"}', '{"cnpj":"k"}', None, None]
    for bad in ('{"a":"x"}}', '{"a":1,"a":2}', '{"a":'):
        with pytest.raises(Exception, match="no JSON object"):
            rows(spark, [bad], X.inject_key("c", F.lit("k"), strict=True))


def test_white_space_around_keys(spark):
    texts = ["\t12345678000195\n", "\u00a012.345.678/0001-95 ", " \r\n", "1234567800019 5"]
    assert [r[0] for r in rows(spark, texts, X.key_reason("c", "pattern"))] == ["ok", "ok", "empty", "bad_character"]
    assert [r[0] for r in rows(spark, texts, X.normalize_key("c"))][2] == ""
    assert [r[0] for r in rows(spark, texts, X.key_reason("c", "format"))][0] == "bad_character"


def test_pattern_validity_is_small_and_equals_its_reason(spark):
    texts = ["12.345.678/0001-90", " 12345678000190\t", "\u00a012ABC34501DE35\u2003", "12abc34501de35", "12 345678000190", "1234567800019A", "ß2345678000190", "ß234567800019", ".-/", " ", "", None, "1234567800019٣", "12345678000190\n", "\n12345678000190", ". .", "1" * 13, "1" * 15, "12345678000190\x1c"]
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    for r in df.select("raw", X.is_valid_key("raw", "pattern").alias("valid"), X.key_reason("raw", "pattern").alias("reason"), X.trimmed("raw").alias("t"), X.normalize_key("raw").alias("key")).collect():
        assert r.valid == (r.reason == "ok"), r
        assert r.t is None if r.raw is None else r.t == r.raw.strip() or "\x1c" in r.raw
        assert r.key == ("" if not (r.raw or "").strip() else re.sub("[./-]", "", r.raw).upper()) or "\x1c" in (r.raw or "")
    assert str(X.is_valid_key("raw", "pattern")).count("raw") == 2
