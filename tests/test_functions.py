"""Column functions against their Python definitions (FIXTURES 2b, 2c)."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from taxorule.functions import sqltext as q
from taxorule.functions.text import PY_WHITESPACE

ALPHABET = st.sampled_from(list("ab é") + list(PY_WHITESPACE) + ["​", "x"])


def test_whitespace_set_is_python_isspace():
    assert len(PY_WHITESPACE) == 29
    assert all(c.isspace() for c in PY_WHITESPACE)
    assert "\x1c" in PY_WHITESPACE and "　" in PY_WHITESPACE and "​" not in PY_WHITESPACE


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=8), min_size=40, max_size=40))
def test_py_strip_and_split_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.selectExpr(f"{q.strip('t')} AS s", f"{q.split_keywords('t')} AS k").collect()
    for t, r in zip(texts, rows):
        assert r.s == t.strip()
        assert r.k == [k for k in re.split(r"[ \t\n\r\f]+", t) if k.strip() != ""]


def _variant_rows(spark, docs):
    df = spark.createDataFrame([(d,) for d in docs], "j string").select(F.parse_json("j").alias("v"))
    return df


def test_extraction_keywords(spark):
    docs = ['null', '[" a ", null, "", "  ", 3]', '" x "', '""', '5', '["a","a"]']
    got = [r[0] for r in _variant_rows(spark, docs).selectExpr(q.extraction_keywords("v")).collect()]
    assert got == [[], [" a ", "3"], [" x "], [], ["5"], ["a", "a"]]


def test_missing_keywords_column_is_empty(spark):
    df = spark.createDataFrame([('{"a": 1}',)], "j string").select(F.parse_json("j").alias("v"))
    got = df.selectExpr(q.extraction_keywords("try_variant_get(v, '$.keywords', 'variant')")).first()[0]
    assert got == []


def test_class_codes(spark):
    docs = ['null', '[{"system":"S","code":5}, "X"]', '[null]', '{"system":"S"}', '7']
    got = [[tuple(c) for c in r[0]] for r in _variant_rows(spark, docs).selectExpr(q.class_codes("v")).collect()]
    assert got == [[], [("S", "5"), (None, "X")], [(None, None)], [("S", None)], [(None, "7")]]


def test_is_falsy(spark):
    docs = ['0', '0.0', 'false', '""', '[]', '{}', 'null', '"0"', '1', 'true', '" "', '[0]']
    got = [r[0] for r in _variant_rows(spark, docs).selectExpr(q.is_falsy("v")).collect()]
    assert got == [True, True, True, True, True, True, True, False, False, False, False, False]
