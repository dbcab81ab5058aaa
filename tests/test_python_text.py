"""``as_text`` is Python's str() of what json.loads gives."""

import json
import random

from taxorule.functions import sqltext as q

TEXTS = ["", "a", "it's", 'say "x"', "both ' and \"", "back\\slash", "tab\t nl\n cr\r", "\x00\x1f\x7f\x85", "é€😀", "​  　",
         "퟿", "\U000e0001"]


def check(spark, texts, form=q.as_text):
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    got = q.run(spark, f"SELECT j, {form('v')} AS s FROM (SELECT j, parse_json(j) AS v FROM {{d}})", d=df).collect()
    assert len(got) == len(texts)
    for r in got:
        value = json.loads(r.j)
        assert r.s == (None if value is None else str(value)), r.j


def test_scalars(spark):
    check(spark, ["true", "false", "null", "0", "-7", "1.0", "1.50", "100000.0", "1e16", "1E5", "1e-5", "0.0001", "0.00012345", "-1.5e-7",
                  "123456789.125", "9007199254740993.0", "1e15", "1234567890123456.0", "12345678901234567.0", "1e22", "1.7976931348623157e308",
                  "1e400", "-1e400", "12345678901234567890", "0.1", "1e7", "12345678.9", "9999999.0"] + [json.dumps(t) for t in TEXTS])


def test_random_floats(spark):
    rng = random.Random(1)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-20, 25) for _ in range(300)]
    texts = [repr(v) for v in values]
    # Java may print one digit more than the shortest; such values are left out here
    df = spark.createDataFrame([(v,) for v in values], "d double")
    java = {r.d for r in df.selectExpr("d", "cast(d AS string) AS s").collect()
            if len(r.s.replace("-", "").split("E")[0].replace(".", "").strip("0")) <= len(repr(r.d).replace("-", "").split("e")[0].replace(".", "").strip("0"))}
    kept = [t for t, v in zip(texts, values) if v in java]
    assert len(kept) > 250
    check(spark, kept)


def test_containers(spark):
    # whole floats in containers lose their point in VARIANT
    values = [[], {}, [1, "a", None, True, 1.5, 1e-7, 2e30], {"a": 1.25, "b": "x"}, [[1], [[]], {"k": [None]}], {"it's": ["\n", {"z": False}]}]
    check(spark, [json.dumps(v) for v in values] + [json.dumps(TEXTS), json.dumps({t: t for t in sorted(TEXTS)}), "true", "1.0"],
          q.python_text)
