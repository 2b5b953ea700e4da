import json

import pytest
from pyspark.sql import functions as F

from sluiceway.functions import aggregates as agg, columns as fn


def values(spark, texts, expression):
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, x STRING")
    return [row[0] for row in df.select("i", expression.alias("y")).orderBy("i").select("y").collect()]


def test_iso_timestamps(spark):
    texts = [
        "2026-03-12T06:00:00Z",
        "2026-03-12T06:00:00+00:00",
        "2026-03-12T08:00:00.250000+02:00",
        "2026-03-12",
        "2026-03-12 06:00:00",
        " 2026-03-12T06:00:00Z",
        "12:00",
        "soon",
        "",
        None,
    ]
    found = values(spark, texts, fn.try_iso_to_ts("x").cast("string"))
    assert found == [
        "2026-03-12 06:00:00",
        "2026-03-12 06:00:00",
        "2026-03-12 06:00:00.25",
        "2026-03-12 00:00:00",
        *[None] * 6,
    ]


def test_wall_clock_keeps_the_written_hour(spark):
    found = values(
        spark, ["2026-03-12T08:00:00+02:00"], fn.try_iso_to_ts("x", wall_clock=True).cast("string")
    )
    assert found == ["2026-03-12 08:00:00"]


def test_strict_parsing_raises_on_bad_text_but_not_on_null(spark):
    assert values(spark, [None], fn.iso_to_ts("x")) == [None]
    with pytest.raises(Exception, match="not an ISO 8601 timestamp: soon"):
        values(spark, ["soon"], fn.iso_to_date("x"))


def test_only_full_dates_cast(spark):
    texts = ["2026-03-12", "2026-03", "2026", "2026-03-12T00:00:00", "2026-02-30", None]
    found = values(spark, texts, fn.try_cast_date("x").cast("string"))
    assert found == ["2026-03-12", None, None, None, None, None]


def test_label_count(spark):
    texts = ['["a","b"]', "[]", "not json", "null", '{"a":1}', None, '[{"a":[1,2]}]']
    assert values(spark, texts, fn.json_label_count("x")) == [2, 0, 0, 0, 0, 0, 1]


def test_null_rules(spark):
    row = spark.range(1).select(
        fn.int_flag_to_bool(F.lit(None).cast("bigint")),
        fn.in_list_ci(F.lit(None).cast("string"), ["high"]),
        fn.in_list_ci(F.lit("HIGH"), ["high"]),
        fn.below_bands(F.lit(None).cast("double"), [(25, "micro")], "large"),
        fn.count_to_flag(F.lit(None).cast("int")),
        fn.concat_key(F.lit("a"), F.lit(None).cast("string")),
        fn.concat_key(F.lit("a"), F.lit(3)),
    ).first()
    assert tuple(row) == (False, False, True, "large", False, None, "a:3")


def test_bands(spark):
    bands = [(25, "micro"), (100, "small"), (250, "medium")]
    df = spark.createDataFrame([(v,) for v in (24.99, 25.0, 99.9, 100.0, 249.0, 250.0)], "v DOUBLE")
    found = [row[0] for row in df.select(fn.below_bands("v", bands, "large")).collect()]
    assert found == ["micro", "small", "small", "medium", "medium", "large"]


def test_file_name(spark):
    texts = ["a/b/location_1.csv", "a/b/location_1.txt", "x.csv", None]
    assert values(spark, texts, fn.file_name_from_key("x")) == ["location_1.csv", None, "x.csv", None]


@pytest.mark.parametrize(
    "document",
    [
        {"b": [1, {"z": 'a,b:"c', "a": None}], "a": "x: y, z\\"},
        [],
        {},
        ["a,b", {"k": True}],
        [[1, 2], [3]],
        {"": {"": [""]}},
        {"é": ["ß, \u4e2d: \U0001f600", "plain"]},
    ],
)
def test_nested_values_match_sorted_json(spark, document):
    (found,) = values(spark, [json.dumps(document)], fn.nested_to_json(F.parse_json("x")))
    assert found == json.dumps(document, sort_keys=True)


def test_long_nested_value(spark):
    document = {"k": [f'item, "{i}": x' for i in range(20000)]}
    (found,) = values(spark, [json.dumps(document)], fn.nested_to_json(F.parse_json("x")))
    assert found == json.dumps(document, sort_keys=True)


NUMBERS = """1.0 1e3 -0.0 -0 0 0.1 1.10 100 1e-4 1e-5 1.5E-7 12345678.25 1e15 1e16 123456789012345.6
1.5e20 1E400 -1e400 9007199254740993 123456789012345678901234567890123456789012345678901234567890
-17 0.00012345678901234567 1.7976931348623157e308 1e22 9999999999999998.0 3.0E+2""".split()


def test_numbers_match_sorted_json(spark):
    texts = [f'{{"b": {number}, "a": [{number},"{number}"]}}' for number in NUMBERS]
    found = values(spark, texts, fn.nested_text_to_json("x"))
    assert found == [json.dumps(json.loads(text), sort_keys=True) for text in texts]


@pytest.mark.parametrize(
    "text",
    [
        r'{"n1": "n2", "s": ["s", "nn", "", "\"n3\"", "\\"], "\"s": -1.0}',
        r'[1,-2.50,true,null,"é 1.0 \ud83d\ude00", {"z": 1e2, "B": 2, "a b": 3}]',
        "[]",
        "{}",
        '[[0.5],[{"é": 1}],"x, y: 1.0"]',
        " { \n \"a\" : 1.0 , \"b\" : [ ] } ",
    ],
)
def test_nested_text_matches_sorted_json(spark, text):
    (found,) = values(spark, [text], fn.nested_text_to_json("x"))
    assert found == json.dumps(json.loads(text), sort_keys=True)


def test_long_nested_text(spark):
    document = {"k": [f'item, "{i}": x' for i in range(20000)], "n": [i / 8 for i in range(20000)]}
    document["q"] = '"' * 50000
    (found,) = values(spark, [json.dumps(document)], fn.nested_text_to_json("x"))
    assert found == json.dumps(document, sort_keys=True)


def test_scalar_text_stays_plain(spark):
    texts = ['"[1]"', "3", '"a"', '"3"', "1e2", "true", "null", None, '"n1"', '""']
    found = values(spark, texts, fn.nested_text_to_json("x"))
    assert found == ["[1]", "3", "a", "3", "100.0", "true", None, None, "n1", ""]


def test_scalars_stay_plain(spark):
    assert values(spark, ['"[1]"', "3", '"a"'], fn.nested_to_json(F.parse_json("x"))) == ["[1]", "3", "a"]


def test_aggregates_over_no_match_and_zero_rows(spark):
    df = spark.createDataFrame([(None, 2.0), (False, 3.0)], "flag BOOLEAN, v DOUBLE")
    row = df.agg(
        agg.conditional_count(F.col("flag")),
        agg.conditional_sum(F.col("flag"), "v"),
        agg.conditional_avg(F.col("flag"), "v"),
        agg.safe_ratio(F.lit(1), F.lit(0)),
    ).first()
    assert tuple(row) == (0, 0.0, None, None)


def test_nested_text_is_parsed_once(spark):
    """Lambda functions share no work by themselves: what they use often is bound to a name."""
    df = spark.createDataFrame([('{"a": [1.50, "é"]}',)], "x STRING")
    plan = df.select(fn.nested_text_to_json("x").alias("y"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("parse_json(") == 1 and plan.count("to_json(") == 1


@pytest.mark.parametrize(
    "text",
    ['["\\u001f\\u007f/"]', "[5e-324, 2e-323]", '{"\\ue000": 1, "\\ud83d\\ude00": 2}', '["\\ud800"]'],
)
def test_rare_nested_text_matches_sorted_json(spark, text):
    (found,) = values(spark, [text], fn.nested_text_to_json("x"))
    assert found == json.dumps(json.loads(text), sort_keys=True)


def test_numbers_may_begin_with_zeros_and_text_may_follow(spark):
    texts = ['{"z": [007, -00.50, "é 01"], "a": 1}', "01", "-007", '[1] "x"', "1 2", ' "a" ']
    found = values(spark, texts, fn.nested_text_to_json("x"))
    assert found == ['{"a": 1, "z": [007, -0.5, "\\u00e9 01"]}', "01", "-007", "[1]", "1", "a"]


@pytest.mark.parametrize("text", ["", " ", "[1,]", "[NaN]", "nul", "[1.2.3]", '{"a": 1, "a": 1}', '[{"a": 01, "a": 1}]'])
def test_what_is_no_json_fails(spark, text):
    with pytest.raises(Exception):
        values(spark, [text], fn.nested_text_to_json("x"))


def test_nested_text_has_no_lambda_for_each_character_or_number(spark):
    df = spark.createDataFrame([('{"a": [1.50, "é"]}',)], "x STRING")
    plan = df.select(fn.nested_text_to_json("x").alias("y"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("transform(") == 1 and "regexp_replace(" not in plan
