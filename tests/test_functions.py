"""Column functions against vectors worked out by hand."""

import random

import pytest
from pyspark.sql import functions as F

from quireflow.functions import coerce, geometry, names, parsing


def values(spark, column, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_to_bool(spark):
    inputs = ["true", "false", "TRUE ", "no", "yes", "", "e", "rue", None]
    assert values(spark, coerce.to_bool, inputs) == [True, False, True, False, False, False, False, False, False]
    assert values(spark, lambda c: coerce.to_bool(c, compat=True), inputs) == [True, False, True, False, False, True, True, True, False]


def test_to_int_and_double(spark):
    inputs = ["123", "123.45", None, "-1.9", "2.9", " 7 ", "", "abc", "inf", "nan", "1e3", "12d"]
    assert values(spark, lambda c: coerce.to_int(c, 999), inputs) == [123, 123, 999, -1, 2, 7, 999, 999, 999, 999, 1000, 999]
    assert values(spark, lambda c: coerce.to_double(c, 9.0), ["123.45", None, " 1e3 ", ""]) == [123.45, 9.0, 1000.0, 9.0]


def test_judge_dialect(spark):
    assert values(spark, coerce.judge_bool, ["True", "1", "yes", "on", "off", " true", None]) == [True, True, True, True, False, False, False]
    assert values(spark, coerce.judge_int, ["2", "2.0", " 2 ", None, "x"]) == [2, None, 2, None, None]
    assert values(spark, coerce.judge_double, ["0.9", "x", None]) == [0.9, None, None]


def test_strip_is_unicode_aware(spark):
    assert values(spark, coerce.strip, ["　a b \n", "\t", None]) == ["a b", "", None]


def test_angles(spark):
    degrees = [0, 45, 46, 135, 136, -45, -46, -135, -136, 180, 270, None]
    assert values(spark, parsing.angle_bucket, degrees, "int") == [0, 0, 90, 90, 180, 0, -90, -90, 180, 180, 180, 0]
    assert values(spark, parsing.angle_of_text, ["90", "右90", "左90", "上下逆", "正常", "90度", "-30deg", "abc"]) == [90, 90, -90, 180, 0, 90, 0, 0]
    bodies = ['{"recommended_angle": null, "rotation_angle": 90}', '{"rotation_angle": 90}', "{}", '{"recommended_angle": true}', '{"recommended_angle": 91.7}']
    assert values(spark, parsing.judged_angle, bodies) == [0, 90, 0, 0, 90]


def test_readability(spark):
    assert values(spark, parsing.readability_rank, ["none", "MINOR", "Major", "odd", None]) == [0, 1, 2, None, None]
    assert values(spark, parsing.readability_name, [0, 1, 2, None], "int") == ["none", "minor", "major", "none"]


FENCE = "```"
ANSWERS = [
    (f'see {FENCE}json\n{{"extracted_text":"x"}}\n{FENCE} ok', True, "x", "ok"),
    ('{"extracted_text":"x"}', True, "x", "ok"),
    (f'{FENCE}\n{{"extracted_text":"x"}}\n{FENCE}', False, "x", "ok"),
    ('well {"extracted_text":"x"} yes', False, "x", "ok"),
    ('{"a":1}', True, '{\n  "a": 1\n}', "no_field"),
    ('{"extracted_text":"x",}', False, '{"extracted_text":"x",}', "not_json"),
    (" hello ", False, "hello", "not_json"),
    (f'{FENCE}json\n{{broken\n{FENCE} {{"extracted_text":"x"}}', False, f'{FENCE}json\n{{broken\n{FENCE} {{"extracted_text":"x"}}', "not_json"),
]


def test_answers(spark):
    df = spark.createDataFrame([(i, a[0]) for i, a in enumerate(ANSWERS)], "i int, response string")
    got = {r.i: r for r in parsing.parse_ocr(df).collect()}
    for i, (_, _, text, note) in enumerate(ANSWERS):
        assert (got[i].extracted_text, got[i].note) == (text, note), i
    judged = values(spark, parsing.judgment_json, [a[0] for a in ANSWERS])
    assert [j is not None for j in judged] == [a[1] for a in ANSWERS]


def test_resolutions(spark):
    df = spark.createDataFrame([(0, 595.0, 842.0), (1, 612.0, 792.0), (2, 10.0, 10.0), (3, 5000.0, 5000.0), (4, 0.0, 10.0)], "i int, w double, h double")
    out = df.orderBy("i").select(geometry.optimal_dpi(F.col("w"), F.col("h")).alias("d"), geometry.output_size(F.col("w"), F.col("h"), F.lit(218)).alias("s")).collect()
    assert [r.d for r in out] == [218, 232, 600, 50, 300]
    assert tuple(out[0].s) == (1801, 2549)
    assert values(spark, geometry.scaled_dpi, [218, 400, None], "int") == [436, 600, 600]
    assert values(spark, geometry.memory_capped_dpi, [300, 1084, 1085, 2000], "int") == [300, 1084, 600, 600]


@pytest.mark.parametrize(
    "height,want",
    [
        (1000, [(0, 220), (180, 420), (380, 620), (580, 820), (780, 1000)]),
        (500, [(0, 110), (90, 210), (190, 310), (290, 410), (390, 500)]),
        (499, [(0, 136), (112, 260), (236, 384), (360, 499)]),
        (420, [(0, 115), (95, 220), (200, 325), (305, 420)]),
        (50, [(0, 50)]),
        (0, [(0, 0)]),
    ],
)
def test_strips(spark, height, want):
    assert [tuple(r) for r in values(spark, geometry.strip_regions, [height], "int")[0]] == want


def test_strips_cover_every_height(spark):
    for (h, regions) in spark.range(1, 1500).select("id", geometry.strip_regions(F.col("id"))).collect():
        assert regions[0][0] == 0 and regions[-1][1] == h
        assert all(a[1] >= b[0] for a, b in zip(regions, regions[1:]))


def test_spreads(spark):
    got = values(spark, geometry.spread_regions, [1000, 1001, 7], "int")
    assert [[tuple(r)[1:] for r in x] for x in got] == [[(0, 550), (450, 1000)], [(0, 550), (450, 1001)], [(0, 3), (3, 7)]]


def test_names(spark):
    df = spark.createDataFrame([("/a_rot.d/scan.v1.PDF", 1000, 9)], "p string, n int, k int")
    row = df.select(names.stem(F.col("p")), names.page_image_name(F.col("p"), F.col("n")), names.group_key(F.col("n"), F.col("k")), names.with_suffix(F.col("p")), names.media_type(F.col("p"))).first()
    assert tuple(row) == ("scan.v1", "scan.v1_page_1000.jpg", "page_1000_mask10", "/a_rot.d/scan.v1_rot.jpg", "application/pdf")


def test_means_round_by_their_exact_value(spark):
    rng = random.Random(7)
    inputs = [k / 2000 for k in range(-3000, 3001)] + [rng.uniform(-5, 5) for _ in range(3000)] + [(2 * k + 1) / 2**n for n in range(1, 14) for k in range(40)]
    inputs += [rng.uniform(-1, 1) * 10.0**e for e in range(-12, 12) for _ in range(10)] + [0.0, 1e300, -1e300, 5e-324, 2.0**52 + 0.5, None]
    got = values(spark, coerce.round_mean, inputs, "double")
    assert [x for x, y in zip(inputs, got, strict=True) if (None if x is None else round(x, 3)) != y] == []
    assert values(spark, lambda c: coerce.round_mean(c, 1), inputs, "double") == [None if x is None else round(x, 1) for x in inputs]
    odd = values(spark, coerce.round_mean, [float("inf"), float("-inf"), float("nan")], "double")
    assert odd[:2] == [float("inf"), float("-inf")] and odd[2] != odd[2]
