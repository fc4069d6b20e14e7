from pyspark.sql import functions as F

from lexispark.functions import jsonfn
from lexispark.functions.text import clean, java_split, vocab_word


def one(spark, rows, expr, schema="v string"):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_string_accessor(spark):
    assert one(spark, ['"new text"'], jsonfn.string_field(jsonfn.parse("v"))) == ["new text"]
    assert one(spark, ['{"body":"body text","other":5,"test":"other text"}'], jsonfn.body("v")) == ["body text"]
    got = one(spark, ['{"body":5}', '{"body":null}', "{}", "[1]"], jsonfn.body("v"))
    assert got == ["", "", "", ""]


def test_int_accessor(spark):
    got = one(spark, ['{"k":5}', '{"k":5.0}', '{"k":"5"}', "{}", '{"k":99999999999}'],
              jsonfn.int_field(jsonfn.parse("v"), "k"))
    assert got == [5, 0, 0, 0, 0]


def test_error_rows(spark):
    got = one(spark, ["{bad", '{"a":1}'], jsonfn.error_of("v"))
    assert got == [jsonfn.PARSE_ERROR, None]


def test_clean(spark):
    assert one(spark, ["a<b>c</b> d"], clean("v")) == ["a c  d"]
    assert one(spark, ["xéy\nz"], clean("v")) == ["x y z"]


def test_merge_fields(spark):
    df = spark.createDataFrame([('{"tokens":"old","b":1}', "new")], "v string, tokens string")
    m = df.select(jsonfn.merge_fields("v", ["tokens"]).alias("m")).first()["m"]
    p = spark.createDataFrame([(m,)], "m string").select(
        jsonfn.string_field(jsonfn.parse("m"), "tokens").alias("t"),
        jsonfn.int_field(jsonfn.parse("m"), "b").alias("b")).first()
    assert (p["t"], p["b"]) == ("new", 1)


def test_java_split(spark):
    got = one(spark, ["a  b  ", "", "  ", " a"], java_split("v"))
    assert got == [["a", "", "b"], [""], [], ["", "a"]]


def test_vocab_word(spark):
    assert one(spark, ["Alpha Corp."], vocab_word("v")) == ["alpha_corp."]
