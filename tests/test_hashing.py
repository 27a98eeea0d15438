import hashlib

from pyspark.sql import functions as F, types as T

from tablecheck.functions import key_json, normalise_keys, restore_binary_keys, row_hash

# A known row and its hash.
GOLDEN_ROW = (2, "Chaim", "Batcheldor", "cbatcheldor1@businessweek.com", "Agender", "2024-06-29")
GOLDEN_SCHEMA = "id int, first_name string, last_name string, email string, gender string, timestamp string"
GOLDEN_HASH = "0532b97c35b3a7fe894558d615602c21dc99b50ce4152bfcd42b493f9405543e"


def hashes(df, columns, **options):
    return [r[0] for r in df.select(row_hash(df.schema, columns, **options)).collect()]


def test_golden_hash_and_key(spark):
    df = spark.createDataFrame([GOLDEN_ROW], GOLDEN_SCHEMA)
    assert hashes(df, df.columns[1:]) == [GOLDEN_HASH]
    assert df.select(key_json(["id"])).first()[0] == '{"id":2}'


def test_golden_hash_with_a_real_date(spark):
    df = spark.createDataFrame([GOLDEN_ROW], GOLDEN_SCHEMA)
    df = df.withColumn("timestamp", F.to_date("timestamp"))
    assert hashes(df, df.columns[1:]) == [GOLDEN_HASH]


def test_null_equals_its_marker_only_in_compat_mode(spark):
    df = spark.createDataFrame([(None,), ("NULL",)], "a string")
    assert len(set(hashes(df, ["a"]))) == 1
    assert len(set(hashes(df, ["a"], mode="strict"))) == 2
    assert len(set(hashes(df, ["a"], algo="xxhash64"))) == 2


def test_separator_in_a_value_collides_only_in_compat_mode(spark):
    df = spark.createDataFrame([("a||b", "c"), ("a", "b||c")], "a string, b string")
    assert len(set(hashes(df, ["a", "b"]))) == 1
    assert len(set(hashes(df, ["a", "b"], mode="strict"))) == 2


def test_no_columns_hash_the_empty_text(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert hashes(df, []) == [hashlib.sha256(b"").hexdigest()]


def test_fast_hash_tells_where_a_null_stands(spark):
    df = spark.createDataFrame([(None, 1), (1, None)], "a int, b int")
    assert len(set(hashes(df, ["a", "b"], algo="xxhash64"))) == 2


def test_fast_hash_tells_the_zeros_apart_as_the_text_does(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (None,)], "a double")
    assert len(set(hashes(df, ["a"]))) == 3
    assert len(set(hashes(df, ["a"], algo="xxhash64"))) == 3


def test_map_order_does_not_matter(spark):
    schema = "a map<string,int>, b struct<x: int, m: map<string,int>>, c array<map<string,int>>"
    one, two = {"k": 1, "l": 2}, {"l": 2, "k": 1}
    df = spark.createDataFrame([(one, (1, one), [one]), (two, (1, two), [two])], schema)
    assert len(set(hashes(df, df.columns))) == 1
    assert len(set(hashes(df, df.columns, algo="xxhash64"))) == 1


def test_nested_and_binary_values(spark):
    df = spark.createDataFrame(
        [([1, None], bytearray(b"\x01\xff"), True)], "a array<int>, b binary, c boolean"
    )
    expected = hashlib.sha256(b"[1,null]||01FF||true").hexdigest()
    assert hashes(df, ["a", "b", "c"]) == [expected]


def test_long_values_count_to_their_end(spark):
    df = spark.createDataFrame([("x" * 5000 + "1",), ("x" * 5000 + "2",)], "a string")
    assert len(set(hashes(df, ["a"]))) == 2


def test_fast_hash_sees_nulls_at_every_depth(spark):
    df = spark.createDataFrame([((None, 1),), ((1, None),)], "s struct<a:int,b:int>")
    assert len(set(hashes(df, ["s"], algo="xxhash64"))) == 2
    df = spark.createDataFrame([([1, None],), ([None, 1],)], "s array<int>")
    assert len(set(hashes(df, ["s"], algo="xxhash64"))) == 2


def test_microseconds_inside_arrays(spark):
    df = spark.sql("select array(timestamp'2024-01-01 00:00:00.123456') a union all select array(timestamp'2024-01-01 00:00:00.123999')")
    assert len(set(hashes(df, ["a"]))) == 2


def test_names_with_blanks_dots_and_quotes(spark):
    schema = T.StructType(
        [T.StructField(n, T.StringType()) for n in ("a b", "c.d", "e`f", "it's", "back\\slash")]
    )
    df = spark.createDataFrame([("1", "2", "3", "4", "5")], schema)
    assert hashes(df, df.columns) == [hashlib.sha256(b"1||2||3||4||5").hexdigest()]
    assert df.select(key_json(["c.d", "e`f"])).first()[0] == '{"c.d":"2","e`f":"3"}'


def test_key_json_keeps_nulls_and_types(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    assert df.select(key_json(["a", "b", "c"])).first()[0] == '{"a":1,"b":null,"c":"x"}'


def test_key_normalisation(spark):
    df = spark.createDataFrame([("ab  ", bytearray(b"\x0a"), 1)], "t string, b binary, n int")
    row = normalise_keys(df, ["t", "b", "n"]).first()
    assert tuple(row) == ("ab", "0A", 1)
    padded = normalise_keys(df, ["t"], {"t": 5}).first()["t"]
    assert padded == "ab   "
    assert normalise_keys(df, ["t"], {"t": 1}).first()["t"] == "ab"
    back = restore_binary_keys(normalise_keys(df, ["b"]), ["b"])
    assert bytes(back.first()["b"]) == b"\x0a"
