import hashlib
import struct

from pyspark.sql import functions as F

from evenkeel.functions.canonical import fingerprints, row_hash
from evenkeel.functions import scalars
from evenkeel.plans.table_plan import Column, TablePlan


def expected(*values):
    """The row format in plain Python: (type, text or None, large)."""
    out = b"\x52" + struct.pack(">I", len(values))
    for kind, value, large in values:
        out += b"\x46" + struct.pack(">I", len(kind)) + kind.encode()
        if value is None:
            out += b"\x00"
        elif large:
            out += b"\x01" + struct.pack(">Q", len(value.encode())) + hashlib.sha256(value.encode()).digest()
        else:
            out += b"\x01" + struct.pack(">I", len(value.encode())) + value.encode()
    return hashlib.sha256(out + b"\x45").hexdigest()


def hashes(spark, sql, kind, large=False):
    return [r[0] for r in spark.sql(sql).select(row_hash([Column("v", kind, large=large)])).collect()]


def test_row_hash_of_all_types(spark):
    cases = [
        ("cast(7 as bigint)", "bigint", "7"), ("true", "boolean", "true"), ("cast(1234.56 as decimal(18,4))", "numeric(18,4)", "1234.5600"),
        ("'Zoë \\U0001F600'", "text", "Zoë \U0001F600"), ("date'2024-02-29'", "date", "2024-02-29"), ("X'00FF'", "bytea", "00ff"),
        ("timestamp_ntz'2024-01-02 03:04:05.000006'", "timestamp without time zone", "2024-01-02T03:04:05.000006"),
        ("array('A','b')", "uuid[]", "uuid-array-v1:2:a,b"), ("cast(null as string)", "text", None),
    ]
    for sql, kind, text in cases:
        assert hashes(spark, f"select {sql} as v", kind) == [expected((kind, text, False))], kind


def test_large_values_go_by_length_and_digest(spark):
    assert hashes(spark, "select 'abc' as v", "text", True) == [expected(("text", "abc", True))]


def test_what_must_differ_differs(spark):
    seen = hashes(spark, "select * from values ('<NULL>'), (null), ('é'), ('e\\u0301'), ('1'), ('') t(v)", "text")
    seen += hashes(spark, "select 1 as v", "integer")
    assert len(set(seen)) == 7
    arrays = "select * from values (array()), (array('a')), (array('b')), (array('a','b')), (array('b','a')), (array('a','c')), (array('a','b','b')), (null) t(v)"
    assert len(set(hashes(spark, arrays, "uuid[]"))) == 8


def test_key_hash_covers_the_key_alone(spark):
    plan = TablePlan("t", (Column("a", "integer"), Column("b", "text"), Column("c", "text")), ("a", "b"))
    rows = fingerprints(spark.sql("select 1 as a, 'x' as b, 'y' as c"), plan).collect()
    assert rows[0]["key_sha256"] == expected(("integer", "1", False), ("text", "x", False))


def test_ticks_and_times(spark):
    text = "2024-01-02T03:04:05.1234567"
    row = spark.createDataFrame([(text, None, "bad")], "a string, b string, c string").select(
        *[scalars.to_micros(F.col(c)).cast("string").alias(f"t{c}") for c in "abc"], *[scalars.tick(F.col(c)).alias(f"n{c}") for c in "abc"]
    ).first()
    assert tuple(row) == ("2024-01-02 03:04:05.123456", None, None, 7, None, None)
    utc = spark.sql("select '2024-01-02T17:45:12.1234567+07:00' as a").select(scalars.offset_to_utc(F.col("a")).cast("string")).first()[0]
    assert utc == "2024-01-02 10:45:12.123456"


def test_staged_decimals(spark):
    assert scalars.product_type((18, 4), (10, 0)) == (29, 4)
    assert scalars.quotient_type((29, 2), (10, 0)) == (38, 11)
    one = spark.sql("select cast(31 as decimal(10,2)) as p, cast(4 as decimal(6,2)) as q, cast(25 as decimal(5,2)) as d")
    args = (F.col("p"), (10, 2), F.col("q"), (6, 2), F.col("d"), (5, 2), (18, 2))
    assert str(one.select(scalars.discounted_subtotal(*args)).first()[0]) == "93.00"


def test_names_json_and_expressions(spark):
    one = spark.sql("select cast(null as string) as a, 'Doe' as b, '{\"b\": [2, 1], \"a\": {\"d\": 1, \"c\": null}}' as j, ' ( a  +  b ) ' as e, '(a) + (b)' as f")
    row = one.select(scalars.full_name(F.col("a"), F.col("b")), scalars.sorted_json(F.col("j")), scalars.normal_expression(F.col("e")), scalars.normal_expression(F.col("f"))).first()
    assert tuple(row) == ("Doe", '{"a":{"c":null,"d":1},"b":[2,1]}', "a + b", "(a) + (b)")


def test_lengths_of_short_and_long_texts(spark):
    sizes = [0, 1, 126, 127, 128, 255, 256, 70_000]
    rows = spark.createDataFrame([(n, "x" * n) for n in sizes] + [(-1, None)], "n int, v string")
    got = {r["n"]: r["h"] for r in rows.select("n", row_hash([Column("v", "text")]).alias("h")).collect()}
    head = bytes.fromhex("5200000001") + bytes.fromhex("4600000004") + b"text"
    want = {n: hashlib.sha256(head + b"\x01" + n.to_bytes(4, "big") + b"x" * n + b"\x45").hexdigest() for n in sizes}
    assert got == want | {-1: hashlib.sha256(head + b"\x00\x45").hexdigest()}
