"""CSV/Parquet/table scans and sinks on hand-made files."""

import os

import pytest
from pyspark.sql import functions as F

from starlane.plans.star import land_if_absent
from starlane.sinks.files import (
    csv_line,
    declared_schema,
    enforce_schema,
    ensure_database,
    read_csv,
    write_csv,
    write_table,
)


def write_text(root, name, text):
    p = os.path.join(root, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_quoted_comma_and_doubled_quotes(spark, tmp_root):
    p = write_text(tmp_root, "a.csv", 'id,loc\n"""CNR1""","Gate 3, East"\n')
    rows = read_csv(spark, p, schema="id string, loc string").collect()
    assert [tuple(r) for r in rows] == [('"CNR1"', "Gate 3, East")]


def test_quoted_newline_needs_multiline(spark, tmp_root):
    p = write_text(tmp_root, "b.csv", 'id,loc\n1,"a\nb"\n2,c\n')
    rows = read_csv(spark, p, schema="id string, loc string", multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("1", "a\nb"), ("2", "c")]


def test_ragged_rows_are_kept_and_flagged(spark, tmp_root):
    p = write_text(tmp_root, "c.csv", "a,b,c\n1,2\n1,2,3,4\n1,2,3\n")
    df = read_csv(spark, p, schema="a string, b string, c string", corrupt_column="_bad")
    rows = sorted([tuple(r) for r in df.collect()], key=lambda r: (r[2] or "", r[3] or ""))
    assert len(rows) == 3
    short = [r for r in rows if r[2] is None][0]
    assert short[:3] == ("1", "2", None) and short[3] is not None
    long_ = [r for r in rows if r[3] == "1,2,3,4"][0]
    assert long_[:3] == ("1", "2", "3")
    good = [r for r in rows if r[3] is None][0]
    assert good == ("1", "2", "3", None)


def test_a_schema_with_other_names_or_order_stops_the_scan(spark, tmp_root):
    p = write_text(tmp_root, "o.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, p, schema="a string, b string").collect()


def test_csv_by_name(spark, tmp_root):
    from starlane.sinks.files import read_csv_by_name

    one = write_text(tmp_root, "n1.csv", 'a,b\n1,"x\ty"\n')
    two = write_text(tmp_root, "n2.csv", "c,b,a\n9,y\r,2\n")
    got = read_csv_by_name(spark, [one, two], ["a", "b", "d"], ["a"])
    assert sorted(tuple(r) for r in got.collect()) == [("1", "x\ty", None), ("2", "y\r", None)]
    with pytest.raises(ValueError, match="n1.csv.*'c'"):
        read_csv_by_name(spark, [one, two], ["a"], ["c"])


def test_inferred_scan(spark, tmp_root):
    p = write_text(tmp_root, "d.csv", "n,x\n1,2.5\n2,\n")
    df = read_csv(spark, p)
    assert dict(df.dtypes) == {"n": "int", "x": "double"}


def test_csv_sink_roundtrip_keeps_spaces_and_nulls(spark, tmp_root):
    df = spark.createDataFrame([(" a ", None, 'q"x'), ("b", "c", "d,e")], "p string, q string, r string")
    out = os.path.join(tmp_root, "out")
    assert write_csv(df, out, columns=["r", "p", "q"]) == 2
    back = read_csv(spark, out, schema="r string, p string, q string")
    assert sorted(tuple(r) for r in back.collect()) == sorted([('q"x', " a ", None), ("d,e", "b", "c")])


def test_csv_sink_skips_empty(spark, tmp_root):
    out = os.path.join(tmp_root, "empty")
    df = spark.createDataFrame([], "a string")
    assert write_csv(df, out, skip_empty=True) == 0
    assert not os.path.exists(out)


def test_csv_line_renders_null_as_empty(spark):
    df = spark.createDataFrame([("a", None, 1)], "x string, y string, z int")
    assert csv_line(df, ["x", "y", "z"]).first()[0] == "a,,1"


def test_enforce_schema(spark):
    df = spark.createDataFrame([("1", "x", "2.5"), ("bad", "y", "")], "a string, b string, c string")
    st = declared_schema("a:INT, c:DOUBLE, b:STRING")
    out = enforce_schema(df, st)
    assert out.columns == ["a", "c", "b"]
    assert [tuple(r) for r in out.collect()] == [(1, 2.5, "x"), (None, None, "y")]
    from starlane.sinks.files import lost_values

    assert df.agg(lost_values(df, st)).first()[0] == 2  # 'bad' and the empty text
    with pytest.raises(ValueError, match="missing"):
        enforce_schema(df, declared_schema("a:INT, z:INT"))


def test_land_if_absent(spark, tmp_root):
    df = spark.range(3)
    target = os.path.join(tmp_root, "raw")
    assert land_if_absent(df, target) is True
    assert land_if_absent(spark.range(10), target) is False
    assert spark.read.parquet(target).count() == 3
    assert land_if_absent(spark.range(10), target, force=True) is True
    assert spark.read.parquet(target).count() == 10


def test_table_overwrite_and_append(spark, tmp_root):
    db = "starlane_test_tables"
    ensure_database(spark, db, os.path.join(tmp_root, "wh"))
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    t = f"{db}.t1"
    write_table(df, t, "overwrite", "k bigint, v string")
    assert write_table(df, t, "overwrite", "k bigint, v string") == {"rows": 2, "lost_values": 0}
    assert spark.table(t).count() == 2
    write_table(df, t, "append")
    assert spark.table(t).count() == 4
    with pytest.raises(ValueError):
        write_table(df.withColumn("extra", F.lit(1)), t, "append")


def test_parquet_glob_view(spark, tmp_root):
    out = os.path.join(tmp_root, "zone")
    spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string").write.parquet(out)
    spark.sql(f"CREATE OR REPLACE TEMP VIEW vw_t AS SELECT DISTINCT * FROM parquet.`{out}/*.parquet`")
    assert sorted(tuple(r) for r in spark.table("vw_t").collect()) == [(1, "a"), (2, "b")]


def test_parse_lines_from_text(spark, tmp_root):
    from starlane.sinks.files import parse_lines

    p = write_text(tmp_root, "lines.csv", 'a,b\n1,"x, y"\n2\n')
    lines = spark.read.text(p)
    df = parse_lines(lines, "a string, b string", header_line="a,b")
    assert sorted(tuple(r) for r in df.collect()) == [("1", "x, y"), ("2", None)]


def test_headerless_single_file_csv(spark, tmp_root):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "k int, v string").repartition(4)
    out = os.path.join(tmp_root, "one")
    assert write_csv(df, out, header=False, single_file=True) == 20
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) == 1
    lines = open(os.path.join(out, files[0])).read().splitlines()
    assert len(lines) == 20 and "k,v" not in lines


def test_single_file_parquet_overwrite(spark, tmp_root):
    from starlane.sinks.files import write_parquet

    out = os.path.join(tmp_root, "pq")
    write_parquet(spark.range(50).repartition(5), out, single_file=True)
    write_parquet(spark.range(7).repartition(3), out, single_file=True)  # overwrite
    assert len([f for f in os.listdir(out) if f.endswith(".parquet")]) == 1
    assert spark.read.parquet(out).count() == 7
