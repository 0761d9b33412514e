"""Exactly-once appends, quarantine, file inventory, content ledger, compaction."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from starlane.plans import queries
from starlane.plans.star import compact_small_files, file_sizes
from starlane.schema import CLEANED_SCHEMA
from starlane.sinks import files as sinks
from starlane.sources.inventory import ContentLedger, file_inventory, files_by_header


def write_text(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


@pytest.fixture()
def db(spark, tmp_root):
    name = "once_" + os.path.basename(tmp_root).replace("-", "_")
    sinks.ensure_database(spark, name, os.path.join(tmp_root, "warehouse"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_append_once(spark, db):
    table = f"{db}.t"
    rows = lambda *r: spark.createDataFrame(list(r), "id int, v string")
    assert sinks.append_once(rows((1, "a"), (1, "a")), table, "w1") == {"rows": 2, "lost_values": 0}
    sinks.append_once(rows((2, "b")), table, "it's\\2")
    sinks.append_once(rows((1, "a"), (1, "a")), table, "w1")            # a replay
    sinks.append_once(rows((2, "b")), table, "it's\\2")
    got = lambda: sorted(tuple(r) for r in spark.table(table).collect())
    assert got() == [(1, "a", "w1"), (1, "a", "w1"), (2, "b", "it's\\2")]
    sinks.append_once(rows((3, None)), table, "w1")                     # the id again with other rows
    assert got() == [(2, "b", "it's\\2"), (3, None, "w1")]
    bad = rows((9, "x")).select(F.raise_error(F.lit("lost")).cast("int").alias("id"), "v")
    with pytest.raises(Exception, match="lost"):                        # breaks off: the table stays as it was
        sinks.append_once(bad, table, "w1")
    assert got() == [(2, "b", "it's\\2"), (3, None, "w1")]
    with pytest.raises(ValueError, match="differs"):
        sinks.append_once(spark.range(1), table, "w3")
    text = spark.createDataFrame([("4", "d"), ("x", "e")], "id string, v string")
    assert sinks.append_once(text, table, "w4", "id int, v string") == {"rows": 2, "lost_values": 1}


def test_an_append_reads_its_own_rows_alone(spark, monkeypatch):
    feed = spark.createDataFrame([(f"b{d}", d) for d in (20240101, 20240102, 20240103, None, 20240102)],
                                 "booking_id string, date_id int")
    columns = [F.col(f.name) if f.name in feed.columns else F.lit(None).cast(f.dataType).alias(f.name)
               for f in CLEANED_SCHEMA.fields]
    monkeypatch.setattr(queries, "_cleaned", lambda *_: feed.select(*columns))
    plans, append = [], sinks.append_once

    def seen(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return append(df, *args)

    monkeypatch.setattr(sinks, "append_once", seen)
    got = queries.append_exactly_once(spark, "").collect()
    assert sorted(r.booking_id for r in got) == ["b20240101", "b20240102", "b20240102", "b20240103", "bNone"]
    assert len(plans) == 6 and all("PartitionFilters: [isnotnull(rest" in p for p in plans)


def test_quarantine(spark, tmp_root):
    rows = [("1", "2.5", "a"), ("x", "nan?", None), (None, "1e20", "c"), ("7", None, "d"), ("1", "2.5", "a")]
    df = spark.createDataFrame(rows, "id string, amount string, `odd name` string")
    done = sinks.write_checked(df, os.path.join(tmp_root, "q"), "id int, amount decimal(5,2)", required=["id"])
    assert (done.rows, done.rejected_rows) == (5, 2)
    assert sorted(tuple(r) for r in done.kept.select("id", F.col("amount").cast("string")).collect()) == \
        [(1, "2.50"), (1, "2.50"), (7, None)] or done.kept.count() == 3
    bad = {r.source: r.reasons for r in done.rejected.collect()}
    assert bad == {'{"id":"x","amount":"nan?"}': ["id: not int", "amount: not decimal(5,2)"],
                   '{"amount":"1e20","odd name":"c"}': ["id: missing", "amount: not decimal(5,2)"]}
    none = sinks.write_checked(df.limit(0), os.path.join(tmp_root, "none"), "id int, amount double")
    assert (none.rows, none.kept.count(), none.rejected.count()) == (0, 0, 0)
    with pytest.raises(ValueError, match="clash"):
        sinks.write_checked(df, os.path.join(tmp_root, "c"), "id int, source string")


def test_inventory_of_files(spark, tmp_root):
    write_text(tmp_root, "a b/1.csv", "﻿id,Name\n1,x\n2,y\n")
    write_text(tmp_root, "c/2.csv", "Name,id\ny,2\n")
    write_text(tmp_root, "c/3.csv", "id,Name\n2,y\n1,x\n")
    write_text(tmp_root, "c/4.csv", "id,Name\n")
    write_text(tmp_root, "c/empty.csv", "")
    long = "".join(f"{i},{'w' * 50}\n" for i in range(60_000))      # several blocks
    write_text(tmp_root, "c/5.csv", "id,Name\n" + long)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
        found = file_inventory(spark, tmp_root + "/*/*.csv")
        by_name = {r.file.rsplit("/", 1)[1]: r for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {k: (r.header, r.lines) for k, r in by_name.items()} == {
        "1.csv": ("id,Name", 3), "2.csv": ("Name,id", 2), "3.csv": ("id,Name", 3), "4.csv": ("id,Name", 1),
        "5.csv": ("id,Name", 60_001)}
    same = lambda a, b: by_name[a].print_a == by_name[b].print_a and by_name[a].print_b == by_name[b].print_b
    assert same("1.csv", "3.csv") and not same("3.csv", "4.csv")
    assert [(h, [f.rsplit("/", 1)[1] for f in m]) for h, m in files_by_header(found)] == \
        [(["Name", "id"], ["2.csv"]), (["id", "Name"], ["1.csv", "3.csv", "4.csv", "5.csv"])]
    got = sinks.read_csv_by_name(spark, [tmp_root + "/a b", tmp_root + "/c/2.csv"], ["name", "id"], ["id"],
                                 lambda df: df.toDF(*[c.lower() for c in df.columns]))
    assert sorted(tuple(r) for r in got.collect()) == [("x", "1"), ("y", "2"), ("y", "2")]


def test_ledger_knows_content_under_other_names(spark, tmp_root):
    a = write_text(tmp_root, "in/a.csv", "id\n1\n2\n2\n")
    b = write_text(tmp_root, "in/b.csv", "id\n2\n1\n2\n")       # the same rows in another order
    c = write_text(tmp_root, "in/c.csv", "id\n1\n2\n")          # one fewer
    d = write_text(tmp_root, "in/d.csv", "id\n9\n")
    ledger = ContentLedger(os.path.join(tmp_root, "ledger"))
    names = lambda df: sorted(r.file.rsplit("/", 1)[1] for r in df.collect())
    assert names(ledger.admit(file_inventory(spark, [a, b]), 0)) == ["a.csv"]
    assert names(ledger.admit(file_inventory(spark, [b, c]), 1)) == ["c.csv"]
    assert names(ledger.admit(file_inventory(spark, [b, c]), 1)) == ["c.csv"]      # a replayed batch
    assert names(ledger.admit(file_inventory(spark, [a, d]), 2)) == ["d.csv"]
    resent = {(r.batch_id, r.file.rsplit("/", 1)[1]): r.resent and r.resent.rsplit("/", 1)[1]
              for r in ledger.entries(spark).collect()}
    assert resent == {("0", "a.csv"): None, ("0", "b.csv"): "a.csv", ("1", "b.csv"): "a.csv", ("1", "c.csv"): None,
                      ("2", "a.csv"): "a.csv", ("2", "d.csv"): None}


def test_only_crowded_partitions_are_rewritten(spark, tmp_root):
    zone = os.path.join(tmp_root, "zone")
    for k in range(5):
        days = [1, 2, None] if k < 2 else [1, None]
        rows = [(k * 10 + i, d) for i in range(3) for d in days]
        sinks.write_parquet(spark.createDataFrame(rows, "id int, day int").coalesce(1), zone, "append", partition_by=["day"])
    files = lambda d: sorted(f for f in os.listdir(f"{zone}/day={d}") if f.endswith(".parquet"))
    content = lambda: sorted((tuple(r) for r in spark.read.parquet(zone).select("id", "day").collect()), key=repr)
    before, rows, kept = {d: files(d) for d in (1, 2)}, content(), files(2)
    assert len(before[1]) == 5 and len(before[2]) == 2
    assert compact_small_files(spark, zone, ["day"]) == 2
    assert content() == rows and files(2) == kept
    assert len(files(1)) == 1 and len(files("__HIVE_DEFAULT_PARTITION__")) == 1
    assert compact_small_files(spark, zone, ["day"]) == 0
    size = file_sizes(spark, zone, ["day"]).where("day = 2").agg(F.max("size")).first()[0]
    # bins of about one file each: the small files of day 2 stay two
    assert compact_small_files(spark, zone, ["day"], target_bytes=2 * size + 2, min_files=2) == 1
    assert content() == rows and 1 <= len(files(2)) <= 2


def test_compaction_moves_rows_once(spark, tmp_root, monkeypatch):
    from starlane.plans import star

    zone, staged = os.path.join(tmp_root, "zone"), []
    for k in range(5):
        rows = spark.createDataFrame([(k, d) for d in (1, 1, None)], "id int, day int")
        sinks.write_parquet(rows.coalesce(1), zone, "append", partition_by=["day"])
    content = lambda: sorted((tuple(r) for r in spark.read.parquet(zone).select("id", "day").collect()), key=repr)
    before, write = content(), star.materialise
    monkeypatch.setattr(star, "materialise", lambda df, *a, **kw: (staged.append(df.columns), write(df, *a, **kw))[1])
    assert compact_small_files(spark, zone, ["day"]) == 2
    assert content() == before and len(before) == 15
    assert not [c for c in staged if "id" in c]     # files and bins are staged, the rows are not


def test_published_folders_hold_no_plain_identifier(spark, tmp_root):
    from starlane.operators.masking import masked, pseudonym, rotate, rotation_map

    plain = spark.createDataFrame([(1, "CUST-1"), (2, "CUST-2"), (3, None)], "customer_sk long, customer_id string")
    old, new = ("s1", 1), ("s2", 2)
    out = os.path.join(tmp_root, "v1")
    masked(plain, ["customer_id", "not there"], *old).write.parquet(out)
    data = b"".join(open(os.path.join(out, f), "rb").read() for f in os.listdir(out) if f.endswith(".parquet"))
    assert b"CUST" not in data
    mapping = rotation_map(plain, "customer_id", old, new)
    rotated = rotate(spark.read.parquet(out), "customer_id", mapping)
    assert sorted(map(tuple, rotated.collect())) == sorted(map(tuple, masked(plain, ["customer_id"], *new).collect()))
    with pytest.raises(Exception, match="not in the map"):
        rotate(spark.read.parquet(out), "customer_id", mapping.limit(1)).collect()
    with pytest.raises(ValueError, match="salt"):
        pseudonym("customer_id", "", 1)


def test_files_sent_again_grow_in_number_not_in_size(spark, tmp_root):
    from starlane.plans.queries import _deliver

    raw = spark.range(3000).select(F.col("id").cast("string").alias("Booking ID"), F.lit("x").alias("v"),
                                   (F.col("id") % 3).cast("int").alias("part"))
    for name, parts in (("first", [0, 1]), ("second", [1, 2])):
        _deliver(raw, os.path.join(tmp_root, name), parts, 5, name == "second")
    found = {n: file_inventory(spark, sorted(glob.glob(f"{tmp_root}/{n}/*/*/*.csv"))).collect() for n in ("first", "second")}
    assert {n: len(f) for n, f in found.items()} == {"first": 10, "second": 10}
    assert max(r.lines for r in found["first"]) < 400
    prints = {n: {(r.lines, r.print_a, r.print_b) for r in f if "part=1" in r.file} for n, f in found.items()}
    assert prints["first"] == prints["second"] and len(prints["first"]) == 5
