"""The time-series engine: rows, lines, tables, client, streams."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import arrays, values
from tidemark.operators import ingest
from tidemark.plans.client import Client, QueryError, Typed
from tidemark.plans.tables import Database, Table
from tidemark.sources import lines
from tidemark.streaming.ingest import Counters, ingest_tables
from tidemark.streaming.ingest import ingest as ingest_stream
from tidemark.streaming.ingest import late_windows


def test_merge_backfills_and_folds_names(spark):
    a, b = spark.createDataFrame([(1, 2.0)], "Id int, v double"), spark.createDataFrame([(2, "x")], "ID int, s string")
    got = ingest.merged(a, b)
    assert got.columns == ["Id", "v", "s"]
    assert sorted(map(tuple, got.collect())) == [(1, 2.0, None), (2, None, "x")]


def test_merge_rejects_another_type(spark):
    with pytest.raises(TypeError):
        ingest.merged(spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("x",)], "a string"))


def test_rejects_whole_rows(spark):
    rows = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, v int")
    good, bad = ingest.split_rejects(rows, {"v": F.col("v") >= 0})
    assert [r.id for r in good.collect()] == [1]
    assert sorted((r.id, r.rejected_by) for r in bad.collect()) == [(2, "v"), (3, "v")]


def test_line_round_trip(spark):
    rows = spark.createDataFrame([("a b,c=d", 'say "x\\y"\nz', 7, True), (None, "", -1, False)], "s string, t string, n bigint, b boolean")
    text = lines.to_lines(rows, "my table", ["s"], ["t", "n", "b"], F.lit(5))
    got = lines.parsed(text)
    f = F.col("fields")
    out = got.select("table", F.col("symbols")["s"].alias("s"), lines.field_as(f, "t", "string").alias("t"), lines.field_as(f, "n", "bigint").alias("n"), lines.field_as(f, "b", "boolean").alias("b"), "nanos", "error")
    assert [tuple(r) for r in out.collect()] == [("my table", "a b,c=d", 'say "x\\y"\nz', 7, True, 5, None), ("my table", None, "", -1, False, 5, None)]


def test_bad_lines_are_kept_aside(spark):
    got = lines.parsed(spark.createDataFrame([("t x=1i",), ("t",), ("t x=",), ("",)], "line string"))
    assert sorted((r.table or "", r.error or "") for r in got.collect()) == [("", "t"), ("", "t x="), ("t", "")]


def test_arrays(spark):
    rows = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0]],), ([[1.0], [2.0, 3.0]],)], "v array<array<double>>")
    value = arrays.array_2d(F.col("v"))
    got = rows.select(arrays.element(value, 1, 0).alias("x"), arrays.element(value, 2, 0).alias("y"), arrays.reshaped(value, 4).alias("z")).collect()
    assert got[0].x == 3.0 and got[0].y is None and got[0].z.shape == [4]
    assert got[1].x is None


def test_values(spark):
    row = spark.range(1).select(values.long256(F.lit("0xff")).alias("a"), values.long256(F.lit("x")).alias("b"), values.normalised(F.lit(float("nan")), "double").alias("c"), values.varint_bytes(F.lit(300)).alias("d")).first()
    assert bytes(row.a) == bytes(31) + b"\xff" and row.b is None and row.c is None and row.d == 2


def test_table_changes(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), "ts", keys=("id",))
    t.create(spark.createDataFrame([(1, 1.0, datetime(2024, 1, 1)), (2, 2.0, datetime(2024, 1, 2))], "id int, v double, ts timestamp"))
    t.insert(spark.createDataFrame([(2, 5.0, datetime(2024, 1, 3), "n")], "id int, v double, ts timestamp, note string"))
    assert [(r.id, r.v, r.note) for r in t.ordered().collect()] == [(1, 1.0, None), (2, 5.0, "n")]
    t.update({"v": F.col("v") * 2}, F.col("id") == 1)
    t.drop_column("note")
    t.change_type("v", "string")
    assert sorted((r.id, r.v) for r in t.read().collect()) == [(1, "2.0"), (2, "5.0")]
    with pytest.raises(ValueError):
        t.drop_column("ts")


def test_client(spark):
    client = Client(spark, batch_rows=3)
    cursor = client.query("SELECT id FROM range(:n)", {"n": 7})
    assert [b.num_rows for b in cursor.batches()] == [3, 3, 1] and cursor.total_rows == 7
    with pytest.raises(QueryError):
        client.frame("SELECT * FROM no_such_table")
    with pytest.raises(QueryError):
        client.exec("SELECT 1")
    assert client.frame("SELECT :x AS x", {"x": Typed(3, "int")}).first().x == 3


def test_stream_is_idempotent_with_keys(spark, tmp_path):
    spark.createDataFrame([(1, 1.0, datetime(2024, 1, 1)), (1, 2.0, datetime(2024, 1, 1)), (2, -1.0, datetime(2024, 1, 1))], "id int, v double, ts timestamp").write.parquet(str(tmp_path / "in"))
    table = Table(spark, str(tmp_path / "t"), "ts", keys=("id",))
    for k in range(2):  # the second run replays all from the start
        stream = spark.readStream.schema("id int, v double, ts timestamp").parquet(str(tmp_path / "in"))
        ingest_stream(stream, table, {"v": F.col("v") >= 0}, checkpoint=str(tmp_path / f"ck{k}"), dead_letters=str(tmp_path / "dead")).awaitTermination()
    assert table.read().select("id").distinct().count() == 1
    assert spark.read.parquet(str(tmp_path / "dead")).count() == 1


def test_windows_of_a_stream(spark, tmp_path):
    spark.createDataFrame([(datetime(2024, 1, 1, 0, m), 1.0) for m in (0, 4, 11)], "ts timestamp, v double").write.parquet(str(tmp_path / "in"))
    stream = late_windows(spark.readStream.schema("ts timestamp, v double").parquet(str(tmp_path / "in")), "ts", "1 minute", "10 minutes", "v")
    stream.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.n for r in spark.table("windows").collect()) == [1, 2]


def rows_of(spark, n, key=1):
    return spark.createDataFrame([(key, float(i), datetime(2024, 1, 1)) for i in range(n)], "id int, v double, ts timestamp").coalesce(1)


@pytest.mark.parametrize("keys", [("id",), ("ts", "id")])
def test_the_last_row_of_a_batch_stays(spark, tmp_path, keys):
    t = Table(spark, str(tmp_path / "t"), "ts", keys=keys)
    t.create(rows_of(spark, 50))
    assert [r.v for r in t.read().collect()] == [49.0]
    t.insert(rows_of(spark, 20))
    t.insert(rows_of(spark, 3, key=2))
    assert sorted((r.id, r.v) for r in t.read().collect()) == [(1, 19.0), (2, 2.0)]
    t.insert(rows_of(spark, 30).withColumn("seq", -F.col("v")), order="seq")
    assert {(r.id, r.v, r.seq) for r in t.read().collect()} == {(1, 0.0, -0.0), (2, 2.0, None)}


def test_a_table_of_no_rows(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), "ts", keys=("id",))
    t.create(rows_of(spark, 0))
    assert t.read().count() == 0 and t.read().columns == ["id", "v", "ts"]
    t.insert(rows_of(spark, 0))
    t.insert(rows_of(spark, 2))
    assert t.read().count() == 1
    t.truncate()
    assert t.read().count() == 0


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    days = spark.createDataFrame([(i, float(i), datetime(2024, 1, 1 + i)) for i in range(5)], "id int, v double, ts timestamp")
    t = Table(spark, str(tmp_path / "t"), "ts", keys=("ts", "id"))
    t.create(days)
    files = lambda: {p.parent.name: p.name for p in (tmp_path / "t").rglob("*.parquet")}
    before = files()
    t.insert(days.filter("id = 3").withColumn("v", F.lit(9.0)))
    assert t.update({"v": F.lit(8.0)}, F.col("id") == 1) == 1
    after = files()
    assert {p for p in before if before[p] != after[p]} == {"__part=2024-01-02", "__part=2024-01-04"}
    assert sorted((r.id, r.v) for r in t.read().collect()) == [(0, 0.0), (1, 8.0), (2, 2.0), (3, 9.0), (4, 4.0)]


def test_a_dropped_column_stays_dropped(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), "ts")
    t.create(rows_of(spark, 2))
    t.drop_column("v")
    t.add_column("v", "double")
    assert [r.v for r in t.read().collect()] == [None, None]
    with pytest.raises(ValueError):
        t.add_column("V", "int")


def test_database(spark, tmp_path):
    base = Database(spark, str(tmp_path / "base"))
    base.create("trips", rows_of(spark, 3), "ts")
    base["trips"].insert(rows_of(spark, 2))
    base.view("trips")
    assert Client(spark).frame("SELECT count(*) AS n FROM trips").first().n == 5
    base.rename("trips", "rides")
    assert base.tables() == ["rides"] and base["rides"].read().count() == 5
    base.drop("rides")
    base.drop("rides", if_exists=True)
    for wrong in ("", ".x", "a/b", "a?"):
        with pytest.raises(ValueError):
            base.create(wrong, rows_of(spark, 1), "ts")
    with pytest.raises(KeyError):
        base.drop("rides")


def test_typed_binds(spark):
    frame = Client(spark).frame("SELECT :a AS a, :b AS b, ':a' AS text, :c AS c -- :b", {"a": Typed(3, "bigint"), "b": Typed(None, "decimal(9,2)"), "c": 4})
    assert dict(frame.dtypes) == {"a": "bigint", "b": "decimal(9,2)", "text": "string", "c": "int"}
    assert tuple(frame.first()) == (3, None, ":a", 4)
    with pytest.raises(Exception):  # noqa: B017
        Typed(1, "bigint) --")


def test_rows_affected(spark):
    client = Client(spark)
    spark.sql("DROP TABLE IF EXISTS counted")
    client.exec("CREATE TABLE counted (id INT, note STRING) USING parquet")
    try:
        assert client.exec("INSERT INTO counted VALUES (1, 'a'), (2, 'b')").rows_affected == 2
        assert client.exec("INSERT INTO counted (id) SELECT :x", {"x": 7}).rows_affected == 1
        assert sorted(map(tuple, spark.table("counted").collect())) == [(1, "a"), (2, "b"), (7, None)]
        with pytest.raises(QueryError):
            client.exec("INSERT INTO counted (nope) VALUES (1)")
    finally:
        spark.sql("DROP TABLE counted")


def test_cursor_batches(spark):
    cursor = Client(spark, batch_rows=1000).query("SELECT id, CAST(id AS DECIMAL(9,2)) AS d, CAST(NULL AS STRING) AS s FROM range(0, 4500, 1, 7)")
    assert [c["scale"] for c in cursor.columns()] == [None, 2, None]
    found = [b for b in cursor.batches()]
    assert [b.num_rows for b in found] == [1000] * 4 + [500] and cursor.batch_seq == 4
    assert sorted(i for b in found for i in b.column(0).to_pylist()) == list(range(4500))
    stopped = Client(spark, batch_rows=10).query("SELECT id FROM range(100)")
    for _ in stopped.batches():
        stopped.cancel()
    assert stopped.total_rows == 10
    assert list(Client(spark).query("SELECT 1 AS x WHERE FALSE").batches()) == []


def test_lines_that_cant_be_told(spark):
    text = [("t x=1i,x=2i 5",), ("t,X=a x=1i 5",), ("t x=1i 99999999999999999999",), ("t x=1i -5",)]
    got = lines.parsed(spark.createDataFrame(text, "line string")).collect()
    assert [r.error is None for r in got] == [False, False, False, True] and got[3].nanos == -5


def test_stream_counts_and_halts(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1.0, datetime(2024, 1, 1)), (2, None, datetime(2024, 1, 1)), (3, -1.0, None)], "id int, v double, ts timestamp")
    rows.write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    checks, counts = {"v": F.col("v").isNotNull(), "ts": F.col("ts").isNotNull()}, Counters()
    table = Table(spark, str(tmp_path / "t"), "ts")
    ingest_stream(stream(), table, checks, checkpoint=str(tmp_path / "c"), dead_letters=str(tmp_path / "dead"), counters=counts).awaitTermination()
    assert (counts.batches, counts.rows, counts.rejected, counts.replays) == (1, 1, 2, 0) and table.read().count() == 1
    dead = {r.id: (r.rejected_by, r.from_batch, r.message) for r in spark.read.parquet(str(tmp_path / "dead")).collect()}
    assert dead == {2: ("v", 0, "the row fails the check v"), 3: ("ts", 0, "the row fails the check ts")}
    other = Table(spark, str(tmp_path / "u"), "ts")
    query = ingest_stream(stream(), other, checks, checkpoint=str(tmp_path / "d"), dead_letters=str(tmp_path / "dead2"), halting=("ts",))
    with pytest.raises(Exception, match="stop the stream"):
        query.awaitTermination()
    assert not other.exists() and spark.read.parquet(str(tmp_path / "dead2")).count() == 2


def test_a_wholly_rejected_batch(spark, tmp_path):
    rows = rows_of(spark, 2)
    rows.write.parquet(str(tmp_path / "in"))
    table = Table(spark, str(tmp_path / "t"), "ts", keys=("id",))
    for k, check in enumerate((F.lit(False), F.lit(True))):
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        ingest_stream(stream, table, {"any": check}, checkpoint=str(tmp_path / f"c{k}"), dead_letters=str(tmp_path / f"dead{k}")).awaitTermination()
        assert table.read().count() == k


def test_stream_of_several_tables(spark, tmp_path):
    rows = rows_of(spark, 3).withColumn("name", F.when(F.col("v") < 1, "a").otherwise("b"))
    rows.write.parquet(str(tmp_path / "in"))
    base = Database(spark, str(tmp_path / "base"))
    ingest_tables(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "name", base, "ts", checkpoint=str(tmp_path / "c")).awaitTermination()
    assert {n: base[n].read().count() for n in base.tables()} == {"a": 1, "b": 2}


def test_gorilla_boundaries(spark):
    """Second differences at both ends of each range, and beyond 32 bits."""

    def size(*differences):
        times, step = [0, 0], 0
        for dd in differences:
            step += dd
            times.append(times[-1] + step)
        rows = spark.createDataFrame([(1, i, t) for i, t in enumerate(times)], "s int, i int, t bigint")
        return ingest.gorilla_bytes(rows, "s", F.col("t"), "i").first().bytes

    for bits, edges in ((1, (0,)), (9, (-64, 63)), (12, (-65, 64, -256, 255)), (16, (-257, 256, -2048, 2047)), (36, (-2049, 2048, -(1 << 31), (1 << 31) - 1))):
        assert all(size(*[e] * 8) == 16 + bits for e in edges if abs(e) < 1 << 30)
        assert all(size(e) == 16 + -(-bits // 8) for e in edges)
    assert size(1 << 31) == size(-(1 << 31) - 1) == -1 and size() == 16


def test_flush_triggers(spark):
    rows = spark.createDataFrame([("p", i, b, t) for i, (b, t) in enumerate([(1, 0), (1, 1), (1, 2), (9, 3), (1, 4), (1, 99), (1, 100)])], "who string, i int, b int, t bigint")
    got = ingest.flushes(rows, "who", "i", "b", "t", most_rows=3, most_bytes=9, interval=50)
    assert [r.flush for r in got.orderBy("i").collect()] == [0, 0, 0, 1, 2, 2, 3]


def test_stamped(spark):
    rows = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, None)], "id int, ts timestamp")
    assert ingest.stamped(rows, "ts").filter("ts is null").count() == 0
    assert ingest.stamped(rows.drop("ts"), "ts").filter("ts is not null").count() == 2


def test_wide_decimals(spark):
    texts = ["0", "-1.5", "1.5", "1" + "0" * 70, "-" + "9" * 70, "1e80", "0.001", "NaN", "x", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", values.decimal256(F.col("t"), 2).alias("d"))
    got = {r.t: r.x for r in rows.select("t", values.decimal256_text(F.col("d"), 2).alias("x")).collect()}
    assert got == {"0": "0.00", "-1.5": "-1.50", "1.5": "1.50", texts[3]: texts[3] + ".00", texts[4]: texts[4] + ".00", "1e80": None, "0.001": None, "NaN": None, "x": None, None: None}
    assert [r.t for r in rows.filter("d is not null").orderBy("d").collect()] == [texts[4], "-1.5", "0", "1.5", texts[3]]


def test_more_array_values(spark):
    row = spark.range(1).select(arrays.of_shape(F.array(F.lit(2), F.lit(3)), F.array(*(F.lit(float(i)) for i in range(6)))).alias("a"))
    got = row.select(arrays.dims(F.col("a")).alias("n"), arrays.with_element(F.col("a"), F.lit(7.0), 1, 2)["data"].alias("x"), arrays.with_element(F.col("a"), F.lit(7.0), 2, 0).alias("y"), arrays.filled(F.col("a"), F.lit(1.0))["data"].alias("z"), arrays.element(F.col("a"), 1).alias("w"), arrays.of_shape(F.array(F.lit(4)), F.array(F.lit(1.0))).alias("v")).first()
    assert got.n == 2 and got.x[5] == 7.0 and got.y is None and got.z == [1.0] * 6 and got.w is None and got.v is None
