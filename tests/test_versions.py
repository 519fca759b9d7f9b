"""Publication through versions: failures, crashes, readers at work, leftovers, and keys."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from cabrank.operators.filters import on_day
from cabrank.plans import pipelines
from cabrank.quality import KeyViolation, RowCountMismatch, known_keys
from cabrank.session import fresh_database
from cabrank.sinks import tables, versions

NOW = dt.timedelta(0)


class Crash(BaseException):
    """A driver that dies: nothing is cleaned up."""


def ids(df):
    return sorted(row["id"] for row in df.select("id").collect())


def boom(df):
    return df.select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))


def folders(spark, name):
    return {v.path.rpartition("/")[2] for v in versions.versions(spark, name)}


def on_disk(spark, name):
    root = spark.catalog.getDatabase(name.partition(".")[0]).locationUri + "/__versions"
    return set(os.listdir(root.removeprefix("file:")))


@pytest.fixture
def name(spark):
    name = f"{fresh_database(spark)}.t"
    tables.replace_table(spark.range(3), name)
    return name


@pytest.mark.parametrize("failing", [0, 1, 2])
def test_a_load_failing_in_any_batch_leaves_the_old_table(spark, name, failing):
    batches = [spark.range(10, 15), spark.range(15, 20), spark.range(20, 25)]
    batches[failing] = boom(batches[failing])
    with pytest.raises(Exception, match="boom"):
        tables.load_table(spark, batches, name)
    assert ids(spark.table(name)) == [0, 1, 2]
    assert len(folders(spark, name)) == 1 and on_disk(spark, name) == folders(spark, name)


def test_a_load_failing_on_its_row_count_leaves_the_old_table(spark, name, monkeypatch):
    def wrong(spark, table, expected):
        raise RowCountMismatch("short")

    monkeypatch.setattr(tables, "require_row_count", wrong)
    with pytest.raises(RowCountMismatch):
        tables.load_table(spark, [spark.range(9)], name)
    assert ids(spark.table(name)) == [0, 1, 2]


def test_a_load_failing_on_its_key_leaves_the_old_table(spark, name):
    with pytest.raises(KeyViolation):
        tables.load_table(spark, [spark.range(5), spark.range(4, 6)], name, key=["id"])
    assert ids(spark.table(name)) == [0, 1, 2]


def test_a_generator_of_batches_that_fails_and_one_without_batches(spark, name):
    def batches():
        yield spark.range(4)
        raise OSError("source gone")

    with pytest.raises(OSError):
        tables.load_table(spark, batches(), name)
    with pytest.raises(ValueError, match="no batches"):
        tables.load_table(spark, [], name)
    assert ids(spark.table(name)) == [0, 1, 2]


def test_a_new_table_whose_load_fails_is_not_there(spark):
    name = f"{fresh_database(spark)}.fresh"
    with pytest.raises(Exception, match="boom"):
        tables.load_table(spark, [spark.range(2), boom(spark.range(2))], name)
    assert not spark.catalog.tableExists(name)


@pytest.mark.parametrize("step", ["saved", "point", "collect"])
def test_a_crash_between_any_two_steps_leaves_old_or_new(spark, name, monkeypatch, step):
    with monkeypatch.context() as patch:
        patch.setattr(versions, "discard", lambda *a: None)

        def die(*a, **b):
            raise Crash

        if step == "saved":
            patch.setattr(versions, "publish", die)
        else:
            patch.setattr(versions, step, die)
        with pytest.raises(Crash):
            tables.replace_table(spark.range(10, 12), name)
    assert ids(spark.table(name)) == ([10, 11] if step == "collect" else [0, 1, 2])
    assert len(folders(spark, name)) == 2
    # The next run works, and what is left goes once it is old enough.
    tables.replace_table(spark.range(20, 22), name)
    assert ids(spark.table(name)) == [20, 21]
    with versions.new_version(spark, name) as version:
        spark.range(30, 31).write.option("path", version.path).saveAsTable(version.name)
        versions.publish(spark, version, name, NOW)
    assert ids(spark.table(name)) == [30]
    assert len(folders(spark, name)) == 2 and on_disk(spark, name) == folders(spark, name)


def test_an_error_after_the_switch_leaves_the_new_rows(spark, name, monkeypatch):
    def fail(*args):
        raise OSError("no leave to delete")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "collect", fail)
        with pytest.raises(OSError):
            tables.replace_table(spark.range(10, 12), name)
        with pytest.raises(OSError):
            tables.load_table(spark, [spark.range(20, 23)], name)
    assert ids(spark.table(name)) == [20, 21, 22]
    tables.replace_table(spark.range(30, 31), name)
    assert ids(spark.table(name)) == [30] and on_disk(spark, name) == folders(spark, name)


def test_a_folder_without_a_table_is_collected_when_old(spark, name):
    root = spark.catalog.getDatabase(name.partition(".")[0]).locationUri + "/__versions"
    old, young = "t__20200101000000_dead", f"t__{dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S}_live"
    for leftover in (old, young):
        spark.range(1).write.parquet(f"{root}/{leftover}")
    tables.replace_table(spark.range(5, 6), name)
    assert on_disk(spark, name) == folders(spark, name) | {young}


def test_a_reader_in_a_loop_never_misses_the_table(spark, name):
    seen, wrong, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.add(tuple(ids(spark.table(name))))
            except Exception as error:  # noqa: BLE001
                wrong.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    published = {(0, 1, 2)}
    for n in range(1, 9):
        tables.replace_table(spark.range(100 * n, 100 * n + n), name)
        published.add(tuple(range(100 * n, 100 * n + n)))
    stop.set()
    reader.join()
    assert not wrong and seen <= published and len(seen) > 2
    assert len(folders(spark, name)) == 2


def test_the_schema_changes_with_the_version_and_old_readers_go_on(spark, name):
    reader = spark.table(name)
    tables.replace_table(reader.selectExpr("id + 1 AS id", "'x' AS note"), name)
    assert ids(reader) == [0, 1, 2]
    assert spark.table(name).columns == ["id", "note"] and ids(spark.table(name)) == [1, 2, 3]


def test_a_plain_table_of_the_name_is_replaced(spark):
    name = f"{fresh_database(spark)}.t"
    spark.range(4).write.saveAsTable(name)
    assert ids(tables.append_table(spark.range(4, 5), name)) == [0, 1, 2, 3, 4]
    tables.replace_table(spark.table(name).where("id > 2"), name)
    assert ids(spark.table(name)) == [3, 4]
    database = name.partition(".")[0]
    assert [t.name for t in spark.catalog.listTables(database) if not t.isTemporary] == ["t"]


def test_published_days_refresh_and_prune_through_the_pointer(spark):
    rows = [(i, dt.datetime(2021, 1, 1 + i)) for i in range(3)]
    df = spark.createDataFrame(rows, "id int, t timestamp_ntz")
    name = f"{fresh_database(spark)}.days"
    tables.publish_by_day(df, name, "t")
    tables.publish_by_day(df.where("id < 2"), name, "t")
    after = tables.refresh_days(df.where("id = 2"), name, "t")
    wanted = on_day(after, "t", dt.date(2021, 1, 3))
    assert ids(wanted) == [2]
    plan = wanted._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(pickup_date" in plan and "PushedFilters: [IsNotNull(t)" in plan


# Keys


def test_a_declared_key_holds_for_later_appends(spark, tmp_path):
    name = f"{fresh_database(spark)}.zones"
    tables.replace_dimension(spark.createDataFrame([(1, "a"), (2, "b")], "id int, zone string"), name, "id")

    def before():
        return sorted(map(tuple, spark.table(name).collect()))

    assert before() == [(1, "a"), (2, "b")]
    for rows in ([(2, "known")], [(3, "x"), (3, "y")], [(None, "null")], [(4, "new"), (1, "known")]):
        with pytest.raises(KeyViolation):
            tables.append_table(spark.createDataFrame(rows, "id long, zone string").withColumn("id", F.col("id").cast("int")), name)
        assert before() == [(1, "a"), (2, "b")]
    tables.append_table(spark.createDataFrame([("c", 3)], "zone string, id int"), name)
    assert before() == [(1, "a"), (2, "b"), (3, "c")]
    with pytest.raises(KeyViolation):
        tables.append_table(spark.createDataFrame([(3, "c")], "id int, zone string"), name)
    # A table that is replaced without a key has none.
    tables.replace_table(spark.table(name), name)
    assert tables.append_table(spark.createDataFrame([(3, "c")], "id int, zone string"), name).count() == 4


def test_a_key_of_two_columns_and_an_empty_table(spark):
    name = f"{fresh_database(spark)}.pairs"
    df = spark.createDataFrame([(1, "a"), (1, "b")], "x int, y string")
    tables.create_empty(df, name, key=["x", "y"])
    assert tables.append_table(df, name).count() == 2
    tables.append_table(df.limit(0), name)
    tables.append_table(spark.createDataFrame([(2, "a")], "x int, y string"), name)
    with pytest.raises(KeyViolation, match="there already"):
        tables.append_table(df.limit(1), name)
    assert spark.table(name).count() == 3


def test_zones_loaded_with_a_key_reject_known_ids(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("LocationID,Zone\n1,Park\n2,Harbour\n")
    name = f"{fresh_database(spark)}.zone_data"
    zones = pipelines.load_zones(spark, str(path), name)
    with pytest.raises(KeyViolation):
        tables.append_table(zones.limit(1), name)
    assert spark.table(name).count() == 2


def test_known_keys_are_exact_at_any_size_of_the_filter(spark, monkeypatch):
    from cabrank import quality

    stored = spark.range(0, 30_000).selectExpr("id % 10000 AS a", "cast(id AS string) AS b")
    batch = spark.range(25_000, 35_000).selectExpr("cast(id % 10000 AS int) AS a", "cast(id AS string) AS b")
    for most in (quality.FILTER_MOST, 64):
        monkeypatch.setattr(quality, "FILTER_MOST", most)
        assert known_keys(batch, stored, "a", "b").count() == 5_000
    plan = known_keys(batch, stored, "a", "b")._jdf.queryExecution().toString()
    assert "BroadcastExchange" in plan and "bit_or" in plan
