"""Queries that write to the shared folder, on a session whose master is a cluster's by name."""

import duckdb
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.conf import RuntimeConfig

from cabrank import session
from cabrank.plans.catalogue import QUERIES
from cabrank.plans.oracle import ORACLE
from cabrank.session import workspace
from compare import differences

NAMES = [
    "sink_table_append",
    "sink_table_replace",
    "trips_for_bases_cost",
    "trips_in_range_partitioned",
    "append_key_guard",
    "clustered_base_scan",
    "clustered_layout",
    "convert_csv_parquet",
    "ctas_partitioned",
    "ctas_partitioned_except",
    "external_table_glob",
    "external_table_single",
    "land_raw",
    "load_quarantine",
    "load_ledger",
    "monthly_backfill",
    "load_row_count",
    "monthly_landing_stream",
    "monthly_source_paths",
    "registry_fanout",
    "relayout_by_dataset",
    "row_ordinal",
    "row_ordinal_source",
    "scan_csv_chunked",
    "scan_csv_inferred",
    "scan_csv_typed",
    "scan_table",
    "sink_create_empty",
]


@pytest.fixture
def cluster(spark, monkeypatch):
    """A session of its own; what was tried before is not known."""
    monkeypatch.setattr(session, "_tried", set(), raising=False)
    own = spark.newSession()
    own.conf.set("spark.master", "spark://host:7077")
    return own


def name_folder(monkeypatch, path):
    """The setting cannot be changed in a session."""
    get = RuntimeConfig.get
    named = {"spark.checkpoint.dir": path}
    monkeypatch.setattr(RuntimeConfig, "get", lambda self, key, *default: named.get(key) or get(self, key, *default))


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A few rows of each table that the queries read."""
    root = tmp_path_factory.mktemp("small")
    n = F.col("id")
    time = F.timestamp_add("MINUTE", (n * 997).cast("int"), F.lit("2024-01-01 00:00:07").cast("timestamp_ntz"))
    day = F.timestamp_add("DAY", (n * 23).cast("int"), F.lit("1995-01-01").cast("timestamp_ntz"))
    kind = F.element_at(F.array(*map(F.lit, ("click", "view", "error", "buy"))), (n % 4 + 1).cast("int"))
    tables = {
        "events": (40, {"event_id": n, "ts": time, "user_id": n % 7, "event_type": kind, "value": n * 1.25, "props": F.concat(F.lit('{"k": "'), n.cast("string"), F.lit('"}'))}),
        "orders": (110, {"o_orderkey": n, "o_custkey": n % 9, "o_orderstatus": F.lit("O"), "o_totalprice": n * 10.5, "o_orderdate": day, "o_orderpriority": F.lit("1-URGENT")}),
        "customer": (9, {"c_custkey": n, "c_name": F.concat(F.lit("Customer, "), n.cast("string")), "c_nationkey": (n % 3).cast("int"), "c_acctbal": n * -1.5, "c_mktsegment": F.lit("AUTO")}),
        "supplier": (6, {"s_suppkey": n, "s_name": F.concat(F.lit("S"), n.cast("string")), "s_nationkey": (n % 3).cast("int"), "s_acctbal": n * 2.5}),
        "part": (5, {"p_partkey": n, "p_name": F.lit("a part"), "p_brand": F.lit("B"), "p_type": F.lit("T"), "p_size": n.cast("int"), "p_retailprice": n * 3.25}),
        "lineitem": (50, {"l_orderkey": n, "l_partkey": n % 5, "l_suppkey": n % 6, "l_linenumber": (n % 4 + 1).cast("int"), "l_quantity": n * 1.0, "l_extendedprice": n * 7.25, "l_discount": F.lit(0.05), "l_tax": F.lit(0.02), "l_returnflag": F.lit("N"), "l_linestatus": F.lit("O"), "l_shipdate": day}),
    }
    for name, (rows, columns) in tables.items():
        spark.range(rows).select(*[c.alias(k) for k, c in columns.items()]).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.fixture(scope="module")
def oracle(small):
    connection = duckdb.connect()
    for name in ("events", "orders", "customer", "supplier", "part", "lineitem"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{small}/{name}.parquet/*.parquet')")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", NAMES)
def test_query_on_a_cluster_with_a_mounted_folder(cluster, oracle, small, name):
    assert differences(QUERIES[name](cluster, small), oracle, ORACLE[name]) is None


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_mounted_folder_is_tried_once_and_left_clean(cluster, tmp_path, monkeypatch, scheme):
    written = []
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (written.append(path), write(self, path)))
    name_folder(monkeypatch, f"{scheme}{tmp_path}/")
    assert [workspace(cluster) for _ in range(2)] == [f"{scheme}{tmp_path}"] * 2
    assert len(written) == 1
    assert list((tmp_path / "cabrank").iterdir()) == []


def test_folder_that_misses_files_of_some_executors_is_an_error(cluster, tmp_path, monkeypatch):
    write = DataFrameWriter.parquet

    def written_elsewhere(self, path):
        write(self, path)
        next((tmp_path / "cabrank").glob("probe-*/part-*")).unlink()

    monkeypatch.setattr(DataFrameWriter, "parquet", written_elsewhere)
    name_folder(monkeypatch, str(tmp_path))
    for _ in range(2):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            workspace(cluster)


def test_folder_that_cannot_be_written_is_an_error(cluster, monkeypatch):
    name_folder(monkeypatch, "file:///proc/nowhere")
    with pytest.raises(RuntimeError, match="not file:///proc/nowhere"):
        workspace(cluster)
