"""Compaction of micro-batch folders: every fact is seen once, before, during and after."""

import re

from pyspark.sql import functions as F

from urbanflux import schemas
from urbanflux.sources.compaction import CompactedTable
from urbanflux.sources.pieces import covering, piece_name, piece_of, to_fold
from urbanflux.sources.snapshots import SnapshotTable
from urbanflux.sources.tables import append_table, overwrite_folder

LAYOUT = schemas.columns("id long, date_key int, stream_id string, batch_id long")


def land(spark, table, stream, batch, ids, day=1):
    rows = spark.createDataFrame([(i, day + i % 2) for i in ids], "id long, date_key int")
    overwrite_folder(rows, f"{table.landing}/stream_id={stream}/batch_id={batch}", ("date_key",))


def ids(table, spark):
    return sorted(r["id"] for r in table.read(spark).collect())


def files(df):
    return {f for f in df.inputFiles()}


def test_every_row_once_at_any_time(spark, folder):
    table = CompactedTable(f"{folder}/landing", f"{folder}/compacted", LAYOUT)
    assert table.compact(spark) == 0 and ids(table, spark) == []
    land(spark, table, "a", 0, range(4))
    land(spark, table, "a", 1, range(4, 8))
    land(spark, table, "b", 0, range(8, 10))
    before = table.read(spark)
    assert table.compact(spark) == 1  # the newest batch of each stream stays open
    assert ids(table, spark) == list(range(10))
    assert sorted(r["id"] for r in before.collect()) == list(range(10))

    land(spark, table, "a", 1, range(4, 7))  # the open batch is repeated after a crash
    land(spark, table, "a", 2, range(10, 12))
    assert ids(table, spark) == [*range(7), 8, 9, 10, 11]
    assert table.compact(spark) == 1 and table.compact(spark) == 0
    assert ids(table, spark) == [*range(7), 8, 9, 10, 11]

    # a crashed run: files without an entry in the log
    append_table(table.read(spark).drop("v"), f"{table.path}/v=3", ("date_key",))
    assert ids(table, spark) == [*range(7), 8, 9, 10, 11]
    land(spark, table, "b", 1, [20])
    assert table.compact(spark) == 1
    assert ids(table, spark) == [*range(7), 8, 9, 10, 11, 20]


def test_a_day_reads_its_compacted_folders_and_open_batches_only(spark, folder):
    table = CompactedTable(f"{folder}/landing", f"{folder}/compacted", LAYOUT)
    for batch in range(4):
        land(spark, table, "a", batch, range(10 * batch, 10 * batch + 4))
    table.compact(spark)
    day = table.read(spark).filter(F.col("date_key") == 2)
    assert sorted(r["id"] for r in day.collect()) == [1, 3, 11, 13, 21, 23, 31, 33]
    compacted = spark.read.parquet(f"{table.path}/v=1").filter(F.col("date_key") == 2)
    assert 1 <= len(files(compacted)) <= 2  # one or two large files, not one per batch


def open_folders(df):
    return {re.search(r"stream_id=[^/]*/batch_id=[^/]*", f).group() for f in df.inputFiles() if "batch_id=" in f}


def test_compacted_folders_are_neither_listed_nor_read(spark, folder):
    table = CompactedTable(f"{folder}/landing", f"{folder}/compacted", LAYOUT)
    for batch in range(5):
        land(spark, table, "a", batch, range(10 * batch, 10 * batch + 4))
        land(spark, table, "b", batch, range(500 + 10 * batch, 504 + 10 * batch))
    assert table.compact(spark) == 8
    land(spark, table, "a", 5, [90])
    now = table.read(spark)
    assert open_folders(now) == {"stream_id=a/batch_id=4", "stream_id=a/batch_id=5", "stream_id=b/batch_id=4"}
    plan = now._jdf.queryExecution().executedPlan().toString()
    landed = re.search(r"PartitionFilters: \[[^\]]*batch_id[^\]]*\]", plan)
    assert landed and "stream_id" in landed.group() and "Join" not in plan
    assert len(ids(table, spark)) == 41
    day = now.filter("date_key = 2 AND stream_id = 'a'")
    assert sorted(r["id"] for r in day.collect()) == [1, 3, 11, 13, 21, 23, 31, 33, 41, 43]


def test_readers_see_each_row_once_while_compaction_runs(spark, folder):
    table = CompactedTable(f"{folder}/landing", f"{folder}/compacted", LAYOUT)
    for batch in range(3):
        land(spark, table, "a", batch, [batch])
    before = table.read(spark)
    table.compact(spark)
    between = table.read(spark)
    land(spark, table, "a", 3, [3])
    land(spark, table, "a", 4, [4])
    table.compact(spark)
    assert table.retire(spark) == 2  # batches of the first compaction: the reader before it is gone
    assert sorted(r["id"] for r in between.collect()) == [0, 1, 2]
    assert before.columns == between.columns
    assert ids(table, spark) == [0, 1, 2, 3, 4]
    assert {n for found in table.landed_batches(spark).values() for n in found} == {2, 3, 4}
    assert table.retire(spark) == 0


def test_many_versions_are_few_folders(spark, folder):
    table = CompactedTable(f"{folder}/landing", f"{folder}/compacted", LAYOUT, partition_by=())
    for batch in range(11):
        land(spark, table, "a", batch, [batch])
        table.compact(spark)
    assert ids(table, spark) == list(range(11))
    held = {re.search(r"/v=([^/]*)/", f).group(1) for f in table.read(spark).inputFiles() if "/v=" in f}
    assert held == {"1-8", "9", "10"}
    opened = table.read(spark)
    table.retire(spark)
    assert sorted(r["id"] for r in opened.collect()) == list(range(11))
    assert ids(table, spark) == list(range(11))


def test_final_streams_are_compacted_whole_and_go(spark, folder):
    table = CompactedTable(f"{folder}/landing", f"{folder}/compacted", LAYOUT)
    for run in ("run-1", "run-2"):
        land(spark, table, run, 0, [int(run[-1])])
    assert table.compact(spark) == 0
    assert table.compact(spark, lambda stream: stream < "run-2") == 1
    land(spark, table, "a", 0, [10])
    land(spark, table, "a", 1, [11])
    assert table.compact(spark) == 1
    assert table.retire(spark) == 1 and set(table.landed_batches(spark)) == {"a", "run-2"}
    assert ids(table, spark) == [1, 2, 10, 11]


def test_pieces():
    pieces, folds = [], []
    for version in range(1, 600):
        pieces = covering(version, folds)
        while (span := to_fold(pieces)) is not None:
            folds.append(span)
            pieces = covering(version, folds)
        assert [x for a, b in pieces for x in range(a, b + 1)] == list(range(1, version + 1))
        assert len(pieces) <= 7 * 4
    assert all(piece_of(piece_name(p)) == p for p in pieces)


def test_history_stays_in_few_folders(spark, folder):
    table = SnapshotTable(f"{folder}/dimension", schemas.columns("id long"))

    def rows(*values):
        return spark.createDataFrame([(v,) for v in values], "id long")

    for n in range(1, 18):
        table.commit(rows(100 + n), rows(n))
        if n == 9:
            opened = table.all_versions(spark)
    assert sorted(r["id"] for r in table.expired(spark).collect()) == list(range(1, 18))
    folders = {f.rsplit("/", 1)[0].split("/dimension/")[1] for f in table.expired(spark).inputFiles()}
    assert folders == {"folded/v=1-8", "folded/v=9-16", "v=17/expired"}
    assert sorted(r["id"] for r in opened.collect()) == [*range(1, 10), 109]
    assert table.retire(spark, keep=2) > 10
    assert sorted(r["id"] for r in table.all_versions(spark).collect()) == [*range(1, 18), 117]
    table.commit(rows(118))
    assert table.all_versions(spark).count() == 18
