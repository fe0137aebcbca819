"""Tables on Parquet: replays, half-written versions, compaction, retention."""

import os

import pytest
from pyspark.sql import functions as F

from fleetfold.operators.merge import latest_per_key
from fleetfold.sources import compaction, files, jdbc, tables


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def frame(spark, rows, schema="k string, t int, v string"):
    return spark.createDataFrame(rows, schema)


def newest(df):
    return latest_per_key(df, ["k"], ["t"])


def test_versions_without_success_marker_do_not_count(spark, path):
    table = tables.VersionedTable(spark, path())
    assert table.read() is None
    assert table.write(frame(spark, [("a", 1, "x")])) == 1
    assert table.write(frame(spark, [("a", 2, "y")])) == 2
    os.remove(f"{table.root}/v=2/_SUCCESS")
    assert rows_of(table.read()) == [("a", 1, "x")]
    assert table.write(frame(spark, [("a", 3, "z")])) == 2
    assert rows_of(table.read()) == [("a", 3, "z")]


def test_batch_table_replay_and_fold(spark, path):
    table = tables.BatchTable(spark, path(), newest)
    assert table.read() is None
    batches = [[("a", 1, "x"), ("b", 1, "x")], [("a", 3, "new")], [("a", 2, "late"), ("c", 1, "x")], [("d", 1, "x")]]
    for n, rows in enumerate(batches):
        table.put(frame(spark, rows), n)
        table.put(frame(spark, rows), n)  # replay
    expected = [("a", 3, "new"), ("b", 1, "x"), ("c", 1, "x"), ("d", 1, "x")]
    assert rows_of(table.read()) == expected
    assert rows_of(table.read(upto=0)) == [("a", 1, "x"), ("b", 1, "x")]
    table.fold(2)
    assert rows_of(table.read()) == expected
    table.put(frame(spark, [("a", 99, "must not count")]), 1)  # part of the base already
    table.fold(2)
    assert table.contains(2) and not table.contains(3)
    assert rows_of(table.read()) == expected
    table.put(frame(spark, [("a", 4, "newest")]), 4)
    table.fold(4)
    assert rows_of(table.read()) == [("a", 4, "newest"), *expected[1:]]
    assert [f[:3] for f in table._folds()] == [(1, 0, 2), (1, 3, 4)]
    assert sorted(tables.completed(spark, table.root, "batch_id")) == [3, 4]  # those of the fold before are gone


def test_unfinished_fold_is_ignored(spark, path):
    table = tables.BatchTable(spark, path(), newest)
    table.put(frame(spark, [("a", 1, "x")]), 0)
    table.put(frame(spark, [("a", 2, "y")]), 1)
    table.fold(1)
    os.remove(f"{table.root}/fold=1.0-1/_SUCCESS")
    assert rows_of(table.read()) == [("a", 2, "y")]


def test_empty_batches_are_harmless(spark, path):
    table = tables.BatchTable(spark, path(), newest)
    table.put(frame(spark, []), 0)
    assert table.read().count() == 0
    table.put(frame(spark, [("a", 1, "x")]), 1)
    assert rows_of(table.read()) == [("a", 1, "x")]


def test_replacing_partitions_touches_no_others(spark, path):
    where = path()
    tables.replace_partitions(frame(spark, [("a", 1, "x"), ("a", 2, "x"), ("b", 1, "x")]), where, "k")
    for _ in range(2):
        tables.replace_partitions(frame(spark, [("a", 9, "y")]), where, "k")
    got = sorted((r.k, r.t, r.v) for r in spark.read.parquet(where).collect())
    assert got == [("a", 9, "y"), ("b", 1, "x")]


def _same_rows(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_compaction_keeps_the_rows_and_bounds_the_files(spark, path):
    source, target = path("source"), path("compacted")
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("p"), "id", F.lit("x").alias("v"))
    df.repartition(8).write.partitionBy("p").parquet(source)
    assert compaction.compact(spark, source, target, "p", max_rows=1000) == 24
    assert compaction.compact(spark, source, target, "p") == 0
    before, after = spark.read.parquet(source), compaction.CompactedTable(spark, source, target, "p").read()
    assert len(before.inputFiles()) == 24
    assert len(after.inputFiles()) == 6  # 1667 rows a partition, 1000 a file
    assert _same_rows(before, after)
    biggest = after.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert biggest <= 1000


def test_compaction_takes_files_of_any_age_once(spark, path):
    source, target = path("source"), path("compacted")
    assert compaction.compact(spark, source, target, "p") == 0  # nothing there yet
    spark.range(9).select((F.col("id") % 3).alias("p"), "id").coalesce(1).write.partitionBy("p").parquet(source)
    assert compaction.compact(spark, source, target, "p") == 3
    known = {f for f in spark.read.parquet(source).inputFiles()}
    spark.range(9, 12).select(F.lit(1).cast("long").alias("p"), "id").coalesce(1).write.mode("append").partitionBy("p").parquet(source)
    for file in set(spark.read.parquet(source).inputFiles()) - known:
        os.utime(file.removeprefix("file:").replace("///", "/"), (1, 1))  # older than anything
    table = compaction.CompactedTable(spark, source, target, "p")
    assert _same_rows(spark.read.parquet(source), table.read())  # not yet compacted, but read
    assert table.compact() == 1
    assert table.compact() == 0
    assert _same_rows(spark.read.parquet(source), table.read())


def test_compaction_while_the_source_grows(spark, path):
    source, target = path("source"), path("compacted")
    spark.range(6).select((F.col("id") % 2).alias("p"), "id").write.partitionBy("p").parquet(source)

    class Grows(compaction.CompactedTable):
        def _rows_of(self, files, *others):
            self.spark.range(100, 103).select(F.lit(0).cast("long").alias("p"), "id").write.mode("append").partitionBy("p").parquet(source)
            return super()._rows_of(files, *others)

    Grows(spark, source, target, "p").compact()
    table = compaction.CompactedTable(spark, source, target, "p")
    assert _same_rows(spark.read.parquet(source), table.read())
    assert table.compact() > 0
    assert _same_rows(spark.read.parquet(source), table.read())


def test_compaction_that_died_is_done_again(spark, path):
    source, target = path("source"), path("compacted")
    spark.range(6).select((F.col("id") % 2).alias("p"), "id").write.partitionBy("p").parquet(source)
    spark.range(3).write.parquet(f"{target}/data/run=1")  # rows without the list of their files
    table = compaction.CompactedTable(spark, source, target, "p")
    assert _same_rows(spark.read.parquet(source), table.read())
    assert table.compact() > 0
    assert _same_rows(spark.read.parquet(source), table.read())


def _add(spark, source, first, last, by=2):
    spark.range(first, last).select((F.col("id") % by).alias("p"), "id").coalesce(1).write.mode("append").partitionBy("p").parquet(source)


def test_a_reader_that_meets_a_run_gets_every_row_once(spark, path):
    """A run ends between the moment a reader takes the manifest and the one it lists the source, or the other way round."""
    source, target = path("source"), path("compacted")
    _add(spark, source, 0, 10)
    plain = compaction.CompactedTable(spark, source, target, "p")
    plain.compact()
    for step in ("_source_files", "_not_covered", "_rows_of"):
        first = spark.read.parquet(source).count()
        _add(spark, source, first, first + 5)

        class Meets(compaction.CompactedTable):
            pass

        def meet(self, *args, step=step):
            assert plain.compact() > 0
            return getattr(compaction.CompactedTable, step)(self, *args)

        setattr(Meets, step, meet)
        assert sorted(r.id for r in Meets(spark, source, target, "p").read().collect()) == list(range(first + 5)), step


def test_many_runs_leave_the_files_that_the_rows_ask_for(spark, path):
    source, target = path("source"), path("compacted")
    table = compaction.CompactedTable(spark, source, target, "p")
    for n in range(20):
        _add(spark, source, 10 * n, 10 * n + 10)
        assert table.compact(max_rows=30) == 2
    data = table.manifest.read().where("kind = 'data'")
    assert [(r.p, r["sum(rows)"]) for r in data.groupBy("p").sum("rows").orderBy("p").collect()] == [(0, 100), (1, 100)]
    assert all(r["count"] <= 7 for r in data.groupBy("p").count().collect())  # 100 rows in files of 15 to 30
    assert sorted(r.id for r in table.read().collect()) == list(range(200))
    assert sorted(r.id for r in table.read(F.col("p") == 1).collect()) == list(range(1, 200, 2))
    assert len(table.read(F.col("p") == 1).inputFiles()) <= 7
    # Of what runs have merged again only the files of the last versions are left.
    named = {r.file for v in table.manifest.versions().values() for r in spark.read.parquet(v).where("kind = 'data'").select("file").collect()}
    stored = {r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{target}/data").select("path").collect()}
    assert named == stored


def test_full_files_are_left_alone(spark, path):
    source, target = path("source"), path("compacted")
    table = compaction.CompactedTable(spark, source, target, "p")
    _add(spark, source, 0, 40)
    table.compact(max_rows=10)
    before = {r.file for r in table.manifest.read().where("kind = 'data'").select("file").collect()}
    _add(spark, source, 40, 44)
    table.compact(max_rows=10)
    assert before < {r.file for r in table.manifest.read().where("kind = 'data'").select("file").collect()}


def test_the_join_finds_what_names_find(spark, path, monkeypatch):
    source, target = path("source"), path("compacted")
    rows = spark.createDataFrame([(k, p) for k, p in enumerate(["a b", "x=y", "50%", "{a,b}", "ü", None, "*"])], "id int, p string")
    rows.write.partitionBy("p").parquet(source)
    table = compaction.CompactedTable(spark, source, target, "p")
    for most in (10_000, 0):
        monkeypatch.setattr(compaction, "MAX_NAMED_FILES", most)
        rows.write.mode("append").partitionBy("p").parquet(source)
        assert _same_rows(spark.read.parquet(source), table.read())
        assert table.compact() > 0
        assert _same_rows(spark.read.parquet(source), table.read())


def test_two_runs_at_once(spark, path):
    source, target = path("source"), path("compacted")
    _add(spark, source, 0, 10)

    class Overtaken(compaction.CompactedTable):
        def _written(self, *args):
            compaction.CompactedTable(self.spark, source, target, "p").compact()
            return super()._written(*args)

    with pytest.raises(tables.ConcurrentChange):
        Overtaken(spark, source, target, "p").compact()
    table = compaction.CompactedTable(spark, source, target, "p")
    assert sorted(r.id for r in table.read().collect()) == list(range(10)) and table.compact() == 0


def test_writers_never_share_a_version(spark, path):
    table = tables.VersionedTable(spark, path())
    other = tables.VersionedTable(spark, table.root)
    table.write(spark.range(1))
    claimed = other._claim()  # at work on version 2
    assert claimed == 2 and table.write(spark.range(3)) == 3
    with pytest.raises(tables.ConcurrentChange):
        table.write(spark.range(4), base=2)
    assert table.write(spark.range(5), base=3) == 4 and table.read().count() == 5
    with pytest.raises(tables.ConcurrentChange):
        table.write(spark.range(6), base=3)
    stale = tables.VersionedTable(spark, table.root, lease_hours=0)
    assert stale._claim() == 5


def test_a_version_in_use_is_not_dropped(spark, path):
    table = tables.VersionedTable(spark, path(), keep=1)
    with table.lease() as nothing:
        assert nothing is None
    table.write(spark.range(1))
    with table.lease() as held:
        for n in range(2, 6):
            table.write(spark.range(n))
        assert held.count() == 1 and list(table.versions()) == [1, 5]
    table.write(spark.range(6))
    assert list(table.versions()) == [6]


def test_versions_that_are_long_gone_are_dropped(spark, path):
    table = tables.VersionedTable(spark, path(), keep=2)
    for n in range(4):
        table.write(spark.range(n))
    assert list(table.versions()) == [3, 4] and table.read().count() == 3


def test_retention_keeps_unknown_ages(spark):
    df = spark.createDataFrame([("a", "2026-01-02 00:00:00"), ("b", "2026-01-01 23:59:59"), ("c", None)], "k string, t string")
    df = df.withColumn("t", F.col("t").cast("timestamp"))
    assert {r.k for r in df.where(tables.within_retention("t", "2026-01-03 00:00:00")).collect()} == {"a", "c"}


def test_partition_scan_prunes(spark, path):
    where = path()
    df = spark.createDataFrame([("2026-01-06", 1), ("2026-01-07", 2), ("2026-01-08", 3)], "d string, v int")
    tables.write_partitioned(df.withColumn("d", F.col("d").cast("date")), where, "d")
    one = files.read_partition(spark, where, "d", "2026-01-07")
    assert [r.v for r in one.collect()] == [2]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan
    assert files.read_partitions_by_glob(spark, where, "d").count() == 3


def test_jdbc_options():
    url = jdbc.postgres_url("db", 5432, "warehouse")
    options = jdbc.jdbc_options(url, "gold.t", user="u", password=None, numPartitions=4)
    assert url == "jdbc:postgresql://db:5432/warehouse?stringtype=unspecified"
    assert options == {"url": url, "dbtable": "gold.t", "driver": "org.postgresql.Driver", "user": "u", "numPartitions": "4"}
    assert "driver" not in jdbc.jdbc_options("jdbc:other:x", "t")


def test_secret_lookup_order(tmp_path, monkeypatch):
    monkeypatch.setenv("WAREHOUSE_PASSWORD", "from-env")
    assert jdbc.secret("warehouse_password", (str(tmp_path),)) == "from-env"
    (tmp_path / "warehouse_password.txt").write_text("from-file\n")
    assert jdbc.secret("warehouse_password", (str(tmp_path),)) == "from-file"
    (tmp_path / "warehouse_password").write_text("from-mount")
    assert jdbc.secret("warehouse_password", (str(tmp_path),)) == "from-mount"
    assert jdbc.secret("absent", (), "d") == "d"


class FakeSession:
    """Only what the choice of the shared folder looks at."""

    def __init__(self, setting, master, context_dir=None):
        self.conf = type("conf", (), {"get": staticmethod(lambda name, default: setting or default)})
        self.sparkContext = type("context", (), {"master": master, "getCheckpointDir": staticmethod(lambda: context_dir)})


def test_shared_folder_comes_from_the_session(spark):
    from fleetfold.session import scratch, shared_base

    assert scratch(spark, "x").startswith(f"{shared_base(spark)}/fleetfold/")
    assert scratch(spark, "x") != scratch(spark, "x")

    cluster = FakeSession("/shared/place/", "yarn")
    assert shared_base(cluster) == "/shared/place"
    assert shared_base(FakeSession(None, "yarn", "hdfs://n/cp/1")) == "hdfs://n/cp/1"
    with pytest.raises(RuntimeError):
        shared_base(FakeSession(None, "yarn"))
    assert shared_base(FakeSession(None, "local[2]")) == shared_base(FakeSession(None, "local[4]"))


def test_folds_rewrite_a_row_once_per_level(spark, path):
    written = []

    class Counting(tables.BatchTable):
        def _write(self, rows, name):
            super()._write(rows, name)
            written.append((name, self.spark.read.parquet(f"{self.root}/{name}").count()))

    table = Counting(spark, path("t"), lambda df: latest_per_key(df, ["k"], ["t"]), fan_in=3)
    for n in range(18):
        table.put(frame(spark, [(f"k{n}", n, "v"), ("all", n, "v")]), n)
        if n % 2:
            table.fold(n)
    assert {r.k: r.t for r in table.read().collect()} == {**{f"k{n}": n for n in range(18)}, "all": 17}
    per_level = {level: sum(c for name, c in written if name.startswith(f"fold={level}.")) for level in (1, 2, 3)}
    assert per_level[1] <= 2 * 18 and per_level[2] <= 2 * 18 and per_level[3] <= 2 * 18
    assert not table.put(frame(spark, [("late", 99, "v")]), 5)  # a replay of a folded batch changes nothing
    assert table.read().count() == 19


def test_retention_drops_folders_and_rewrites_nothing(spark, path):
    table = tables.BatchTable(spark, path("t"), at=F.col("ts"))
    rows = spark.range(10).select("id", F.timestamp_seconds(F.col("id") * 86_400).alias("ts"))
    table.put(rows.unionByName(spark.range(10, 11).select("id", F.lit(None).cast("timestamp").alias("ts"))), 0)
    assert table.drop_before(F.lit("1970-01-08 12:00:00").cast("timestamp")) == 7
    assert sorted(r.id for r in table.read().collect()) == [7, 8, 9, 10]


def test_tables_need_the_success_marker(spark, path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        with pytest.raises(RuntimeError, match="marksuccessfuljobs"):
            tables.VersionedTable(spark, path("v"))
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_pinned_copies_leave_with_their_scope(spark):
    from fleetfold.session import pin, scratch_scope
    from fleetfold.storage import path_exists

    with scratch_scope(spark) as folder:
        assert pin(spark.range(3), "x").count() == 3 and path_exists(spark, folder)
    assert not path_exists(spark, folder)
