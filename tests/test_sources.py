"""Readers, writers, ingestion and catalog, by writing and reading back."""

import uuid
from datetime import date, datetime
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starloom import contracts
from starloom.operators.lookup import AmbiguousLookup
from starloom.plans import run as full_run
from starloom.plans import silver_scans
from starloom.plans.scenario import Scenario
from starloom.rules import ScanPolicy
from starloom.session import (
    materialize, remove_intermediate, removing_intermediates, scratch_path, work_folder,
)
from starloom.sources import ingest, readers, writers

HEADER = ",".join(contracts.TICKET_SCANS.names)
SCAN_LINE = 'T1,M1,S1,F1,"CAT ""1""",300,web,2025-12-01,18:00,G1,SCANNED,2025-12-21 18:00:00'


def land(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_csv_is_typed_and_bad_values_are_null(spark, tmp_path):
    land(tmp_path / "a", "1.csv", HEADER, SCAN_LINE.replace('""1""', '\\"1\\"'))
    land(tmp_path / "a", "2.csv", HEADER, "T2,,S1,,x,many,web,soon,18:00,G1,SCANNED,never")
    df = readers.read_csv(spark, str(tmp_path / "a/*.csv"), contracts.TICKET_SCANS)
    contracts.assert_contract(df, contracts.TICKET_SCANS)
    first, second = df.orderBy("ticket_id").collect()
    assert first.ticket_category == 'CAT "1"'
    assert (first.ticket_price_mad, first.purchase_date) == (300, date(2025, 12, 1))
    assert first.scan_timestamp == datetime(2025, 12, 21, 18)
    assert (second.match_id, second.ticket_price_mad, second.purchase_date, second.scan_timestamp) == (
        None, None, None, None
    )


def test_csv_columns_go_by_name(spark, tmp_path):
    land(tmp_path, "1.csv", "extra,file_name,folder_name", "x,f,d")
    assert rows(readers.read_csv(spark, str(tmp_path / "*.csv"), contracts.CONFIG_CSV)) == [("d", "f")]
    land(tmp_path / "less", "1.csv", "file_name", "f")
    less = readers.read_csv(spark, str(tmp_path / "less/*.csv"), contracts.CONFIG_CSV)
    assert rows(less) == [(None, "f")]


def test_csv_files_are_read_by_their_own_header(spark, tmp_path):
    land(tmp_path, "1.csv", "folder_name,file_name", "d,f")
    land(tmp_path, "2.csv", "file_name,extra,folder_name", "g,x,e")
    land(tmp_path, "3.csv", "file_name", "h")
    land(tmp_path, "4.csv", "folder_name,file_name", "i,j")
    got = readers.read_csv(spark, str(tmp_path / "*.csv"), contracts.CONFIG_CSV)
    assert rows(got) == [(None, "h"), ("d", "f"), ("e", "g"), ("i", "j")]


def test_missing_path_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_csv(spark, str(tmp_path / "none/*.csv"), contracts.CONFIG_CSV)


def test_csv_ingest_runs_every_entry_and_reports(spark, tmp_path):
    for site in ("One", "Two"):
        for part in ("1.csv", "2.csv"):
            land(tmp_path / "landing/scans" / site, part, HEADER, SCAN_LINE)
    land(tmp_path, "config.csv", "folder_name,file_name", "scans,One", "scans,Two", "scans,Gone")
    entries = ingest.csv_entries(
        spark, str(tmp_path / "config.csv"), str(tmp_path / "landing"), str(tmp_path / "bronze"),
        files=1,
    )
    with pytest.raises(ingest.IngestError, match="scans/Gone") as caught:
        ingest.run(spark, entries)
    assert [(r[0], r[2], r[3]) for r in caught.value.report] == [
        ("scans/One", "ok", 2), ("scans/Two", "ok", 2), ("scans/Gone", "failed", None)
    ]
    report = ingest.run(spark, entries, raise_on_failure=False)
    assert report.filter("status = 'failed' AND message LIKE '%PATH_NOT_FOUND%'").count() == 1
    bronze = readers.read_scans(spark, str(tmp_path / "bronze/scans"))
    assert bronze.count() == 4
    assert len(list((tmp_path / "bronze/scans/One_raw.parquet").glob("*.snappy.parquet"))) == 1


def test_config_of_any_length_is_read(spark, tmp_path):
    names = [f"a,{i}" for i in range(10_001)]
    land(tmp_path, "config.csv", "folder_name,file_name", *names)
    entries = ingest.csv_entries(spark, str(tmp_path / "config.csv"), "landing", "bronze")
    assert sorted(e.name for e in entries) == sorted(str(i) for i in range(10_001))


def test_jdbc_ingest(spark, tmp_path):
    """In-process Derby, which only this driver process sees; hence a test and no query."""
    urls = {}

    def url_of(name):
        return urls.setdefault(name, f"jdbc:derby:memory:{name}_{uuid.uuid4().hex};create=true")

    options = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    source = spark.range(50).select(F.col("id").alias("ID"), (F.col("id") % 3 == 0).alias("FLAG"))
    source.write.format("jdbc").options(url=url_of("db"), dbtable="APP.TEAMS", **options).save()
    land(tmp_path, "config.csv", "database_name,datasource,schema_name,table_name,target_path",
         "db,teams,APP,TEAMS,competition")
    splits = {"TEAMS": readers.JdbcSplit("ID", "0", "50", 4)}
    for split in (None, splits):
        entries = ingest.sql_entries(
            spark, str(tmp_path / "config.csv"), url_of, str(tmp_path / "bronze"), split, **options
        )
        assert rows(ingest.run(spark, entries), "status", "n_rows") == [("ok", 50)]
        stored = readers.read_table(spark, str(tmp_path / "bronze/competition/TEAMS_raw.parquet"))
        assert dict(stored.dtypes)["FLAG"] == "boolean"
        assert rows(stored) == rows(source)
    assert entries[0].read().rdd.getNumPartitions() == 4


def test_writes_are_counted_and_reconciled(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.write_table(spark.range(7), path) == 7
    assert writers.append(spark.range(3), path) == 3
    assert writers.reconcile(spark.read.parquet(path), 10).count() == 10
    with pytest.raises(writers.CountMismatch):
        writers.reconcile(spark.read.parquet(path), 7)
    assert writers.write_table(spark.range(2), path) == 2
    assert writers.reconcile(readers.read_table(spark, path), 2).count() == 2
    assert writers.write_if_any(spark.range(0), str(tmp_path / "none")) == 0
    assert not (tmp_path / "none").exists()
    assert not (tmp_path / "none").exists()


def test_schema_merges_on_read(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_merging_schema(spark.range(1), path)
    writers.append(spark.range(1, 2).withColumn("more", F.lit("x")), path)
    assert rows(readers.read_table(spark, path, merge_schema=True)) == [(0, None), (1, "x")]


def test_partition_values_stay_text_and_prune(spark, tmp_path):
    path = str(tmp_path / "fact")
    df = spark.range(30).withColumn("scan_day", F.concat(F.lit("2025-12-"), F.col("id") % 3 + 21))
    writers.write_table(df, path, partition_by=["scan_day"])
    back = readers.read_table(spark, path, text_columns=["scan_day"])
    assert dict(back.dtypes)["scan_day"] == "string"
    assert rows(back, "id", "scan_day") == rows(df)
    assert rows(readers.read_table(spark, path, schema=df.schema)) == rows(df)
    one = back.filter("scan_day = '2025-12-22'")
    assert "PartitionFilters: [isnotnull(scan_day" in one._jdf.queryExecution().toString()
    newer = df.filter("scan_day = '2025-12-22'").withColumn("id", F.col("id") + 100)
    writers.replace_partitions(newer, path, ["scan_day"])
    again = readers.read_table(spark, path, text_columns=["scan_day"])
    assert again.count() == 30 and again.filter("id >= 100").count() == 10


def test_registered_tables(spark, tmp_path):
    database = f"db_{uuid.uuid4().hex[:8]}"
    spark.range(1).createOrReplaceTempView("not_a_table")
    plain, parts = str(tmp_path / "plain"), str(tmp_path / "parts")
    writers.write_table(spark.range(4), plain)
    writers.write_table(spark.range(6).withColumn("p", F.col("id") % 2), parts, partition_by=["p"])
    tables = {"plain": plain, "parts": parts}
    for _ in range(2):
        listed = writers.register_tables(
            spark, database, tables, location=str(tmp_path / "db"), partitioned=["parts"]
        )
    assert rows(listed, "tableName") == [("parts",), ("plain",)]
    assert spark.table(f"{database}.plain").count() == 4
    assert spark.table(f"{database}.parts").filter("p = 1").count() == 3
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_only_intermediate_datasets_can_be_removed(spark, tmp_path):
    path = scratch_path(spark, "gone")
    spark.range(1).write.parquet(path)
    assert remove_intermediate(spark, path)
    with pytest.raises(ValueError, match="not an intermediate"):
        remove_intermediate(spark, str(tmp_path))
    with pytest.raises(ValueError, match="not an intermediate"):
        remove_intermediate(spark, f"{work_folder(spark)}/../x")


def test_work_folder_follows_the_session(spark):
    assert work_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert materialize(spark.range(3), row_id="r").select("r").distinct().count() == 3


def test_literal_rows_and_preview(spark):
    df = readers.literal_rows(spark, [("b", "2"), ("a", "1")], contracts.CONFIG_CSV)
    assert [tuple(r) for r in readers.preview(df, 1).collect()] == [("a", "1")]


def test_full_run(spark, folder, tmp_path):
    source = Scenario(spark, folder)
    raw = {
        "scans": source.scans_with_copies(), "matches": source.matches(), "teams": source.teams(),
        "stadiums": source.stadiums(), "cities": source.cities(),
    }
    layout = full_run.Layout(str(tmp_path))
    work = Path(work_folder(spark).removeprefix("file:")) / "starloom"
    before = {p.name for p in work.iterdir()} if work.exists() else set()
    counts = full_run.run_all(spark, raw, layout)
    assert {p.name for p in work.iterdir()} == before
    assert sorted(p.name for p in tmp_path.iterdir()) == ["audit", "gold", "silver"]
    assert (counts["rows_in"], counts["rows_distinct"], counts["rows_accepted"]) == (6061, 6000, 2829)
    assert counts["fact_ticket_scan"] == counts["ticket_scans_clean"] == 2829
    star = full_run.read_star(spark, layout)
    for name, table in star.items():
        contracts.assert_contract(table, contracts.GOLD[name])
        assert table.count() == counts[name]
    audit = readers.read_table(spark, layout.path("audit", "rejected_scans"))
    assert audit.count() == counts["audit"] == 6000 - 2829 + 61
    assert rows(star["fact_ticket_scan"].agg(F.min("ticket_scan_key"), F.max("ticket_scan_key"))) == [(1, 2829)]
    quality = readers.read_table(spark, layout.path("silver", "scan_quality"))
    assert quality.count() == counts["scan_quality"] == 2829
    assert quality.columns == ["ticket_id", *silver_scans.QUALITY]
    policy = ScanPolicy(strict_lookups=True)
    raw["cities"] = raw["cities"].unionByName(raw["cities"])
    with pytest.raises(AmbiguousLookup):
        full_run.run_gold(spark, with_raw_dimensions(spark, raw, str(tmp_path / "strict")), policy=policy)


def with_raw_dimensions(spark, raw, base):
    """A layout whose silver layer is made from ``raw`` with one scan."""
    layout = full_run.Layout(base)
    full_run.run_dimensions(raw, layout)
    one = spark.createDataFrame([], contracts.TICKET_SCANS_CLEAN)
    writers.write_table(one, layout.path("silver", "ticket_scans_clean"))
    return layout


def test_intermediates_go_and_kept_ones_stay(spark):
    with removing_intermediates(spark):
        gone = materialize(spark.range(2), "gone")
        kept = materialize(gone, "kept", keep=True)
    assert kept.count() == 2
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        spark.read.parquet(gone.inputFiles()[0])


def test_landing_in_one_write_rescues_what_does_not_convert(spark, tmp_path):
    """Files of several headers, lines with too many fields, entries without files or rows."""
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    files = {
        "scans/a b+c/1.csv": "ticket_id,ticket_price_mad,scan_timestamp\nT1,5,2025-12-01 10:00:00\nT2,free,soon\n",
        "scans/a b+c/2.csv": "scan_timestamp,ticket_id,other\n2025-12-02 10:00:00,T3,x\n,T4,x,too many\nnever,T5\n",
        "scans/none/1.csv": "ticket_id,ticket_price_mad,scan_timestamp\n",
        "scans/unnamed/1.csv": "ticket_id\nT9\n",
    }
    for name, text in files.items():
        (landing / name).parent.mkdir(parents=True, exist_ok=True)
        (landing / name).write_text(text)
    config = tmp_path / "config.csv"
    config.write_text("folder_name,file_name\nscans,a b+c\nscans,none\nscans,missing\n")
    with pytest.raises(ingest.IngestError, match="scans/missing"):
        ingest.land_csv(spark, str(config), str(landing), bronze)
    report = ingest.land_csv(spark, str(config), str(landing), bronze, raise_on_failure=False)
    assert report.columns == ingest.REPORT.names
    assert rows(report, "entry", "status", "n_rows", "message") == [
        ("scans/a b+c", "ok", 5, "3 rows with rescued text"),
        ("scans/missing", "failed", None, "no file matches"),
        ("scans/none", "ok", 0, None),
    ]
    stored = readers.read_scans(spark, bronze)
    assert stored.schema == contracts.TICKET_SCANS
    assert rows(stored, "ticket_id") == [(f"T{i}",) for i in range(1, 6)]
    told = ingest.read_rescued(spark, bronze)
    assert rows(told, "ticket_id", "column", "value", "reason") == [
        ("T2", "scan_timestamp", "soon", "does not convert"),
        ("T2", "ticket_price_mad", "free", "does not convert"),
        ("T4", "_line", ",T4,x,too many", "number of fields"),
        ("T5", "_line", "never,T5", "number of fields"),
        ("T5", "scan_timestamp", "never", "does not convert"),
    ]
    assert {r.source_file.rsplit("/", 3)[-2] for r in told.collect()} == {"a b+c"}


def test_landing_jobs_do_not_grow_with_entries(spark, tmp_path):
    def jobs(entries):
        base = tmp_path / str(entries)
        for i in range(entries):
            folder = base / f"landing/scans/s{i}"
            folder.mkdir(parents=True)
            (folder / "1.csv").write_text(f"ticket_id\nT{i}\n")
        names = "".join(f"scans,s{i}\n" for i in range(entries))
        (base / "config.csv").write_text("folder_name,file_name\n" + names)
        group = f"landing-{entries}"
        spark.sparkContext.setJobGroup(group, group)
        ingest.land_csv(spark, str(base / "config.csv"), str(base / "landing"), str(base / "bronze"))
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few, many = jobs(2), jobs(12)
    assert many <= few + 2


def test_landing_lists_many_folders_in_few_tasks(spark, tmp_path):
    """Spark alone would list the files, and then the folders of bronze, with a task for each of them."""
    entries = readers.LISTING_TASKS + 16
    for i in range(entries):
        land(tmp_path / f"landing/scans/s{i}", "1.csv", "ticket_id", f"T{i}")
    land(tmp_path, "config.csv", "folder_name,file_name", *[f"scans,s{i}" for i in range(entries)])
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    ingest.land_csv(spark, str(tmp_path / "config.csv"), str(tmp_path / "landing"), str(tmp_path / "bronze"))
    assert readers.read_scans(spark, str(tmp_path / "bronze")).count() == entries
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    tasks = [info.numTasks for info in map(tracker.getStageInfo, stages) if info]
    assert max(tasks) <= max(readers.LISTING_TASKS, 4 * spark.sparkContext.defaultParallelism)
    assert spark.conf.get(name) == before


def test_landing_takes_the_files_of_a_folder_and_none_below(spark, tmp_path):
    """Folders are listed by tasks, whatever they are called, and files deeper or higher belong to no entry."""
    files = {"_h/1.csv": "T1", ".d/1.csv": "T2", "b/1.csv": "T3", "scans/b/1.csv": "no", "b/deep/1.csv": "no", "1.csv": "no",
             "b/1.txt": "no", "p=1/1.csv": "T4", "p=1/q=2/1.csv": "no"}
    for name, ticket in files.items():
        path = tmp_path / "landing/scans" / name
        land(path.parent, path.name, "ticket_id", ticket)
    land(tmp_path, "config.csv", "folder_name,file_name", *[f"scans,{n}" for n in ("_h", ".d", "b", "p=1", "deep", "scans")])
    report = ingest.land_csv(
        spark, str(tmp_path / "config.csv"), str(tmp_path / "landing"), str(tmp_path / "bronze"), raise_on_failure=False
    )
    assert rows(report, "entry", "n_rows") == [
        ("scans/.d", 1), ("scans/_h", 1), ("scans/b", 1), ("scans/deep", None), ("scans/p=1", 1), ("scans/scans", None)
    ]
    groups = readers.files_by_header(spark, [f"{tmp_path}/landing/scans/*"], "*.csv")
    assert len(groups) == 1 and sorted(f.rsplit("/", 2)[-2] for f in groups[0]) == [".d", "_h", "b", "p=1"]


@pytest.mark.parametrize("values", [3, 2 * writers.OPEN_FILES + 1])
def test_few_partitions_are_written_where_their_rows_are(spark, tmp_path, values):
    path = str(tmp_path / "few")
    made = spark.range(0, 400, numPartitions=4).selectExpr("id", f"IF(id % {values} = 0, NULL, concat('v', id % {values})) AS kind")
    assert writers.write_table(made, path, partition_by=["kind"], few=True) == 400
    assert rows(spark.read.parquet(path), "id", "kind") == rows(made)
    files = {f.name: len(list(f.glob("*.parquet"))) for f in Path(path).iterdir() if f.is_dir()}
    assert len(files) == values and set(files.values()) == {4}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_a_run_shuffles_neither_its_audit_nor_rejected_rows(spark, folder, tmp_path, monkeypatch):
    audits, labels, real, kept = [], [], full_run.write_table, silver_scans.materialize

    def note(df, path, **how):
        if path.endswith("rejected_scans"):
            audits.append(how)
        return real(df, path, **how)

    def noted(df, label="stage", **how):
        labels.append(label)
        return kept(df, label, **how)

    monkeypatch.setattr(full_run, "write_table", note)
    monkeypatch.setattr(silver_scans, "materialize", noted)
    source = Scenario(spark, folder)
    layout = full_run.Layout(str(tmp_path / "run"))
    raw = kept(source.scans_with_copies())
    counts = full_run.run_scans(raw, full_run.CLEANERS["matches"](source.matches()), layout)
    assert [a["few"] for a in audits] == [True] and "judged" in labels
    stored = spark.read.parquet(layout.path("audit", "rejected_scans"))
    wanted = silver_scans.audit_of(silver_scans.classify_scans(raw))
    columns = [c for c in contracts.AUDIT.names if c != "audit_date"]
    assert counts["audit"] == wanted.count() and rows(stored, *columns) == rows(wanted, *columns)


def test_landing_reads_the_files_of_its_entries_and_joins_no_rows(spark, tmp_path, monkeypatch):
    for site in ("s1", "s2", "s3"):
        land(tmp_path / f"landing/scans/{site}", "1.csv", "ticket_id", f"T-{site}")
        land(tmp_path / f"landing/scans/{site}", "2.csv", "fan_id,ticket_id", f"F,U-{site}")
    land(tmp_path, "config.csv", "folder_name,file_name", "scans,s1", "scans,s3", "scans,s1")
    read, plans, real, written = [], [], readers.read_csv, ingest.write_table

    def note(session, paths, schema, **how):
        read.extend(f for group in how.get("by_header") or [] for f in group)
        return real(session, paths, schema, **how)

    def noted(df, path, **how):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return written(df, path, **how)

    monkeypatch.setattr(readers, "read_csv", note)
    monkeypatch.setattr(ingest, "write_table", noted)
    report = ingest.land_csv(spark, str(tmp_path / "config.csv"), str(tmp_path / "landing"), str(tmp_path / "bronze"))
    assert rows(report, "entry", "n_rows") == [("scans/s1", 2), ("scans/s3", 2)]
    assert sorted(f.rsplit("/", 2)[1] for f in read) == ["s1", "s1", "s3", "s3"]
    assert len(plans) == 1 and "Join" not in plans[0]
    stored = readers.read_scans(spark, str(tmp_path / "bronze"))
    assert rows(stored, "ticket_id") == [("T-s1",), ("T-s3",), ("U-s1",), ("U-s3",)]
    none = tmp_path / "none"
    land(none, "config.csv", "folder_name,file_name", "scans,s9")
    report = ingest.land_csv(
        spark, str(none / "config.csv"), str(tmp_path / "landing"), str(none / "bronze"), raise_on_failure=False
    )
    assert rows(report, "entry", "status", "n_rows") == [("scans/s9", "failed", None)]
