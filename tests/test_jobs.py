"""Jobs end to end: order, replacement, repeatability, folders."""

from __future__ import annotations

import hashlib
import os
import sys
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from inspectstar import schema as names
from inspectstar.__main__ import JOBS, main
from inspectstar.operators import Limits, numbering
from inspectstar.plans import jobs
from inspectstar.plans.dimensions import SPECS
from inspectstar.plans.driver_stage import derive_stage
from inspectstar.queries import QUERIES
from inspectstar.scratch import Scratch, shared_folder
from inspectstar.sinks import write_stage
from inspectstar.sources import read_stage, read_table
from tests.conftest import TESTDATA, tuples


def _tables(spark, root):
    bases = dict.fromkeys(SPECS, f"{root}/dims")
    bases |= {names.INSPECTIONS: f"{root}/facts", names.VIOLATIONS: f"{root}/facts"}
    return {t: read_table(spark, b, t).drop(*names.AUDIT_COLUMNS) for t, b in bases.items()}


def test_records_to_facts_and_rerun(spark, small_stage, tmp_path):
    records, stage = f"{tmp_path}/records", f"{tmp_path}/stage"
    small_stage.write.json(records)
    counts = [
        {
            r.table_name: r.row_count
            for r in jobs.run(
                spark, records, stage, f"{tmp_path}/dims", f"{tmp_path}/facts", partitions=2
            ).collect()
        }
        for _ in range(2)
    ]
    assert counts[0] == counts[1]
    assert counts[0][names.VIOLATIONS] == 19_878
    assert len([f for f in os.listdir(stage) if f.endswith(".parquet")]) == 2
    assert sorted(read_stage(spark, stage).columns) == sorted(names.STAGE_COLUMNS)


def test_output_does_not_depend_on_partitions(spark, small_stage, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for count in (3, 29):
            spark.conf.set("spark.sql.shuffle.partitions", count)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            root = f"{tmp_path}/{count}"
            stage = small_stage.repartition(count)
            jobs.build_all(spark, stage, f"{root}/dims", f"{root}/facts")
            results.append(_tables(spark, root))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for table in results[0]:
        one, other = results[0][table], results[1][table]
        assert one.count() == other.count()
        assert one.exceptAll(other.select(*one.columns)).isEmpty(), table


def test_keys_are_dense_and_facts_refer_to_members(spark, small_stage, tmp_path):
    jobs.build_all(spark, small_stage, f"{tmp_path}/dims", f"{tmp_path}/facts")
    tables = _tables(spark, tmp_path)
    keys = {spec.table: spec.key for spec in SPECS.values()}
    keys |= {names.INSPECTIONS: "INSPECTION_SK", names.VIOLATIONS: "INSPECTION_VIOLATION_SK"}
    for table, key in keys.items():
        low, high, rows, distinct = (
            tables[table]
            .agg(F.min(key), F.max(key), F.count(key), F.count_distinct(key))
            .first()
        )
        assert (low, high, distinct) == (1, rows, rows), table
    for fact in (names.INSPECTIONS, names.VIOLATIONS):
        for table, key in keys.items():
            if table != fact and key in tables[fact].columns:
                orphans = tables[fact].join(tables[table], key, "left_anti")
                assert orphans.isEmpty(), (fact, key)


def test_bigint_build(spark, small_stage, tmp_path):
    options = jobs.BuildOptions(key_type="bigint")
    jobs.build_all(spark, small_stage, f"{tmp_path}/dims", f"{tmp_path}/facts", options)
    violations = _tables(spark, tmp_path)[names.VIOLATIONS]
    assert violations.count() == 19_878
    assert dict(violations.dtypes)["INSPECTION_VIOLATION_SK"] == "bigint"


def test_jobs_leave_no_scratch_behind(spark, small_stage, tmp_path):
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    jobs.write_dimensions(spark, small_stage, str(tmp_path), tables=[names.BOROUGH])
    assert set(os.listdir(folder)) <= before


def test_shared_folder_follows_the_session(spark):
    def session(folder=None, checkpoint_dir=None, master="yarn"):
        """Just enough of a session to ask for its shared folder."""
        real = spark.sparkContext
        context = SimpleNamespace(
            master=master, getCheckpointDir=lambda: checkpoint_dir, _jsc=real._jsc, _jvm=real._jvm
        )
        settings = {} if folder is None else {"spark.checkpoint.dir": folder}
        return SimpleNamespace(conf=settings, sparkContext=context)

    assert shared_folder(session("hdfs:/shared/")) == "hdfs:/shared"
    assert shared_folder(session(None, "hdfs:/set-by-context")) == "hdfs:/set-by-context"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session())  # the default file system is a local one
    assert shared_folder(session(master="local[2]")) == "file:/tmp/inspectstar"


def test_scratch_folder_lives_as_long_as_its_block(spark):
    with Scratch(spark) as scratch:
        scratch.keep(spark.range(3), "numbers")
        assert scratch.root.startswith(shared_folder(spark))
        assert os.path.isdir(scratch.root.removeprefix("file:"))
    assert not os.path.exists(scratch.root.removeprefix("file:"))


def test_failed_dimension_fails_the_job(spark, small_stage, tmp_path):
    with pytest.raises(Exception, match="cuisine_description"):
        jobs.write_dimensions(spark, small_stage.drop("cuisine_description"), str(tmp_path))


def test_files_follow_the_output_not_the_cluster(spark, small_stage, tmp_path):
    """The number of join tasks, hence of files, is that of the rows."""
    dims, facts = f"{tmp_path}/dims", f"{tmp_path}/facts"
    jobs.write_dimensions(spark, small_stage, dims)
    files = []
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    for count in (partitions, "400"):
        spark.conf.set("spark.sql.shuffle.partitions", count)
        for limit in (1_000_000, 10_000):
            options = jobs.BuildOptions(Limits(pairs_per_task=limit))
            jobs.write_inspections(spark, small_stage, dims, facts, options)
            jobs.write_violations(spark, small_stage, dims, facts, options)
            folder = f"{facts}/{names.VIOLATIONS}"
            files.append(sum(f.endswith(".parquet") for _, _, x in os.walk(folder) for f in x))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert files[:2] == files[2:]
    assert max(files) <= 5 * 4  # five boroughs, 19,878 pairs


def test_int_keys_fail_before_the_old_table_goes(spark, small_stage, tmp_path, monkeypatch):
    dims, facts = f"{tmp_path}/dims", f"{tmp_path}/facts"
    jobs.build_all(spark, small_stage, dims, facts)
    monkeypatch.setattr(numbering, "MOST_INT_KEYS", 10_000)
    with pytest.raises(ValueError, match="bigint"):
        jobs.write_violations(spark, small_stage, dims, facts)
    monkeypatch.setattr(numbering, "MOST_INT_KEYS", 1_000)
    with pytest.raises(ValueError, match="bigint"):
        jobs.write_inspections(spark, small_stage, dims, facts)
    assert read_table(spark, facts, names.VIOLATIONS).count() == 19_878
    assert read_table(spark, facts, names.INSPECTIONS).count() == 4_180


def test_summaries_notice_a_shifted_key(spark, small_stage, tmp_path):
    jobs.write_dimensions(spark, small_stage, str(tmp_path), tables=[names.ACTIONS])
    table = read_table(spark, str(tmp_path), names.ACTIONS)
    sums = jobs._summary(table, "t").first()
    shifted = jobs._summary(table.withColumn("ACTION_SK", F.col("ACTION_SK") + 1), "t").first()
    assert sums.row_count == shifted.row_count
    assert sums.key_sum != shifted.key_sum and sums.key_text_sum != shifted.key_text_sum


def test_summaries_notice_swapped_values(spark):
    """Texts of equal length, or second keys, that change rows; the order of rows is nothing."""
    schema = "A_SK int, B_SK int, T string"
    rows = [(1, 5, "abc"), (2, 6, "xyz"), (3, None, None)]
    found = {}
    for name, changed in {
        "same": rows[::-1],
        "texts": [(1, 5, "xyz"), (2, 6, "abc"), rows[2]],
        "keys": [(1, 6, "abc"), (2, 5, "xyz"), rows[2]],
        "null": [rows[0], rows[1], (3, None, "")],
    }.items():
        found[name] = jobs._summary(spark.createDataFrame(changed, schema), "t").first()
    want = jobs._summary(spark.createDataFrame(rows, schema), "t").first()
    assert found["same"] == want
    for name in ("texts", "keys", "null"):
        assert found[name].row_sum != want.row_sum
        assert (found[name].key_sum, found[name].key_text_sum) == (want.key_sum, want.key_text_sum)


def test_summaries_are_exact_and_sum_longs(spark):
    """Keys near 2^62 and long texts against plain arithmetic; no decimal a row."""
    texts = ["x" * 12_345, "ä" * 99, "", None, "y" * 100]
    rows = [(2**62 - i, 7 * i, t) for i, t in enumerate(texts)] + [(None, None, "z")]
    df = spark.createDataFrame(rows, "A_SK bigint, B_SK int, T string")
    summary = jobs._summary(df, "t")

    def digest(row):
        read = [None if v is None else str(v).encode() for v in row]
        entries = b"".join(b"-" if v is None else b"%d:%s" % (len(v), v) for v in read)
        return int(hashlib.md5(entries).hexdigest()[:12], 16)

    size = [len((r[2] or "").encode()) for r in rows]
    assert summary.first().asDict() == {
        "table_name": "t",
        "row_count": 6,
        "key_sum": sum((r[0] or 0) + (r[1] or 0) for r in rows) % jobs.SUMMARY_MODULUS,
        "key_text_sum": sum((r[0] or 0) * n for r, n in zip(rows, size)) % jobs.SUMMARY_MODULUS,
        "row_sum": sum(map(digest, rows)) % jobs.SUMMARY_MODULUS,
    }
    # Decimals a row took most of the job's time on large tables.
    plan = summary._jdf.queryExecution().executedPlan().toString()
    sums = [line for line in plan.splitlines() if "partial_sum" in line]
    assert sums and not any("decimal" in line for line in sums)


@pytest.mark.parametrize("one_by_one", [False, True])
def test_command_line(spark, small_stage, tmp_path, monkeypatch, one_by_one):
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    small_stage.limit(200).write.json(f"{tmp_path}/records")
    for job in ("stage", "dimensions", "inspections", "violations") if one_by_one else ("all",):
        arguments = [a for p in JOBS[job] for a in (f"--{p}", f"{tmp_path}/{p}")]
        monkeypatch.setattr(sys, "argv", ["inspectstar", job, *arguments])
        main()
    facts = f"{tmp_path}/facts"
    assert read_table(spark, facts, names.INSPECTIONS).count() > 100
    assert read_table(spark, facts, names.VIOLATIONS).count() > 100


def test_violations_beyond_int_keys(spark, monkeypatch):
    """Numbers widen where an int cannot hold them; the tables keep every row."""
    sf_dir = f"{TESTDATA}/sf0.001"
    want = QUERIES["fact_violations"](spark, sf_dir)
    assert dict(want.dtypes)["INSPECTION_VIOLATION_SK"] == "int"
    want = tuples(want)
    monkeypatch.setattr(numbering, "MOST_INT_KEYS", 10_000)
    for name in ("fact_violations", "job_violations"):
        got = QUERIES[name](spark, sf_dir)
        assert dict(got.dtypes)["INSPECTION_VIOLATION_SK"] == "bigint"
        assert tuples(got.select(*names.VIOLATION_COLUMNS, *names.AUDIT_COLUMNS)) == want
    summary = QUERIES["job_full_build"](spark, sf_dir).where(F.col("table_name") == names.VIOLATIONS)
    assert summary.first().row_count == len(want)


def test_ingested_records_are_compressed_and_bounded(spark, monkeypatch):
    monkeypatch.setattr("inspectstar.sinks.tables.RECORDS_PER_FILE", 1_000, raising=False)
    got = QUERIES["src_json_ingest"](spark, f"{TESTDATA}/sf0.001")
    files = got.inputFiles()
    assert all(f.endswith(".json.gz") for f in files)
    assert len(files) >= 6 and got.count() == 6_000


def test_staging_is_dealt_to_files_by_its_rows(spark, monkeypatch):
    monkeypatch.setattr("inspectstar.queries.ROWS_PER_FILE", 300, raising=False)
    got = QUERIES["sink_repartition"](spark, f"{TESTDATA}/sf0.001")
    assert len(got.inputFiles()) == max(20, spark.sparkContext.defaultParallelism)
    assert got.count() == 6_000


def test_visits_stay_together_in_staging_files(spark, tmp_path):
    """Rows of a visit share a file; those without a place are dealt to all."""
    visits = spark.range(2000).selectExpr(
        "cast(id % 400 as string) AS camis", "'2024-01-01' AS inspection_date", "cast(id as string) AS score"
    )
    nowhere = visits.withColumn("camis", F.lit(None).cast("string")).limit(600)
    write_stage(visits.unionAll(nowhere), f"{tmp_path}/stage", 8)
    rows = spark.read.parquet(f"{tmp_path}/stage").withColumn("file", F.input_file_name())
    files = dict(rows.groupBy("camis").agg(F.count_distinct("file")).collect())
    assert files.pop(None) == 8 and len(files) == 400 and set(files.values()) == {1}
    assert rows.count() == 2600


def test_line_items_are_shuffled_once_less(spark):
    """Places meet the orders, not the line items."""
    plan = derive_stage(spark, f"{TESTDATA}/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    depth = {key: next(j.index("Join") for j in joins if key in j) for key in ("o_custkey", "l_orderkey")}
    assert depth["o_custkey"] > depth["l_orderkey"]
