import subprocess
import sys

import pytest
from arrears.plans import stages
from arrears.sources import sinks, staging, tables, tpch

from tests.conftest import ROOT, SMALL


def test_csv_columns_follow_the_header(spark, folder):
    path = f"{folder}/bureau_balance.csv"
    with open(path, "w") as f:
        f.write("STATUS,EXTRA,MONTHS_BALANCE,SK_ID_BUREAU\nC,zzz,-3,7\nX,,-1,8\n")
    rows = tables.read_csv(spark, path, "bureau_balance").orderBy("SK_ID_BUREAU").collect()
    assert [tuple(r) for r in rows] == [(7, -3, "C"), (8, -1, "X")]


def test_csv_without_a_needed_column_is_refused(spark, folder):
    path = f"{folder}/bureau_balance.csv"
    with open(path, "w") as f:
        f.write("STATUS,MONTHS_BALANCE\nC,-3\n")
    with pytest.raises(ValueError, match="SK_ID_BUREAU"):
        tables.read_csv(spark, path, "bureau_balance")


def test_csv_files_must_share_the_header(spark, folder):
    import os

    path = f"{folder}/bureau_balance.csv"
    os.mkdir(path)
    for name, lines in {"a": "SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n7,-3,C\n", "b": "SK_ID_BUREAU,STATUS,MONTHS_BALANCE\n8,2,-5\n"}.items():
        with open(f"{path}/{name}.csv", "w") as f:
            f.write(lines)
    with pytest.raises(Exception, match="CSV header"):
        tables.read_csv(spark, path, "bureau_balance").collect()


def test_csv_cell_of_another_type_is_refused(spark, folder):
    path = f"{folder}/bureau_balance.csv"
    with open(path, "w") as f:
        f.write("SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n7,-3,C\n8,oops,0\n")
    with pytest.raises(Exception, match="MALFORMED"):
        tables.read_csv(spark, path, "bureau_balance").collect()


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 0.5)], "a int, b double")
    assert [r.b for r in tables.nan_to_null(df).orderBy("a").collect()] == [None, 0.5]


def test_all_tables_from_a_folder(spark, folder):
    raw = tpch.tables(spark, SMALL)
    for name, stem in tables.FILES.items():
        sinks.export_csv(raw[name], folder, stem)
    read = tables.read_tables(spark, folder)
    for name in tables.SCHEMAS:
        assert read[name].dtypes == [(c, t) for c, t in tables.SCHEMAS[name].items()]
        assert spark.table(name).count() == raw[name].count()
    ok = {r.table_name: r.ok for r in tables.input_contract(read, {"bureau": 1}).collect()}
    assert ok["application"] and not ok["bureau"]
    with pytest.raises(ValueError, match="missing tables"):
        tables.input_contract({"application": read["application"]})


def test_staging_uses_the_named_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    staged = staging.stage(spark.range(5).toDF("id"))
    assert staged.count() == 5
    assert root.removeprefix("file:") in staged.inputFiles()[0]


def test_a_scope_removes_what_was_staged_inside(spark):
    import os

    place = lambda df: os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    outside = staging.stage(spark.range(3).toDF("id"))
    with staging.scope(spark):
        inside = place(staging.stage(spark.range(4).toDF("id")))
        kept = staging.keep(spark.range(5).toDF("id"))
        assert os.path.exists(inside)
    assert not os.path.exists(inside)
    assert outside.count() == 3 and kept.count() == 5


def test_pipeline_stage_by_stage(spark, folder):
    run = stages.Run(
        spark, folder, tpch.tables(spark, SMALL), trees={"maxIter": 2}, warning_trees={"maxIter": 2}, capacity=20
    )
    saved = stages.run_stages(run, only=1)
    assert run.load("feature_store").count() == 150
    saved |= stages.run_stages(run, start=2)
    assert sorted(saved) == [1, 2, 3, 4, 5, 6, 7]
    for names in saved.values():
        for name in names:
            assert run.load(name).columns
    assert run.load("priority_list").count() == 150
    assert run.load("policy_metrics").count() == 3
    without_raw = stages.Run(spark, folder, warning_trees={"maxIter": 2})
    with pytest.raises(ValueError, match="raw tables"):
        stages.run_stages(without_raw, only=4)
    assert {r.features_from for r in run.load("lead_time_results").collect()} == {"raw"}
    without_raw.lead_time_from = "masked"
    stages.run_stages(without_raw, only=4)
    assert {r.features_from for r in run.load("lead_time_results").collect()} == {"masked"}
    assert run.load("lead_time_results").count() == 5


def test_tasks_need_no_installed_package(tmp_path):
    """Python functions reach the workers even when the driver runs from another folder."""
    code = (
        "import sys; sys.path[:0] = [%r, %r]\n"
        "from compare import local_session\n"
        "import __spark_entry__ as contract\n"
        "spark = local_session(2)\n"
        "print(contract.queries()['optimal_bins'](spark, %r).count())\n"
    ) % (ROOT, f"{ROOT}/tools", SMALL)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split()[-1]) > 0
