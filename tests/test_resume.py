import pytest
from arrears.plans import stages
from arrears.sources import tables


class Broken(Exception):
    pass


@pytest.fixture
def setting(spark, folder):
    """A run of three small stages that tells which of them ran, and can break off."""
    ran, breaks = [], set()
    spark.range(5).write.parquet(f"{folder}/raw/a")
    raw = {"a": spark.read.parquet(f"{folder}/raw/a")}

    def one(run):
        ran.append(1)
        run.save(run.raw()["a"].selectExpr("id", "id * 2 AS x"), "doubled")
        if 1 in breaks:
            raise Broken
        run.save(run.load("doubled").selectExpr("sum(x) AS s"), "summed")
        return ["doubled", "summed"]

    def two(run):
        ran.append(2)
        doubled = run.load("doubled")
        run.save(doubled.where(f"x >= {run.capacity}"), "large")
        if 2 in breaks:
            raise Broken
        run.save(doubled.where(f"x < {run.capacity}"), "small")
        return ["large", "small"]

    def three(run):
        ran.append(3)
        run.save(run.load("summed"), "copied")
        return ["copied"]

    run = stages.Run(spark, f"{folder}/out", raw, capacity=4)
    return run, {1: one, 2: two, 3: three}, ran, breaks


@pytest.fixture(autouse=True)
def capacity_counts_for_the_second(monkeypatch):
    monkeypatch.setattr(stages, "SETTINGS", {2: ("capacity",)})


def values(run, name):
    return sorted(r[0] for r in run.load(name).collect())


def test_a_finished_run_needs_nothing(setting):
    run, steps, ran, _ = setting
    assert list(stages.run_stages(run, stages=steps)) == [1, 2, 3]
    assert stages.run_stages(run, resume=True, stages=steps) == {}
    assert ran == [1, 2, 3] and values(run, "large") == [2, 3, 4]


def test_a_stage_that_broke_off_is_done_again(setting):
    run, steps, ran, breaks = setting
    breaks.add(2)
    with pytest.raises(Broken):
        stages.run_stages(run, stages=steps)
    with pytest.raises(ValueError, match="stage 2 has not finished"):
        stages.run_stages(run, start=3, stages=steps)
    breaks.clear()
    assert list(stages.run_stages(run, resume=True, stages=steps)) == [2, 3]
    assert ran == [1, 2, 2, 3] and values(run, "small") == [0, 1]


def test_results_of_the_last_run_stand_until_the_next_is_whole(spark, setting):
    """A torn second run leaves the first one's tables, all of them."""
    run, steps, _, breaks = setting
    stages.run_stages(run, stages=steps)
    run.tables = {"a": spark.range(100).toDF("id")}
    breaks.add(1)
    with pytest.raises(Broken):
        stages.run_stages(run, stages=steps)
    assert values(run, "doubled") == [0, 1, 2, 3, 4] and values(run, "summed") == [20]


def test_changed_files_and_what_hangs_on_them_are_done_again(spark, setting, folder):
    run, steps, _, _ = setting
    stages.run_stages(run, stages=steps)
    spark.range(5, 7).write.mode("append").parquet(f"{folder}/raw/a")
    run.tables = {"a": spark.read.parquet(f"{folder}/raw/a")}
    with pytest.raises(ValueError, match="stage 1 read other raw tables"):
        stages.run_stages(run, start=2, stages=steps)
    assert list(stages.run_stages(run, resume=True, stages=steps)) == [1, 2, 3]
    assert values(run, "copied") == [42]


def test_changed_settings_touch_their_stage_only(setting):
    run, steps, _, _ = setting
    stages.run_stages(run, stages=steps)
    run.capacity = 6
    assert list(stages.run_stages(run, resume=True, stages=steps)) == [2]
    assert values(run, "large") == [3, 4]


def test_a_rerun_stage_outdates_its_readers(setting):
    run, steps, _, _ = setting
    stages.run_stages(run, stages=steps)
    stages.run_stages(run, only=1, stages=steps)
    with pytest.raises(ValueError, match="stage 2 read doubled before the present version"):
        stages.run_stages(run, start=3, stages=steps)
    assert list(stages.run_stages(run, resume=True, stages=steps)) == [2, 3]


def test_tables_without_files_are_known_by_their_rows(spark, folder):
    schema = ", ".join(f"{c} {t}" for c, t in tables.SCHEMAS["application"].items())
    empty = spark.createDataFrame([], schema)
    frames = [empty, spark.range(3).toDF("id"), spark.range(4).toDF("id")]
    states = [stages.raw_state({"t": f})["t"] for f in frames]
    assert len(set(states)) == 3
    assert states[1] == stages.raw_state({"t": spark.range(3).toDF("id").repartition(2)})["t"]
