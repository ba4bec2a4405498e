import json

import pytest
from pyspark.sql import functions as F

from rasterprep.operators import runs as RU
from rasterprep.plans import report as RP
from rasterprep.sources import metadata as M


def _profile(steps, **summary):
    return {"start_time": "2026-01-30T10:00:00", "end_time": "2026-01-30T10:10:00",
            "steps": [{"name": n, "duration": d, "timestamp": "2026-01-30T10:00:01"} for n, d in steps],
            "summary": summary, "logs": [{"timestamp": "2026-01-30T10:00:00", "message": "start",
                                          "usage": {"cpu_percent": 1.0, "ram_percent": 2.0, "ram_used_gb": 0.5}}]}


CONV = ["read_metadata", "spark_init", "write_train", "write_validation", "write_test"]


def _write(root, rel, doc):
    p = root / rel
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(json.dumps(doc, indent=2))


@pytest.fixture()
def profiles_root(tmp_path):
    root = tmp_path / "bucket"
    for ex, t in [(1, 100.0), (2, 55.0), (8, 20.0)]:
        _write(root, f"u/d/exp/petastorm/frac_0.05/exec_{ex}/profile/conversion_profile.json",
               _profile([(s, t / 5) for s in CONV], total_duration=t, train_samples=10, train_rdd_partitions=4))
    # duplicate step name: last one wins
    _write(root, "u/d/exp/petastorm/frac_0.1/exec_1/profile/conversion_profile.json",
           _profile([(s, 1.0) for s in CONV] + [("write_test", 9.0)], total_duration=14.0))
    # bad cases: no frac_, fraction below floor, no exec_, missing step
    _write(root, "u/d/exp/petastorm/nofrac/exec_1/profile/conversion_profile.json",
           _profile([(s, 1.0) for s in CONV], total_duration=5.0))
    _write(root, "u/d/exp/petastorm/frac_0.0005/exec_1/profile/conversion_profile.json",
           _profile([(s, 1.0) for s in CONV], total_duration=5.0))
    _write(root, "u/d/exp/petastorm/frac_0.2/noexec/profile/conversion_profile.json",
           _profile([(s, 1.0) for s in CONV], total_duration=5.0))
    _write(root, "u/d/exp/petastorm/frac_0.2/exec_2/profile/conversion_profile.json",
           _profile([(s, 1.0) for s in CONV[:-1]], total_duration=5.0))
    # training runs
    for g, t in [(1, 80.0), (2, 40.0), (4, 0.0)]:
        _write(root, f"u/d/exp/petastorm/frac_0.05/exec_8/train_gpu{g}_profile.json",
               _profile([("training", t), ("evaluation", 2.0)], total_duration=t + 2, global_batch_size=16 * g,
                        learning_rate=0.001 * g, test_accuracy=0.5))
    _write(root, "u/d/exp/petastorm/frac_0.05/exec_5/train_gpu1_profile.json",
           _profile([("training", 1.0), ("evaluation", 1.0)], total_duration=2.0))
    _write(root, "u/d/exp/local/frac_0.05/gpu3_profile.json",
           _profile([("training", 1.0)], total_duration=2.0))
    return str(root)


def test_conversion_runs(spark, profiles_root):
    runs = RP.load_runs(spark, profiles_root, "conversion")
    got = {(r.fraction, r.executor): r for r in runs.collect()}
    assert set(got) == {(0.05, 1), (0.05, 2), (0.05, 8), (0.1, 1)}
    assert got[(0.1, 1)].write_test == 9.0
    assert got[(0.05, 8)].total_time == 20.0


def test_report_speedup_and_curves(spark, profiles_root):
    runs, curves, ideal = RP.experiment_report(spark, profiles_root, "conversion")
    sp = {(r.fraction, r.executor): r.speedup for r in runs.collect()}
    assert sp[(0.05, 1)] == 1.0 and sp[(0.05, 2)] == pytest.approx(100 / 55) and sp[(0.05, 8)] == 5.0
    assert [r.x for r in ideal.orderBy("x").collect()] == [1, 2, 3, 4, 5, 6, 7, 8]
    assert curves.where("fraction = 0.05").count() == 3


def test_training_parsers(spark, profiles_root):
    batch = RP.load_runs(spark, profiles_root, "training_batch")
    got = {r.num_gpus: r for r in batch.collect()}
    assert set(got) == {1, 2, 4} and got[2].batch_size == 32
    sp = {r.num_gpus: r.speedup for r in RU.speedup(batch, "num_gpus", 1, "total_time").collect()}
    assert sp[1] == 1.0 and sp[2] == pytest.approx(82 / 42)
    lr = RP.load_runs(spark, profiles_root, "training_lr")
    # the local run lacks an evaluation step and is dropped
    assert sorted(r.num_gpus for r in lr.collect()) == [1, 1, 2, 4]


def test_speedup_edge_cases(spark):
    runs = spark.createDataFrame([(0.1, 1, 10.0), (0.1, 2, 0.0), (0.2, 2, 5.0)],
                                 "fraction double, executor int, total_time double")
    got = {(r.fraction, r.executor): r.speedup for r in RU.speedup(runs, "executor", 1).collect()}
    assert got[(0.1, 1)] == 1.0 and got[(0.1, 2)] is None and got[(0.2, 2)] is None
    win = {(r.fraction, r.executor): r.speedup for r in RU.speedup_window(runs, "executor", 1).collect()}
    assert win == got
    dup = runs.unionByName(spark.createDataFrame([(0.1, 1, 12.0)], runs.schema))
    with pytest.raises(Exception, match="duplicate baseline"):
        RU.speedup(dup, "executor", 1).collect()


def test_step_expressions(spark, profiles_root):
    prof = M.read_profiles(spark, profiles_root, suffix="conversion_profile.json")
    rows = prof.select(RU.total_duration("steps").alias("t"), RU.step_duration("steps", "write_test").alias("w"),
                       RU.has_steps("steps", ["write_test"]).alias("h")).collect()
    assert any(r.w == 9.0 and r.t == 14.0 for r in rows)
    logs = M.profile_logs(prof)
    assert logs.where(F.col("message") == "start").count() == prof.count()


def test_last_value_relational(spark):
    df = spark.createDataFrame([(1, "a", 1.0, 1), (1, "a", 2.0, 2), (1, "b", 3.0, 1)], "u int, n string, v double, o int")
    got = {(r.u, r.n): r.v for r in RU.last_value(df, ["u", "n"], "v", ["o"]).collect()}
    assert got == {(1, "a"): 2.0, (1, "b"): 3.0}


def test_time_helpers(spark):
    from rasterprep.functions import times as TM
    df = spark.createDataFrame([("2026-01-30T10:00:01.250000",), ("2026-01-30 10:00:02",), ("junk",)], "t string")
    rows = df.select(TM.parse_time("t").alias("ts")).select(
        TM.iso_time("ts").alias("iso"), TM.log_time("ts").alias("log")).collect()
    assert rows[0].iso == "2026-01-30T10:00:01.250000" and rows[1].iso == "2026-01-30T10:00:02"
    assert rows[1].log == "2026-01-30 10:00:02" and rows[2].iso is None


def test_record_filters_and_custom_parser(spark, profiles_root):
    df = spark.createDataFrame([(0.0005, 1), (0.01, None), (0.01, 2), (None, None)], "fraction double, executor int")
    assert RU.run_record_filter(df).count() == 1
    assert RU.drop_null_records(df).count() == 3
    parser = lambda p: p.select(F.col("key"), RU.total_duration("steps").alias("t"))
    runs = RP.load_runs(spark, profiles_root, "custom", parser=parser, suffix="_profile.json")
    assert runs.count() == 13
    # the notebook variant reads the fraction from a fixed key part (bucket-relative there)
    idx = len((profiles_root.lstrip("/") + "/u/d/exp/petastorm/frac_x").split("/")) - 1
    ext = RP.load_runs(spark, profiles_root, "conversion_ext",
                       parser=lambda p: RU.conversion_runs_ext(p, part_index=idx))
    got = {r.fraction: r for r in ext.collect()}
    # C3 needs no exec_ part, so the frac_0.2/noexec run is kept
    assert set(got) == {0.05, 0.1, 0.2} and got[0.05].train_partitions == 4


def test_malformed_profile_is_dropped(spark, profiles_root):
    import os
    bad = os.path.join(profiles_root, "u/d/exp/petastorm/frac_0.3/exec_1/profile/conversion_profile.json")
    os.makedirs(os.path.dirname(bad), exist_ok=True)
    with open(bad, "w") as f:
        f.write("{ not json")
    runs = RP.load_runs(spark, profiles_root, "conversion")
    assert 0.3 not in {r.fraction for r in runs.collect()}


def test_speedup_window_refuses_a_duplicate_baseline(spark):
    from rasterprep.operators import runs as RU
    runs = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 3.0), ("a", 2, 1.0)], "fraction string, n int, total_time double")
    with pytest.raises(Exception, match="duplicate baseline"):
        RU.speedup_window(runs, "n", 1).collect()


def test_nested_steps_count_once_at_the_top(spark):
    from rasterprep.operators import runs as RU
    df = spark.createDataFrame(
        [([("outer", 10.0, "2024-01-01T00:00:00"), ("inner", 4.0, "2024-01-01T00:00:01"),
           ("after", 2.0, "2024-01-01T00:00:10")],)],
        "steps array<struct<name string, duration double, timestamp string>>")
    r = df.select(RU.total_duration("steps").alias("all"), RU.top_level_duration("steps").alias("top")).first()
    assert (r["all"], r["top"]) == (16.0, 12.0)
