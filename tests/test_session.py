"""Queries from another folder, in a session without any settings of ours."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_workers_find_the_package_and_stages_their_folder(tmp_path):
    code = textwrap.dedent(f"""
        import importlib.util, sys
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
        spec = importlib.util.spec_from_file_location("entry", {REPO!r} + "/__spark_entry__.py")
        entry = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(entry)
        for name in ("m6_extra_trees", "k6_chrono_split"):
            assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
        print("both ran")
    """)
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_CONF_DIR")}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "both ran" in done.stdout, done.stderr[-3000:]


def test_operators_build_plans_without_running_jobs(spark, sf_dir):
    import __spark_entry__ as entry

    tracker = spark.sparkContext.statusTracker()
    for name in ("c8_clean_rows", "t6_temporal", "g6_spatial", "f1_features", "d2_hourly_grid", "w4_demand_dataset", "q2_durations", "q13_insight"):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        entry.queries()[name](spark, sf_dir)
        # Only the schema of the table is read, once for the trips and once for what is derived from them.
        assert len(tracker.getJobIdsForGroup(f"build-{name}")) <= 2, name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
