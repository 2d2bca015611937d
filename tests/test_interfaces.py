"""CLI, SQL views and the catalog MERGE path."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from hitsessions import cli
from hitsessions.operators import upsert as U
from hitsessions.operators.first_touch import first_touch_sessions
from hitsessions.plans.sql_views import register_session_views
from hitsessions.session import new_work_path
from hitsessions.sources import export as X
from hitsessions.sources.lens import lens_events, lens_export
from tests.conftest import SF_SMALL


def test_sql_views(spark):
    ev = lens_export(spark, SF_SMALL)
    names = register_session_views(spark, ev, "2024-01-01", "2024-01-31")
    assert "model1_sessions" in names
    n = spark.sql("SELECT count(*) AS n FROM model1_sessions").first().n
    assert n == first_touch_sessions(ev, "2024-01-01", "2024-01-31").count()
    r = spark.sql("SELECT safe_actual_ts_ms(NULL, 1500000) AS v").first().v
    assert r == 1500
    assert spark.sql("SELECT count(*) AS n FROM model_comparison").first().n > 0


def test_cli_jobs(spark, capsys):
    root = new_work_path(spark, "cli-export")
    X.write_export(lens_events(spark, SF_SMALL), root)
    t1, t2, out = (new_work_path(spark, n) for n in ("cli-m1", "cli-m2", "cli-report"))
    base = ["--export", root, "--start", "2024-01-01", "--end", "2024-01-31", "--master", "local[*]"]
    assert cli.main(["both", "--table", t1, "--table2", t2, *base]) == 0
    assert cli.main(["model1", "--table", t1, *base]) == 0     # a rerun changes nothing
    assert cli.main(["compare", "--table", t1, "--out", out, *base]) == 0
    ids = new_work_path(spark, "cli-ids")
    assert cli.main(["session-ids", "--shard", "20240121", "--out", ids, "--export", root,
                     "--master", "local[*]"]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines() if x.startswith("{")]
    assert [x["job"] for x in lines] == ["both", "model1", "compare", "session-ids"]
    ev = lens_export(spark, SF_SMALL)
    want = first_touch_sessions(ev, "2024-01-01", "2024-01-31").select("unique_session_id")
    assert spark.read.parquet(t1).count() == want.count()
    assert spark.read.option("header", True).csv(out).count() > 0
    assert spark.read.parquet(ids).count() == ev.where(F.col("suffix") == "20240121").count()


def test_merge_into_needs_row_level_catalog(spark):
    ev = lens_export(spark, SF_SMALL)
    src = first_touch_sessions(ev, "2024-01-01", "2024-01-03")
    spark.sql("DROP TABLE IF EXISTS sessions_builtin")
    src.limit(0).write.format("parquet").saveAsTable("sessions_builtin")
    with pytest.raises(Exception) as e:
        U.merge_into_catalog_table(src, "sessions_builtin", "2024-01-01", "2024-01-03")
    assert "UNSUPPORTED" in str(e.value).upper() or "MERGE" in str(e.value).upper()
    spark.sql("DROP TABLE IF EXISTS sessions_builtin")


def test_cli_folder_layout(spark, capsys):
    ev = lens_events(spark, SF_SMALL)
    root = new_work_path(spark, "cli-folders")
    days = ("20240105", "20240106", "20240107")
    for d in days:
        ev.where(F.col("suffix") == d).drop("suffix", "event_id").write.parquet(f"{root}/events_{d}")
    table = new_work_path(spark, "cli-folders-m2")
    assert cli.main(["model2", "--export", root, "--table", table, "--layout", "folders",
                     "--start", "2024-01-05", "--end", "2024-01-07", "--master", "local[*]"]) == 0
    from hitsessions.operators.session_start import session_start_sessions
    want = session_start_sessions(lens_export(spark, SF_SMALL), "2024-01-05", "2024-01-07")
    cols = ["unique_session_id", "session_source", "session_medium", "session_campaign"]
    assert sorted(map(tuple, spark.read.parquet(table).select(*cols).collect())) == \
        sorted(map(tuple, want.select(*cols).collect()))


def test_cli_argument_checks():
    with pytest.raises(SystemExit):
        cli.main(["compare", "--export", "export", "--table", "sessions"])     # no --out


def test_cli_needs_an_existing_export(spark):
    missing, table = new_work_path(spark, "cli-missing"), new_work_path(spark, "cli-none")
    for layout in ("partitioned", "folders"):
        with pytest.raises(FileNotFoundError):
            cli.main(["model1", "--export", missing, "--table", table, "--start", "2024-01-01", "--layout", layout])
    assert not U.table_exists(spark, table)


def test_submitted_settings_survive():
    """A submitted master and shuffle width stay; nothing is set on the session beyond the jobs' own settings."""
    code = ("from hitsessions.session import build_session; s = build_session(); "
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), "
            "s.conf.get('spark.sql.sources.partitionOverwriteMode'))")
    env = {**os.environ, "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
           "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=4000 "
                                  "--conf spark.ui.enabled=false pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180).stdout
    assert out.split("GOT ")[1].split()[:3] == ["local[2]", "4000", "STATIC"]


def test_cli_session_ids_reads_the_shard_in_folders(spark):
    root, out = new_work_path(spark, "cli-folders"), new_work_path(spark, "cli-ids")
    ev = lens_events(spark, SF_SMALL)
    X.write_shard_folders(ev.where(F.col("suffix").between("20240120", "20240122")), root)
    assert cli.main(["session-ids", "--shard", "20240121", "--out", out, "--export", root, "--layout", "folders",
                     "--master", "local[*]"]) == 0
    assert spark.read.parquet(out).count() == ev.where(F.col("suffix") == "20240121").count()
