"""Print the final physical plans of the headline jobs (after AQE).

    python -m hitsessions.plans.show /root/testdata/sf0.1 > PLANS.md

Each job is run once, then its executed plan is printed (AQE fixes the
plan while running, so the final plan shows coalesced partitions,
chosen join strategies and the whole-stage-codegen stages).
"""

from __future__ import annotations

import sys

from hitsessions.operators import compare as CMP
from hitsessions.operators import id_index
from hitsessions.operators import states as S
from hitsessions.operators import upsert as U
from hitsessions.operators.first_touch import first_touch_sessions
from hitsessions.operators.session_start import session_start_sessions
from hitsessions.options import SessionOptions
from hitsessions.session import build_session, new_work_path
from hitsessions.sources.lens import lens_export

FULL = ("2024-01-01", "2024-01-31")

NOTES = """What to look for:

- `*(n)` marks a whole-stage-codegen stage. Scan, filter, parameter extraction and the partial-aggregate sort share
  stage `*(1)`: the lookups have no lambdas.
- Below each `Exchange hashpartitioning(unique_session_id)` sits a partial `SortAggregate` (`partial_min`) or a partial
  `WindowGroupLimit`. Each map task ships at most one row per session, so a hot session cannot overload one reducer.
- Model 2's scan filters `event_name = session_start` (pushed to Parquet; see `PushedFilters` in `explain()`).
- The upsert is one `SortMergeJoin FullOuter` of the target window and the staged source. The branch that carries
  rows outside the window is removed at run time when no source date falls outside it (empty relation).
- In the report, per-(date, channel) counts are partial before their exchange. The per-date join is broadcast only
  because AQE measured it small (one row per day).
- At sf0.1 AQE broadcasts the small side of the window form's join. On large inputs it stays a sort-merge join on the
  existing id partitioning (no extra exchange in intended mode).
- The last three jobs run with broadcasts off. The id index and the bucketed target are read by bucket: the only exchange
  of their joins is above the source. States are merged by one partial aggregate and one exchange.
"""


def final_plan(df, width: int = 160) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    text = text.split("+- == Initial Plan ==")[0]
    return "\n".join(ln[:width] + (" …" if len(ln) > width else "") for ln in text.splitlines())


def main(sf_dir: str) -> None:
    spark = build_session("local[8]", shuffle_partitions=16)
    ev = lens_export(spark, sf_dir)
    o = SessionOptions()
    path = new_work_path(spark, "plans-m1")
    U.create_sessions(first_touch_sessions(ev, "2024-01-01", "2024-01-16", o, run_ts="2024-01-17 06:00:00"), path)
    # As upsert_sessions does: the source sessions are staged first.
    src_path = new_work_path(spark, "plans-source")
    first_touch_sessions(ev, "2024-01-15", "2024-01-31", o, run_ts="2024-02-01 06:00:00").write.parquet(src_path)
    src = spark.read.parquet(src_path)
    jobs = {
        "Model 1, aggregate form (J3)": first_touch_sessions(ev, *FULL, o),
        "Model 1, window form": first_touch_sessions(ev, *FULL, o.with_(form="window")),
        "Model 2 (J4)": session_start_sessions(ev, *FULL, o),
        "Upsert content of the rewritten partitions (J5)": U.merge_partitions(
            spark.read.parquet(path), src, "2024-01-15", "2024-01-31", U.MODEL1_SPEC, "2024-02-01 06:00:00"),
        "Comparison report, as written (J7)": CMP.compare_models(
            first_touch_sessions(ev, *FULL, o.with_(mode="as_written")), ev, *FULL, o.with_(mode="as_written")),
    }
    # Without broadcasts, as with large sides.
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    load, bo = ("2024-01-01", "2024-01-16"), o.with_(table_buckets=16, one_row_per_id=True, id_buckets=16)
    bucketed, names = new_work_path(spark, "plans-bucketed"), []
    U.upsert_sessions(spark, bucketed, first_touch_sessions(ev, *load, bo, run_ts="2024-01-17 06:00:00"), *load,
                      U.MODEL1_SPEC, "2024-01-17 06:00:00", bo)
    target = U._read_target(spark, bucketed, src, "2024-01-15", "2024-01-31", U.MODEL1_SPEC, bo, names=names)
    states = new_work_path(spark, "plans-states")
    S.update_states(spark, ev, states, sorted(r.suffix for r in ev.select("suffix").distinct().collect()), o)
    jobs["Sessions that the id index knows (D1, Q15)"] = id_index.held(src, id_index.read_ids(spark, bucketed), 16)
    jobs["Upsert content, bucketed target (S6, JN2)"] = U.merge_partitions(
        target, src, "2024-01-15", "2024-01-31", U.MODEL1_SPEC, "2024-02-01 06:00:00", 0, 16)
    jobs["Model 1 from stored states (L1, L2)"] = S.sessions_from_states(spark, states, *FULL, o)[0]
    print(f"# Final physical plans\n\n`python -m hitsessions.plans.show {sf_dir}`: PySpark {spark.version}, "
          "local[8], AQE on, 16 shuffle partitions. Plans after execution; long lines are cut.\n")
    print(NOTES)
    for name, df in jobs.items():
        print(f"## {name}\n\n```\n{final_plan(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
