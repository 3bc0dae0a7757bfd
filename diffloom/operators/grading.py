"""Grading (D12, E1-E4) and gold-test refresh.

Tables:
  parsed   (run keys..., instance_id, applied, tests)       one row per log, from ``parse_logs``
  statuses (keys..., instance_id, test, status)             long form, for the refresh
  gold     (instance_id, category, test)                    long form of the gold lists
  modes    (instance_id, eval_type)  optional                M6, default pass_and_fail

Shuffles are keyed on ``instance_id`` / the run keys, never on ``repo``: one repository may
hold most rows, instance ids spread evenly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from diffloom import constants as K
from diffloom.functions.text import as_string_array


def gold_long(instances: DataFrame, id_col: str = "instance_id",
              f2p_col: str = K.FAIL_TO_PASS, p2p_col: str = K.PASS_TO_PASS) -> DataFrame:
    """Gold lists (JSON text or arrays) -> ``(instance_id, category, test)`` (A4 + explode)."""
    def arr(c):
        t = instances.schema[c].dataType.simpleString()
        return F.col(c) if t.startswith("array") else as_string_array(c)
    return (instances.select(id_col, F.array(
        F.struct(F.lit(K.FAIL_TO_PASS).alias("category"), arr(f2p_col).alias("tests")),
        F.struct(F.lit(K.PASS_TO_PASS).alias("category"), arr(p2p_col).alias("tests"))).alias("g"))
        .select(id_col, F.explode("g").alias("g"))
        .select(id_col, F.col("g.category").alias("category"), F.explode("g.tests").alias("test")))


def test_outcome(status: Column, eval_type: Column) -> Column:
    """E1 per gold test: 'success', 'failure' or NULL (counted in neither list).

    pass_and_fail: PASSED/XFAIL succeed; absent, FAILED, ERROR fail; other statuses are in
    neither list. fail_only: FAILED fails, everything else (also absent) succeeds.
    """
    pf = (F.when(status.isin(K.PASSED, K.XFAIL), F.lit("success"))
          .when(status.isNull() | status.isin(K.FAILED, K.ERROR), F.lit("failure")))
    fo = F.when(F.coalesce(status == K.FAILED, F.lit(False)), F.lit("failure")).otherwise(F.lit("success"))
    return F.when(eval_type == K.FAIL_ONLY, fo).otherwise(pf)


def resolution_status(f2p_s: Column, f2p_f: Column, p2p_f: Column) -> Column:
    """E3 on integer counts: rate == 1 iff failures == 0 (an empty list counts as 1)."""
    return (F.when((f2p_f == 0) & (p2p_f == 0), F.lit(K.RESOLVED_FULL))
            .when((f2p_s > 0) & (f2p_f > 0) & (p2p_f == 0), F.lit(K.RESOLVED_PARTIAL))
            .otherwise(F.lit(K.RESOLVED_NO)))


def rate(success: Column, failure: Column) -> Column:
    """Success / (success + failure), 1.0 when both are 0."""
    return F.when(success + failure == 0, F.lit(1.0)).otherwise(success / (success + failure))


def gold_lists(gold: DataFrame) -> DataFrame:
    """One row per instance with its gold tests as ``f2p`` and ``p2p`` (sorted, distinct). The lists of an
    instance are one record of the dataset, so they are bounded by it."""
    part = lambda c: F.sort_array(F.collect_set(F.when(F.col("category") == c, F.col("test"))))
    return gold.groupBy("instance_id").agg(part(K.FAIL_TO_PASS).alias("f2p"), part(K.PASS_TO_PASS).alias("p2p"))


def grade_tests(parsed: DataFrame, gold: DataFrame, run_keys: Sequence[str], modes: DataFrame | None = None,
                with_lists: bool = False) -> DataFrame:
    """D12 + E1-E3: one row per log with counts, rates and the resolution status.

    ``parsed`` is scanned once and joined with the gold lists on the instance; the outcome of each gold
    test is looked up in the log's own map. Logs that were not applied (I1) are not graded: their
    counts are NULL and they are RESOLVED_NO; rejected logs (unknown or unselected dialect) are
    left out, see ``rejected_logs``. ``run_keys`` must include ``instance_id``.
    """
    run_keys = list(run_keys)
    j = parsed.where(F.col("reject_reason").isNull()).select(*run_keys, "applied", "tests")
    j = j.join(gold_lists(gold), "instance_id", "left")
    if modes is not None:
        j = j.join(modes.select("instance_id", "eval_type"), "instance_id", "left")
    else:
        j = j.withColumn("eval_type", F.lit(K.PASS_AND_FAIL))
    mode = F.coalesce(F.col("eval_type"), F.lit(K.PASS_AND_FAIL))
    none = F.array().cast("array<string>")

    def having(tests: str, outcome: str) -> Column:
        return F.filter(F.coalesce(F.col(tests), none),
                        lambda x: test_outcome(F.try_element_at(F.col("tests"), x), mode) == outcome)

    lists = {f"{part}_{out}": having(part, out) for part in ("f2p", "p2p") for out in ("success", "failure")}
    # two projections: each list is evaluated once
    out = j.select(*run_keys, "applied", *[F.when(F.col("applied"), c).alias(f"{n}_tests") for n, c in lists.items()])
    counts = {n: F.when(F.col("applied"), F.size(f"{n}_tests").cast("long")) for n in lists}
    out = out.select("*", *[c.alias(n) for n, c in counts.items()])
    status = F.when(F.col("applied"), resolution_status(F.col("f2p_success"), F.col("f2p_failure"),
                                                         F.col("p2p_failure"))).otherwise(F.lit(K.RESOLVED_NO))
    out = (out.withColumn("f2p_rate", F.when(F.col("applied"), rate(F.col("f2p_success"), F.col("f2p_failure"))))
              .withColumn("p2p_rate", F.when(F.col("applied"), rate(F.col("p2p_success"), F.col("p2p_failure"))))
              .withColumn("resolution", status)
              .withColumn("resolved", status == K.RESOLVED_FULL))
    return out if with_lists else out.drop(*[f"{n}_tests" for n in lists])


def instance_report(graded: DataFrame, predictions: DataFrame, run_keys: Sequence[str],
                    patch_col: str = "model_patch") -> DataFrame:
    """Flags per (run, instance). ``''`` counts as an existing patch here; NULL does not."""
    run_keys = list(run_keys)
    p = predictions.select(*[k for k in run_keys if k in predictions.columns], patch_col)
    j = p.join(graded, [k for k in run_keys if k in predictions.columns], "left")
    is_none = F.col(patch_col).isNull()
    return j.select(*[F.col(k) for k in run_keys if k in j.columns],
                    is_none.alias("patch_is_None"),
                    (~is_none).alias("patch_exists"),
                    (~is_none & F.coalesce(F.col("applied"), F.lit(False))).alias("patch_successfully_applied"),
                    (~is_none & F.coalesce(F.col("resolved"), F.lit(False))).alias("resolved"))


# ----------------------------------------------------------------------------- E10, E11

def _tagged(statuses: DataFrame, gold: DataFrame, config_col: str) -> DataFrame:
    """(config, instance, test, passed, old): whether a test passed, and its old category."""
    ran = statuses.groupBy(config_col, "instance_id", "test").agg(
        F.coalesce(F.bool_or(F.col("status") == K.PASSED), F.lit(False)).alias("passed"))
    old = gold.groupBy("instance_id", "test").agg(F.min("category").alias("old"))  # F2P before P2P
    return ran.join(old, ["instance_id", "test"], "left")


def refresh_gold_tests(statuses: DataFrame, gold: DataFrame, config_col: str = "config",
                       expected: DataFrame | None = None) -> DataFrame:
    """E10 per (config, instance) from fresh statuses; only PASSED counts (XFAIL does not).

    new F2P = PASSED ∩ old F2P; new P2P = PASSED − old F2P; reproduced when ≥ 1 old F2P passed. One row
    for each pair of ``expected`` (default: those with any status): ``no_log`` marks pairs without a
    status, ``not_reproduced`` those that ran but passed no old F2P test. The lists are in
    ``refreshed_gold_long``.
    """
    passed = F.col("passed")
    per = _tagged(statuses, gold, config_col).groupBy(config_col, "instance_id").agg(
        F.count_if(passed & (F.col("old") == K.FAIL_TO_PASS)).alias("new_f2p"),
        F.count_if(passed & ~F.col("old").eqNullSafe(F.lit(K.FAIL_TO_PASS))).alias("new_p2p"),
        F.count_if(passed & (F.col("old") == K.PASS_TO_PASS)).alias("p2p_kept")).withColumn("ran", F.lit(True))
    pairs = (per if expected is None else expected).select(config_col, "instance_id").distinct()
    sizes = gold.groupBy("instance_id").agg(
        F.count_if(F.col("category") == K.FAIL_TO_PASS).alias("old_f2p"),
        F.count_if(F.col("category") == K.PASS_TO_PASS).alias("old_p2p"))
    out = per if expected is None else pairs.join(per, [config_col, "instance_id"], "left")
    out = out.join(sizes, "instance_id", "left").fillna(0, ["new_f2p", "new_p2p", "p2p_kept", "old_f2p", "old_p2p"])
    out = out.withColumn("no_log", F.col("ran").isNull()).withColumn("reproduced", F.col("new_f2p") > 0)
    return (out.withColumn("not_reproduced", ~F.col("no_log") & ~F.col("reproduced"))
               .withColumn("f2p_changed", F.col("new_f2p") != F.col("old_f2p"))
               .withColumn("p2p_changed", (F.col("new_p2p") != F.col("old_p2p")) | (F.col("p2p_kept") != F.col("old_p2p")))
               .drop("ran"))


def refreshed_gold_long(statuses: DataFrame, gold: DataFrame, config_col: str = "config") -> DataFrame:
    """The new gold lists, ``(config, instance_id, category, test)``."""
    new = F.when(F.col("old") == K.FAIL_TO_PASS, F.lit(K.FAIL_TO_PASS)).otherwise(F.lit(K.PASS_TO_PASS))
    return _tagged(statuses, gold, config_col).where("passed").select(config_col, "instance_id", new.alias("category"), "test")


def refresh_id_lists(refreshed: DataFrame, config_col: str = "config") -> DataFrame:
    """The four id lists as rows ``(config, list, instance_id)``."""
    flags = ["no_log", "not_reproduced", "f2p_changed", "p2p_changed"]
    named = F.array(*[F.when(F.col(f) & (F.lit(f == "no_log") | ~F.col("no_log")), F.lit(f)) for f in flags])
    return refreshed.select(config_col, F.explode(F.array_compact(named)).alias("list"), "instance_id")


def best_config_per_group(refreshed: DataFrame, group_cols: Sequence[str], config_col: str = "config",
                          config_rank_col: str = "config_rank") -> DataFrame:
    """The config with most reproduced instances per group; the lowest rank wins a tie;
    groups with no reproduced instance are dropped."""
    counts = (refreshed.where(F.col("reproduced"))
              .groupBy(*group_cols, config_col, config_rank_col).agg(F.count("*").alias("n_reproduced")))
    best = counts.groupBy(*group_cols).agg(
        F.max_by(F.struct(config_col, "n_reproduced"),
                 F.struct("n_reproduced", (-F.col(config_rank_col)).alias("neg_rank"))).alias("b"))
    return best.select(*group_cols, F.col(f"b.{config_col}").alias(config_col),
                       F.col("b.n_reproduced").alias("n_reproduced"))
