"""All registered queries: name -> (spark, sf_dir) -> DataFrame, plus their oracle SQL."""

from __future__ import annotations

from diffloom.plans import grading_queries as G
from diffloom.plans import patch_queries as P
from diffloom.plans import text_queries as T
from diffloom.plans import join_queries as J
from diffloom.plans import version_queries as V
from diffloom.plans import retrieval_queries as R
from diffloom.plans import dialect_queries as D
from diffloom.plans import view_queries as W
from diffloom.plans import order_queries as O
from diffloom.plans import report_queries as Q
from diffloom.plans import stream_queries as S
from diffloom.plans import rest_queries as X
from diffloom.plans.oracles import ORACLES
from diffloom.plans.view_oracles import VIEW_ORACLES

QUERIES = {
    "grade_runs": G.grade_runs,
    "regrade_modes": G.regrade_modes,
    "suite_results": G.suite_results,
    "suite_summary": G.suite_summary,
    "refresh_gold": G.refresh_gold,
    "refresh_lists": G.refresh_lists,
    "refresh_ids": G.refresh_ids,
    "best_config": G.best_config,
    "patch_stats": P.patch_stats,
    "patch_gates": P.patch_gates,
    "split_patches": P.split_patches,
    "statement_funnel": T.statement_funnel,
    "resolved_refs": T.resolved_refs,
    "problem_statements": T.problem_statements,
    "hints_prefix": T.hints_prefix,
    "repetition_filter": T.repetition_filter,
    "release_pages": T.release_pages,
    "runnable": J.runnable,
    "completed_anti": J.completed_anti,
    "decontam_exact": J.decontam_exact,
    "decontam_group": J.decontam_group,
    "sample_groups": J.sample_groups,
    "split_orders": J.split_orders,
    "budget_stop": J.budget_stop,
    "latest_orders": J.latest_orders,
    "run_report_buckets": J.run_report_buckets,
    "fingerprints": J.fingerprints,
    "resume_union": J.resume_union,
    "asof_release": V.asof_release,
    "asof_version_order": V.asof_version_order,
    "bm25_top20": R.bm25_top20,
    "recall": R.recall,
    "recall_means": R.recall_means,
    "pack_context": R.pack_context_q,
    "code_text": R.code_text_q,
    "train_tokens": R.train_tokens_q,
    "grade_dialects": D.grade_dialects,
    "text_gates": W.text_gates,
    "patch_views": W.patch_views,
    "join_views": W.join_views,
    "order_hits": W.order_hits,
    "prompt_forms": W.prompt_forms,
    "order_views": O.order_views,
    "context_fit": O.context_fit,
    "file_views": O.file_views,
    "release_dates": O.release_dates,
    "early_hints": O.early_hints,
    "run_report_totals": Q.run_report_totals,
    "run_report_ids": Q.run_report_ids,
    "instance_reports": Q.instance_reports,
    "collection_totals": Q.collection_totals,
    "import_reach": Q.import_reach,
    "collected_pulls": S.collected_pulls,
    "streamed_grades": S.streamed_grades,
    "regraded": S.regraded,
    "edit_windows": X.edit_windows,
    "docstring_texts": X.docstring_texts,
    "issue_statements": X.issue_statements,
    "package_ranks": X.package_ranks,
    "document_splits": X.document_splits,
}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in (ORACLES | VIEW_ORACLES | X.REST_ORACLES).items() if k in QUERIES}
