"""Declared schemas (no inference on read)."""

from pyspark.sql import types as T

S, I, L, B, D, TS = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.DoubleType(), T.TimestampType()


def _f(name, t, nullable=True):
    return T.StructField(name, t, nullable)


INSTANCE = T.StructType([
    _f("repo", S), _f("instance_id", S), _f("pull_number", I), _f("issue_numbers", T.ArrayType(S)),
    _f("base_commit", S), _f("patch", S), _f("test_patch", S), _f("problem_statement", S),
    _f("hints_text", S), _f("created_at", S), _f("version", S), _f("FAIL_TO_PASS", S),
    _f("PASS_TO_PASS", S), _f("environment_setup_commit", S),
])

PULL = T.StructType([
    _f("number", I), _f("title", S), _f("body", S), _f("created_at", S), _f("merged_at", S),
    _f("diff_url", S),
    _f("base", T.StructType([_f("sha", S), _f("repo", T.StructType([_f("full_name", S)]))])),
    _f("resolved_issues", T.ArrayType(S)), _f("diff", S),
])

PREDICTION = T.StructType([_f("instance_id", S), _f("model_name_or_path", S), _f("model_patch", S)])

RESULT_FILE = T.StructType([
    _f("instance_id", S),
    _f("results", T.ArrayType(T.StructType([
        _f("test_file", S), _f("test_case", S), _f("test_type", S), _f("exit_code", I),
        _f("stdout", S), _f("stderr", S)]))),
])

HITS = T.StructType([_f("instance_id", S),
                     _f("hits", T.ArrayType(T.StructType([_f("docid", S), _f("score", D)])))])
