"""Declared table schemas."""

from pyspark.sql import types as T

PIPELINE_RUNS = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("target_date", T.DateType(), False),
    T.StructField("board_key", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("started_at", T.TimestampNTZType(), True),
    T.StructField("finished_at", T.TimestampNTZType(), True),
    T.StructField("config", T.StringType(), True),
    T.StructField("code_version", T.StringType(), True),
    T.StructField("is_recovered", T.BooleanType(), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
])

TERMS = T.StructType([
    T.StructField("term_id", T.LongType(), False),
    T.StructField("normalized", T.StringType(), False),
    T.StructField("needs_review", T.BooleanType(), True),
    T.StructField("is_blocked", T.BooleanType(), True),
    T.StructField("blocked_reason", T.StringType(), True),
    T.StructField("surface_examples", T.ArrayType(T.StringType()), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
])

DAILY_TERM_STATS = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("board_key", T.StringType(), False),
    T.StructField("term_id", T.LongType(), False),
    T.StructField("post_hits", T.LongType(), False),
    T.StructField("thread_hits", T.LongType(), False),
    T.StructField("created_at", T.TimestampNTZType(), True),
])

WEEKLY_TERM_TRENDS = T.StructType([
    T.StructField("week_start_date", T.DateType(), False),
    T.StructField("board_key", T.StringType(), False),
    T.StructField("term_id", T.LongType(), False),
    T.StructField("post_hits", T.LongType(), False),
    T.StructField("total_posts", T.LongType(), False),
    T.StructField("appearance_rate", T.DoubleType(), False),
    T.StructField("appearance_rate_ci_lower", T.DoubleType(), True),
    T.StructField("appearance_rate_ci_upper", T.DoubleType(), True),
    T.StructField("zscore", T.DoubleType(), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
])

TERM_REGRESSION_RESULTS = T.StructType([
    T.StructField("board_key", T.StringType(), False),
    T.StructField("term_id", T.LongType(), False),
    T.StructField("intercept", T.DoubleType(), False),
    T.StructField("slope", T.DoubleType(), False),
    T.StructField("intercept_ci_lower", T.DoubleType(), True),
    T.StructField("intercept_ci_upper", T.DoubleType(), True),
    T.StructField("slope_ci_lower", T.DoubleType(), True),
    T.StructField("slope_ci_upper", T.DoubleType(), True),
    T.StructField("p_value", T.DoubleType(), True),
    T.StructField("analysis_start_date", T.DateType(), False),
    T.StructField("analysis_end_date", T.DateType(), False),
    T.StructField("created_at", T.TimestampNTZType(), True),
    T.StructField("updated_at", T.TimestampNTZType(), True),
])

PIPELINE_METRICS_DAILY = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("board_key", T.StringType(), False),
    T.StructField("run_id", T.StringType(), True),
    T.StructField("fetched_threads", T.LongType(), False),
    T.StructField("fetched_posts", T.LongType(), False),
    T.StructField("parsed_posts", T.LongType(), False),
    T.StructField("parse_fail_posts", T.LongType(), False),
    T.StructField("tokenize_fail_posts", T.LongType(), False),
    T.StructField("filtered_tokens", T.LongType(), False),
    T.StructField("total_tokens", T.LongType(), False),
    T.StructField("filtered_rate", T.DoubleType(), False),
    T.StructField("duration_sec", T.IntegerType(), False),
    T.StructField("created_at", T.TimestampNTZType(), True),
])

POSTS = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("board_key", T.StringType(), False),
    T.StructField("thread_path", T.StringType(), False),
    T.StructField("post_no", T.IntegerType(), True),
    T.StructField("date_text", T.StringType(), True),
    T.StructField("content", T.StringType(), True),
])

LEXICON = T.StructType([
    T.StructField("surface", T.StringType(), False),
    T.StructField("pos", T.StringType(), False),
])

WEEKLY_ERRORS = T.StructType([
    T.StructField("week_start_date", T.DateType(), False),
    T.StructField("board_key", T.StringType(), False),
    T.StructField("term_id", T.LongType(), False),
    T.StructField("reasons", T.ArrayType(T.StringType()), False),
    T.StructField("created_at", T.TimestampNTZType(), True),
])

DAY_STATE = T.StructType([
    T.StructField("board_key", T.StringType(), True),
    T.StructField("thread_path", T.StringType(), True),
    T.StructField("term", T.StringType(), True),
    T.StructField("hit", T.LongType(), True),
    T.StructField("occ", T.LongType(), True),
    T.StructField("batch_id", T.LongType(), True),
    T.StructField("date", T.DateType(), True),
])
