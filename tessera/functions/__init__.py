"""Scalar functions as Column expressions (JVM-side, codegen-friendly; no Python UDFs)."""
from tessera.functions.dates import (  # noqa: F401
    business_days, calendar_days, compact, explode_business_days, default_start, iso_to_compact, lenient_date, lenient_timestamp,
    months_back, next_day, norm_date, parse_ymd, run_ts_text, ymd_to_iso, yesterday,
)
from tessera.functions.text import (  # noqa: F401
    build_raw_path, first_present, parse_raw_path, pipe_segment, py_strip, stats_message,
    truthy_first,
)
from tessera.functions.classify import (  # noqa: F401
    classify_failure, classify_failure_words, is_no_content,
)
