"""Clinical and claims analytics written as Spark DataFrame jobs."""

from vitalmart.plans.cms import detect_chronic_conditions
from vitalmart.plans.pipeline import (
    build_all,
    build_cleaned,
    build_lookups,
    build_mart,
    build_raw,
    code_files,
    register_report_views,
)
from vitalmart.sources.tables import (
    Layers,
    compose,
    pipe,
    run_log,
    stage_summary,
    verify_tables,
    write_run_metadata,
)

__version__ = "0.1.0"

__all__ = [
    "Layers",
    "build_all",
    "build_cleaned",
    "build_lookups",
    "build_mart",
    "build_raw",
    "code_files",
    "compose",
    "detect_chronic_conditions",
    "pipe",
    "register_report_views",
    "run_log",
    "stage_summary",
    "verify_tables",
    "write_run_metadata",
]
