"""tidemark: recurring-revenue movement analytics as Spark DataFrame operators.

Every operator of this part takes DataFrames and returns a lazy DataFrame (the jobs
in `plans.jobs` and `sources.publish` load, write and publish); nothing collects
customer-level data to the driver.
"""

from tidemark.operators.movement import movements, monthly_state, segments
from tidemark.operators.rollup import monthly_rollup
from tidemark.operators.snapshot import asof_snapshot
from tidemark.plans.checks import monthly_waterfall, run_checks, validation_report
from tidemark.plans.metrics import kpi_deltas, kpis_at, kpis_from_rollup, monthly_kpis
from tidemark.plans.quality import check_inputs
from tidemark.session import build_session, checkpoint_dir

__all__ = [
    "asof_snapshot", "build_session", "check_inputs", "checkpoint_dir", "kpi_deltas", "kpis_at",
    "kpis_from_rollup", "monthly_kpis", "monthly_rollup", "monthly_state", "monthly_waterfall",
    "movements", "run_checks", "segments", "validation_report",
]
