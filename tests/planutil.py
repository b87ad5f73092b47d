"""Plan-string helpers shared by the plan tests (the tool's own parser)."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from plan_summary import final_plan  # noqa: E402


def executed_final_plan(df) -> str:
    df.collect()  # runs this DataFrame's own query, so AQE's final plan is shown
    return final_plan(df._jdf.queryExecution().executedPlan().toString())
