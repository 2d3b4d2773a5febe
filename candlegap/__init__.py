"""candlegap: daily price bars -> cleaned bars -> three-bar gaps -> reports, on Spark.

Every operator is a function from DataFrames to a DataFrame over many
instruments at once (keyed by ``from_symbol``, ``to_symbol``); nothing runs
an action except the ``plans.pipeline.run_*`` jobs, which write, and the
streaming refresh.

Common entry points are re-exported here; submodules hold the rest.
"""

from candlegap.operators import (
    detect_gaps,
    gap_fill_close,
    gap_fill_future,
    gap_first_fill,
    upsert_bars,
)
from candlegap.plans import build_gold, build_silver, reports

__version__ = "0.1.0"

__all__ = [
    "build_gold", "build_silver", "detect_gaps", "gap_fill_close", "gap_fill_future",
    "gap_first_fill", "reports", "upsert_bars",
]
