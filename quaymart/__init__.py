"""Quaymart: commerce analytics expressed as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

from quaymart.session import (
    apply_settings, build_session, clear_scratch, scratch_path, stage,
)

__all__ = ["apply_settings", "build_session", "clear_scratch", "scratch_path", "stage"]

# Functions that run in tasks travel with the task, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
