"""voltframe: interval price and meter analytics expressed as Spark DataFrame plans.

Every public operator is a ``DataFrame -> DataFrame`` function (composable with
``DataFrame.transform``) or a small builder of Catalyst expressions.  No Python
UDF sits in a hot path; Python-side code runs inside Arrow batches (``mapInArrow``): the
global ordered lag/lead, which Spark cannot express without a single-partition window,
flattening of unknown JSON, and the frame of HTML part files.
"""

import sys

from pyspark import cloudpickle

from voltframe.session import checkpoint_root, get_spark, scratch_path

# Functions that run in tasks travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_spark", "checkpoint_root", "scratch_path"]
