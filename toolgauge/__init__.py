"""toolgauge: tool-call analytics as Spark DataFrame transformations.

Sub-packages
    functions   Column-level helpers: text, JSON, chat rendering
    operators   DataFrame -> DataFrame transformations
    sources     readers and writers (JSON lines, run history)
    plans       the registered queries, their inputs and their SQL twins
    streaming   the same scoring columns over a stream of predictions
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
