"""Operations of a training-data pipeline, each a Spark job over a table of documents.

Functions that run inside tasks are sent to the executors with the job, so that a cluster needs
this package on the driver only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
