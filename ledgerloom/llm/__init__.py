"""Operations of a training-data pipeline.  Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
