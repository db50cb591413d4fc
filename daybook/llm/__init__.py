"""Operations of a training-data pipeline, one module per operator.

Nothing else in the library imports this package; its queries and their SQL
are in ``daybook.llm.queries``.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the tasks that call
# them, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
