"""Operators of a training-data pipeline. Nothing outside this subpackage imports it.

Functions that run on executors travel with their tasks, so no executor has to have this
package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
