"""Operators for preparing text corpora: dedup, filtering, decontamination,
tokenisation and web archives, each a Spark job over a table of texts.

Nothing outside this package imports it. Its functions are shipped to the
executors with the tasks (pickled by value), so a cluster needs no copy of the
package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
