"""Training-data operators: URL filters, deduplication, sharding,
decontamination, toxicity, PII, quality and tokenisation. Nothing outside this
package imports it; ``queries.py`` holds the registered queries."""

import sys

from pyspark import cloudpickle

# task functions travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
