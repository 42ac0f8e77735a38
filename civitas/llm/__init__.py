"""Training-data pipeline operators (mixing, token counts, quality, decontamination,
toxicity, suffix dedup, HTML extraction, sharding, quality rules, SimHash,
hard negatives, language, whitening).

Nothing else in the library imports this subpackage. Task functions are
pickled by value, so executors need no copy of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
