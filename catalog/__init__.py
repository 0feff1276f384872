"""Named queries over the test tables, each with the SQL it must agree with where SQL can say it."""

import sys

from pyspark import cloudpickle

from catalog import features, files, hourly, models, reports, splits

# Task functions of queries travel with the job, as those of the package do.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUERIES = {}
ORACLES = {}
for part in (features, splits, models, reports, hourly, files):
    QUERIES.update(part.QUERIES)
    ORACLES.update(part.ORACLES)
