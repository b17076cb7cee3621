"""rambler — graph walks and vertex embeddings as Spark DataFrame plans.

Layout
------
``sources``    table scans, derived inputs and text sources/sinks
``functions``  column expressions (phone normalisation, vector maths, keyed draws)
``operators``  relational operators: pair building, degree filters, ids,
               graph building, samplers, the random walk, embeddings, similarity
``plans``      end-to-end jobs (walk, embedding, node2vec)
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions shipped to Python workers (Arrow scans) are pickled by value, so executors
# need no installed copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from rambler.params import GraphParams, WalkParams, Word2VecParams, JobParams  # noqa: F401

__all__ = ["GraphParams", "WalkParams", "Word2VecParams", "JobParams"]
