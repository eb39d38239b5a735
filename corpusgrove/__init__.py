"""corpusgrove: topic hierarchies over very large document collections, as Spark jobs.

The package turns a corpus and a pluggable text-completion function into a topic
tree, a document-to-topic assignment and quality scores.  ``functions`` holds
Column expressions, ``sources`` readers and writers, ``operators`` DataFrame
operators, ``plans`` the stages built from them and ``catalog`` the registered
queries.
"""

import sys

from pyspark import cloudpickle

# Task code travels with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
