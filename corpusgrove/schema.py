"""Explicit schemas of the tables that cross a stage boundary."""

from pyspark.sql import Column, functions as F, types as T

# A corpus line: ids and labels stay strings even when they look numeric.
CORPUS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("label", T.StringType()),
    ]
)

# Columns a stage may have added to the corpus.
STAGE_COLUMNS = {
    "responses": T.StringType(),
    "refined_responses": T.StringType(),
    "prompted_docs": T.StringType(),
}

# One row per topic node.  ``path`` holds one ordinal per ancestor plus the
# node's own, so sorting by it gives depth-first order, a prefix of it is an
# ancestor, and it identifies the node.
TOPICS = T.StructType(
    [
        T.StructField("path", T.ArrayType(T.LongType(), False)),
        T.StructField("lvl", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("desc", T.StringType()),
    ]
)

MAPPING = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("old", T.StringType()),
        T.StructField("new", T.StringType()),
    ]
)

# Ordinals of nodes created from responses start here, above any file line
# number, so new siblings sort behind the ones read from a file.
CREATED_BASE = 1 << 61
LINE_BITS = 20
SUBTOPIC_BASE = 3 << 60


def node_ordinal(base: int, doc: Column, line: Column) -> Column:
    """Order-preserving number of a response line: document, then line; raises beyond its ranges."""
    doc = doc.cast("long")
    fits = (doc >= 0) & (doc < 1 << (60 - LINE_BITS)) & (line >= 0) & (line < 1 << LINE_BITS)
    number = F.lit(base) + F.shiftleft(doc, LINE_BITS) + line
    return F.when(fits, number).otherwise(F.raise_error(F.lit("a line or document number is out of range")).cast("long"))
