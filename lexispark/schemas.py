"""Declared schemas of the datasets that jobs read back from files."""

from pyspark.sql import types as T

S, L, D = T.StringType(), T.LongType(), T.DoubleType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ADJ_COUNT = _struct(("adj", S), ("count", L))

# Organization profile (/orgs).
ORG_PROFILE = _struct(
    ("noun", S), ("subreddit", S), ("numNoun", L),
    ("directAdj", T.ArrayType(ADJ_COUNT)), ("connectedAdj", T.ArrayType(ADJ_COUNT)),
)

SYNONYM = _struct(("word", S), ("similarity", D))

# Synonyms of one organization (/all, /orgSynonyms/<community>).
SYNONYMS = _struct(("subreddit", S), ("org", S), ("count", L), ("synonyms", T.ArrayType(SYNONYM)))
