"""Helpers of the tests of the training-data operators."""

from pyspark.sql import functions as F

# names that operators use inside
INTERNAL = ["key", "row", "doc", "t", "w", "h", "a", "b", "rank", "score", "weight", "part", "same", "words", "n", "size",
            "fails", "good", "toxic", "mask", "first", "_key", "_hash", "_fp", "_h", "shard", "path_posterior", "site",
            "host", "root", "_text", "_row", "spans", "terms", "labels", "blocks", "at"]


def clashing(df):
    """``df`` with a column of every internal name, all of odd content."""
    return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(INTERNAL) if c not in df.columns])
