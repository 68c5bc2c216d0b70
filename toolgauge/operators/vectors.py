"""Vectors for failure texts when no encoder output is at hand."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from toolgauge.session import settle

# Width of the vectors, the same as that of the usual small sentence encoder.
DIMENSIONS = 384


def embed_failures(texts: DataFrame) -> DataFrame:
    """Add `embedding` to rows with `failure_text`: hashed TF-IDF of unit length.

    A stand-in for a sentence encoder's table of vectors; not comparable with those.
    The texts are read twice, for document frequencies and for the vectors, so they
    are written out once.
    """
    texts = settle(texts)
    stages = Pipeline(
        stages=[
            RegexTokenizer(inputCol="failure_text", outputCol="_words", pattern=r"[^\p{L}\p{N}_]+"),
            HashingTF(inputCol="_words", outputCol="_counts", numFeatures=DIMENSIONS),
            IDF(inputCol="_counts", outputCol="_weighted"),
            Normalizer(inputCol="_weighted", outputCol="_unit"),
        ]
    )
    out = stages.fit(texts).transform(texts)
    return out.withColumn("embedding", vector_to_array("_unit", "float32")).drop(
        "_words", "_counts", "_weighted", "_unit"
    )
