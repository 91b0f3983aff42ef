"""Feature vectors by column position."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assembler(inputs: list[str]) -> PipelineModel:
    """The inputs as one vector, a missing value read as 0: an ad without views has 0 days with views.

    Both steps are stages of the stored model, so scoring reads missing values as fitting did.
    """
    filled = [f"_filled_{i}" for i in range(len(inputs))]
    chosen = ", ".join(f"coalesce(cast(`{c}` as double), 0D) as {f}" for c, f in zip(inputs, filled, strict=True))
    fill = SQLTransformer(statement=f"select *, {chosen} from __THIS__")
    return PipelineModel([fill, VectorAssembler(inputCols=filled, outputCol="features")])


def middle_columns(df: DataFrame) -> list[str]:
    """First column is the id, last column is the label."""
    return df.columns[1:-1]


def labelled(features: DataFrame, label: str = "ctr") -> DataFrame:
    """Rows with a label: spark.ml refuses NULL labels."""
    return features.where(F.col(label).isNotNull())


def assembled(features: DataFrame) -> DataFrame:
    """The assembled vector, taken apart again: one column per position."""
    inputs = middle_columns(features)
    vectors = assembler(inputs).transform(features)
    values = vector_to_array("features")
    spread = [values[i].alias(f"f{i}") for i in range(len(inputs))]
    return vectors.select(features.columns[0], *spread)


def embedding_vectors(embeddings: DataFrame) -> DataFrame:
    values = F.col("embedding").cast("array<double>")
    return embeddings.select("vec_id", "label", array_to_vector(values).alias("features"))


def labelled_union(embeddings: DataFrame, kinds: tuple[int, ...]) -> DataFrame:
    """Sources of one class each, tagged with a literal and put under each other."""
    sources = [
        embeddings.where(F.col("label") == kind).select("vec_id", "embedding", F.lit(kind).alias("kind"))
        for kind in kinds
    ]
    return reduce(DataFrame.unionByName, sources)
