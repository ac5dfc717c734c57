"""Label document to code dictionary."""

from pyspark.sql import SparkSession

from starmart.operators.labels import label_dictionary
from starmart.operators.quality import write_gated
from starmart.sources.readers import read_documents
from starmart.sources.writers import write_dictionary


def run(
    spark: SparkSession, document: str, out: str, parity: bool = False, format: str = "parquet"
) -> int:
    dictionary = label_dictionary(read_documents(spark, document), parity=parity)
    return write_gated(
        dictionary, "labels", out, lambda df, path: write_dictionary(df, path, format)
    )
