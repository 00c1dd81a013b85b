"""Scoring requests as JSON documents (SRC-7): id plus named inputs with
shape, datatype and nested data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REQUEST_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("inputs", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType(), True),
        T.StructField("shape", T.ArrayType(T.IntegerType()), True),
        T.StructField("datatype", T.StringType(), True),
        T.StructField("data", T.ArrayType(T.ArrayType(T.StringType())), True),
    ])), True),
])


def build_requests(keys: DataFrame, id_col: str, key_col: str,
                   input_name: str = "state") -> DataFrame:
    """One request per row: a ``[1, 1]`` BYTES input named ``input_name``
    holding the key."""
    single = F.struct(F.lit(input_name).alias("name"),
                      F.array(F.lit(1), F.lit(1)).alias("shape"),
                      F.lit("BYTES").alias("datatype"),
                      F.array(F.array(F.col(key_col).cast("string"))).alias("data"))
    return keys.select(F.col(id_col).cast("string").alias("id"),
                       F.array(single).alias("inputs"))


def write_requests(requests: DataFrame, path: str) -> None:
    requests.write.mode("overwrite").json(path)


def read_request_keys(spark: SparkSession, path: str, input_name: str = "state") -> DataFrame:
    """``id, state``: the values of the input named ``input_name`` of every
    request, one row per value (several keys per request are allowed)."""
    req = spark.read.schema(REQUEST_SCHEMA).json(path)
    inputs = req.select("id", F.explode("inputs").alias("i")).where(F.col("i.name") == input_name)
    return inputs.select("id", F.explode(F.flatten("i.data")).alias(input_name))


def request_keys(requests: DataFrame, input_name: str = "state") -> DataFrame:
    """Same as :func:`read_request_keys` on an in-memory request frame."""
    inputs = (requests.select("id", F.explode("inputs").alias("i"))
              .where(F.col("i.name") == input_name))
    return inputs.select("id", F.explode(F.flatten("i.data")).alias(input_name))
