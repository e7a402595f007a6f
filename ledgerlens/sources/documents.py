"""JSON and CSV readers, and readers of saved job results.

* ``read_scam_registry``: the registry document(s) ``{"result": {address:
  record}}``, either one document per line (splittable) or one document per
  file (``whole_file=True``; a whole-text file is one record, so that form is
  for bounded registries only).
* ``read_json``: JSON lines with an explicit schema (no inference pass).
* ``read_csv``: CSV with a header, explicit schema or, on request, schema
  inference (an extra pass over the data).
* ``read_pair_list`` / ``read_csv_result``: saved results back as tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.scams import parse_documents, with_typed_ids
from ..schemas import SCAM_DOCUMENT


def read_scam_registry(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Registry entries (``key``, ``record``) with the schema given."""
    docs = spark.read.text(path, wholetext=whole_file)
    return parse_documents(docs, "value")


def read_json(spark: SparkSession, path: str, schema: T.StructType | str = SCAM_DOCUMENT) -> DataFrame:
    """JSON lines with an explicit schema."""
    return spark.read.schema(schema).json(path)


def registry_entries(df: DataFrame) -> DataFrame:
    """Entries of registry documents read by :func:`read_json`."""
    return with_typed_ids(df.select(F.explode("result").alias("key", "record")))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             infer: bool = False, header: bool = True) -> DataFrame:
    """CSV with header; explicit schema unless ``infer`` is asked for."""
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


PAIR_LIST = "array<array<string>>"


def read_pair_list(spark: SparkSession, path: str, python_literal: bool = False) -> DataFrame:
    """A saved ``[[key, number], ...]`` list as rows (``key``, ``number``).

    ``key`` is the first element's text (a nested key list stays JSON text);
    ``number`` is the last element as a double, null when not numeric
    (``Infinity`` is read as infinity). ``python_literal`` accepts the
    ``[('k', 1), ...]`` spelling of a printed Python list.
    """
    lines = spark.read.text(path, wholetext=False)
    return parse_pair_list(lines, python_literal)


def parse_pair_list(lines: DataFrame, python_literal: bool = False) -> DataFrame:
    text = F.col("value")
    if python_literal:
        text = F.translate(text, "()'", '[]"')
    pairs = lines.select(F.explode(F.from_json(
        text, PAIR_LIST, {"allowNonNumericNumbers": "true"})).alias("p"))
    return pairs.select(F.col("p")[0].alias("key"),
                        # non-finite numbers come back as quoted tokens
                        F.btrim(F.element_at("p", -1), F.lit('"')).try_cast("double").alias("number"))


def read_csv_result(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Saved ``key,value`` lines (no header) with named, typed columns."""
    return spark.read.schema(schema).option("header", False).csv(path)
