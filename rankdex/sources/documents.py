"""Document tables as CSV with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rankdex.functions.numbers import strict_long
from rankdex.sources.csv_records import read_csv

# Fixed value: the columns of a document, in order. Ids and counts are longs.
DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("talk_id", T.LongType()),
        T.StructField("description", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("speaker_1", T.StringType()),
        T.StructField("views", T.LongType()),
        T.StructField("duration", T.LongType()),
        T.StructField("topics", T.StringType()),
        T.StructField("related_talks", T.StringType()),
        T.StructField("url", T.StringType()),
    ]
)


def read_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType = DOCUMENT_SCHEMA,
    escape: str = '"',
    mode: str = "FAILFAST",
) -> DataFrame:
    """The columns of ``schema``, found by header name, from quoted CSV whose fields
    may hold line breaks.

    Extra columns are dropped and a missing one is an analysis error. Empty text
    is ``''``, not NULL; an integer column that holds no integer fails the job.
    ``escape`` is ``"`` for doubled quotes or a backslash. With
    ``mode='PERMISSIVE'`` broken records are kept, their text in ``_corrupt_record``,
    and integers that do not parse are NULL.

    Files are read in ranges, many tasks a file, wherever line breaks and quotes are
    (``csv_records``). Two scans run at once to find out how, so store the result if it
    is read more than once.
    """
    permissive = mode.upper() == "PERMISSIVE"
    raw = read_csv(spark, path, escape, mode)
    if not permissive:
        # A filter, so that a bad integer is found even when its column is not used.
        for field in schema.fields:
            if not isinstance(field.dataType, T.StringType):
                raw = raw.where(strict_long(F.col(f"`{field.name}`")).isNotNull())
    return raw.select(
        *(_typed(field, permissive) for field in schema.fields),
        *(["_corrupt_record"] if permissive else []),
    )


def _typed(field: T.StructField, permissive: bool):
    text = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(text, F.lit("")).alias(field.name)
    number = text.try_cast("long") if permissive else strict_long(text)
    return number.cast(field.dataType).alias(field.name)
