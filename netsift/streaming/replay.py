"""CSV files replayed as a record stream (S7): corrupt rows kept, fields coerced, batches limited.

Every field is read as text, so that a value of the wrong type does not
make a row corrupt; the wire rules (P8) then give numbers and booleans. A row that the
CSV parser cannot split into the schema's fields keeps its text in ``corrupt_col`` and
nulls elsewhere, and is passed on, for the dead letters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..config import DEFAULT_ROLES, Roles
from ..operators.clean import wire_coerce

CORRUPT = "_corrupt_record"


def csv_schema(columns: Sequence[str], corrupt_col: str = CORRUPT) -> T.StructType:
    """All columns as text, and the text of rows that do not parse."""
    return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, corrupt_col]])


def read(
    spark: SparkSession,
    folder: str,
    columns: Sequence[str],
    stream: bool = True,
    files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
    corrupt_col: str = CORRUPT,
) -> DataFrame:
    """The files of ``folder`` as a stream, or as a batch with the same rows.

    ``files_per_batch`` and ``bytes_per_batch`` (such as ``"128m"``) bound a micro-batch; the trigger interval paces them.
    """
    reader = (spark.readStream if stream else spark.read).schema(csv_schema(columns, corrupt_col))
    # the parser must see whole rows, or a row that breaks off looks complete when few columns are read
    reader = reader.option("header", "true").option("mode", "PERMISSIVE").option("columnPruning", "false")
    reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if stream and bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.csv(folder)


def records(raw: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Typed records: unparsable or missing numbers are 0.0, booleans true for true/1/yes, else false."""
    return wire_coerce(raw, roles)
