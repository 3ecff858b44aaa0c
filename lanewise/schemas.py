"""The table contracts shared by every batch and streaming job."""

from pyspark.sql.types import StructType


def _schema(columns: str) -> StructType:
    """All-nullable columns from ``name type`` pairs; unlike DDL it needs no session."""
    schema = StructType()
    for pair in columns.split(","):
        schema = schema.add(*pair.split())
    return schema


# Column names, order and types of the flights table, and what the
# scoring job adds to it for its readers.
_FLIGHTS = (
    "id string, fldate string, month integer, dofW integer, carrier string, "
    "src string, dst string, crsdephour integer, crsdeptime integer, depdelay double, "
    "crsarrtime integer, arrdelay double, crselapsedtime double, dist double"
)
FLIGHTS = _schema(_FLIGHTS)
SCORED_FLIGHTS = _schema(_FLIGHTS + ", orig_dest string, label double, prediction double")
