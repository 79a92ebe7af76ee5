"""Schemas of the raw files and of the layered tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw record's fields and types.
RECORD_FIELDS = {
    "BackdropUrl": T.StringType(),
    "Budget": T.DoubleType(),
    "CreatedBy": T.StringType(),
    "CreatedDate": T.StringType(),
    "Id": T.LongType(),
    "ImdbUrl": T.StringType(),
    "OriginalLanguage": T.StringType(),
    "Overview": T.StringType(),
    "PosterUrl": T.StringType(),
    "Price": T.DoubleType(),
    "ReleaseDate": T.StringType(),
    "Revenue": T.DoubleType(),
    "RunTime": T.LongType(),
    "Tagline": T.StringType(),
    "Title": T.StringType(),
    "TmdbUrl": T.StringType(),
    "UpdatedBy": T.StringType(),
    "UpdatedDate": T.StringType(),
    "genres": T.ArrayType(
        T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    ),
}
# Raw fields that become dates when the payload is flattened.
DATE_FIELDS = ("CreatedDate", "UpdatedDate")

# Column order of the movie table.
MOVIE_COLUMNS = (
    "Id", "Title", "Overview", "Tagline", "RunTime", "ReleaseDate", "CreatedBy", "CreatedDate",
    "Price", "Revenue", "Budget", "BackdropUrl", "ImdbUrl", "PosterUrl", "TmdbUrl", "UpdatedBy",
    "UpdatedDate", "OriginalLanguage",
)

CORRUPT = "_corrupt_record"
SOURCE_FILE = "source_file"
RECORD_KEY = "record_key"
INGEST_DATE = "p_ingestdate"
# Bronze is partitioned by day, batch, load status and step: the steps a row has gone through, so that
# every step writes partitions of its own and can be run again.
BATCH, STATUS, STEP, EXTRA = "batch", "status", "step", "extra"
BRONZE_PARTS = (INGEST_DATE, BATCH, STATUS, STEP)
SILVER_PARTS = (BATCH, STEP)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def flat_type(name: str, kind: T.DataType, date_fields=DATE_FIELDS) -> T.DataType:
    return T.DateType() if name in date_fields else kind


RECORD = struct(**RECORD_FIELDS)
RAW = struct(movie=T.ArrayType(RECORD))
SILVER = struct(
    **{name: flat_type(name, kind) for name, kind in RECORD_FIELDS.items()},
    batch=T.StringType(),
    step=T.StringType(),
)
MOVIE = struct(**{name: SILVER[name].dataType for name in MOVIE_COLUMNS})
GENRE = struct(id=T.LongType(), name=T.StringType())
LANGUAGE = struct(code=T.StringType(), name=T.StringType())
MOVIE_GENRE = struct(movie_id=T.LongType(), genres_id=T.LongType())
REJECTS = struct(
    source_file=T.StringType(), reason=T.StringType(), record=T.StringType(), p_ingestdate=T.DateType(),
    batch=T.StringType(),
)

FILES = struct(
    path=T.StringType(), length=T.LongType(), modified=T.TimestampType(), lines=T.LongType(), digest=T.StringType(),
    batch=T.StringType(), step=T.StringType(),
)


def bronze_of(payload: str, record: T.StructType) -> T.StructType:
    """Bronze table schema for records of the given type."""
    return T.StructType(
        [
            T.StructField("datasource", T.StringType(), False),
            T.StructField("ingesttime", T.TimestampType(), False),
            T.StructField(payload, record, True),
            T.StructField(EXTRA, T.StringType(), True),
            T.StructField(RECORD_KEY, T.BinaryType(), True),
            T.StructField(INGEST_DATE, T.DateType(), False),
            T.StructField(BATCH, T.StringType(), False),
            T.StructField(STATUS, T.StringType(), False),
            T.StructField(STEP, T.StringType(), False),
        ]
    )


BRONZE = bronze_of("movie", RECORD)


def shape(schema: T.StructType) -> dict[str, str]:
    """Column names and types, without regard to order, case and nullability."""
    return {f.name.lower(): f.dataType.simpleString().lower() for f in schema.fields}


def require_shape(actual: T.StructType, expected: T.StructType, what: str) -> None:
    """Raise when a batch does not have exactly the table's columns and types."""
    have, want = shape(actual), shape(expected)
    if have != want:
        missing = sorted(set(want) - set(have))
        extra = sorted(set(have) - set(want))
        changed = sorted(c for c in set(have) & set(want) if have[c] != want[c])
        raise ValueError(
            f"{what}: schema differs (missing {missing}, extra {extra}, "
            f"changed {[(c, want[c], have[c]) for c in changed]})"
        )
