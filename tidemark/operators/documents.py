"""Profile documents to flat rows: personal values hashed, nested values as JSON, the rest packed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import values as V
from tidemark.functions import text, times

_NESTED = (T.StructType, T.ArrayType, T.MapType)
_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def hash_pii(df: DataFrame, cols: Sequence[str] = tuple(V.PII_FIELDS)) -> DataFrame:
    """Replace personal columns by ``<name>_hash``."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({f"{c}_hash": text.hash_pii(F.col(c)) for c in present}).drop(*present)


def _flat(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, _NESTED):
        return F.to_json(c)
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, _ISO)
    if isinstance(field.dataType, T.DateType):
        return c.cast("string")
    return c


def flatten_nested(df: DataFrame) -> DataFrame:
    """Struct, array and map columns to JSON text, times to ISO text; scalars stay."""
    return df.select([_flat(f).alias(f.name) for f in df.schema.fields])


def pack_extra(df: DataFrame, known: Sequence[str]) -> DataFrame:
    """Columns outside ``known`` as one JSON object in ``_extra``, null where all of them are null."""
    extra = [c for c in df.columns if c not in known]
    kept = [c for c in df.columns if c in known]
    if not extra:
        return df.withColumn("_extra", F.lit(None).cast("string"))
    packed = F.to_json(F.struct(*[F.col(f"`{c}`") for c in extra]))
    filled = F.coalesce(*[F.col(f"`{c}`").cast("string") for c in extra]).isNotNull()
    return df.select(*kept, F.when(filled, packed).alias("_extra"))


def stamp_extract(df: DataFrame, collection: str, mode: str, as_of: str | None = None) -> DataFrame:
    return df.withColumns(
        {
            "_id": F.coalesce(F.col("_id").cast("string"), F.lit("")),
            "_collection": F.lit(collection),
            "_extracted_at": times.moment(as_of),
            "_storage_mode": F.lit(mode),
        }
    )


def extract_documents(df: DataFrame, collection: str, mode: str = "files", as_of: str | None = None) -> DataFrame:
    """All steps for one collection: hash, pack unknown fields, flatten, stamp."""
    hashed = hash_pii(df)
    known = ["_id", *V.PROFILE_FIELDS, *[f"{c}_hash" for c in V.PII_FIELDS]]
    flat = flatten_nested(pack_extra(hashed, known))
    return stamp_extract(flat, collection, mode, as_of)
