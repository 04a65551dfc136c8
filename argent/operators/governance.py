"""PII tagging and masking.

Tags live in the column metadata (``StructField.metadata["pii_type"]``) and
are written into Parquet with the schema. Masking is a single ``select``
built from the schema: no scan-time logic, no UDF.

Column functions drop metadata (and a ``USING`` full join drops it too), so
:func:`tag_pii` is re-applied from the spec after transforms.
"""

from __future__ import annotations

from typing import Dict, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from argent.functions.exprs import PII_TYPES, is_privileged, mask_date, mask_string

PII_KEY = "pii_type"

# Tags of the customer master (the four the reference sets).
CUSTOMER_PII = {"EMAIL": "EMAIL", "PHONE": "PHONE", "FIRST_NAME": "FIRST_NAME", "LAST_NAME": "LAST_NAME"}


def tag_pii(df: DataFrame, tags: Dict[str, str]) -> DataFrame:
    """G1: attach a PII class to columns; the class must be in the vocabulary."""
    bad = {c: t for c, t in tags.items() if t not in PII_TYPES}
    if bad:
        raise ValueError(f"unknown PII type(s): {bad}")
    missing = [c for c in tags if c not in df.columns]
    if missing:
        raise ValueError(f"no such column(s): {missing}")
    out = df
    for c, t in tags.items():
        meta = dict(out.schema[c].metadata or {})
        meta[PII_KEY] = t
        out = out.withMetadata(c, meta)
    return out


def pii_columns(df: DataFrame) -> Dict[str, str]:
    """Tagged columns of a frame: name -> PII class."""
    return {f.name: f.metadata[PII_KEY] for f in df.schema.fields if f.metadata and PII_KEY in f.metadata}


def masked_view(df: DataFrame, roles: Iterable[str] = (), layer: str = "gold") -> DataFrame:
    """Tag-driven masking of a whole table, the mask picked by type.

    Strings get the mask text; dates and timestamps get 1 January of their
    year (same type kept). Masks apply at the gold layer only; bronze and
    silver keep the tags for lineage and return values as stored.
    """
    if layer != "gold" or is_privileged(roles):
        return df
    tagged = pii_columns(df)
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name not in tagged:
            cols.append(c)
        elif isinstance(f.dataType, StringType):
            cols.append(mask_string(c, roles).alias(f.name, metadata=f.metadata))
        elif isinstance(f.dataType, DateType):
            cols.append(mask_date(c, roles).alias(f.name, metadata=f.metadata))
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            cols.append(mask_date(c, roles).cast(f.dataType).alias(f.name, metadata=f.metadata))
        else:
            # Other types: no policy exists; NULL out rather than leak.
            cols.append(F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata))
    return df.select(*cols)
