"""Bronze operators: window, flatten and stamp raw feed features. Reshape only: no
cleaning, no dedup, arrays untouched, no property lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.config import FEED_SOURCE_TAG
from ticketflow.functions.columns import in_window
from ticketflow.sources.feed import PROPERTIES


def window_filter(df: DataFrame, start, end, column: str = "last_activity") -> DataFrame:
    """Rows with ``start <= column < end``. Bounds are literals or per-row columns;
    compared in the column's type (text for raw feed timestamps), so a re-run with the
    same bounds returns the same rows and adjacent windows never share a row."""
    return df.where(in_window(column, start, end))


def lift(properties: Column, field: T.StructField) -> Column:
    """One declared property out of a map of raw JSON values, in its declared type."""
    raw = properties[field.name]
    kind = field.dataType
    if isinstance(kind, T.StringType):
        return raw
    if isinstance(kind, T.ArrayType | T.StructType | T.MapType):
        return F.from_json(raw, kind)
    return raw.try_cast(kind)


def flatten_features(df: DataFrame, feature: str | None = None, keep=(),
                     schema: T.StructType = PROPERTIES, extra: str = "extra") -> DataFrame:
    """GeoJSON features -> one flat row each: the properties of ``schema`` as typed columns,
    every other property in the map ``extra``, plus ``lon`` and ``lat`` from the point
    coordinates. ``feature`` names a struct column holding ``geometry``/``properties``
    (default: they are top-level columns). Properties that are a struct already are lifted
    as they are. A missing geometry or a short coordinate array gives null coordinates; a
    value that does not fit its declared type gives null."""
    prefix = f"{feature}." if feature else ""
    properties = F.col(f"{prefix}properties")
    if isinstance(df.select(properties).schema[0].dataType, T.MapType):
        known = [f.name for f in schema]
        lifted = [lift(properties, f).alias(f.name) for f in schema]
        lifted.append(F.map_filter(properties, lambda k, _: ~k.isin(known)).alias(extra))
    else:
        lifted = [F.col(f"{prefix}properties.*")]
    coords = F.col(f"{prefix}geometry.coordinates")
    return df.select(
        *keep,
        *lifted,
        F.try_element_at(coords, F.lit(1)).alias("lon"),
        F.try_element_at(coords, F.lit(2)).alias("lat"),
    )


def stamp_load_metadata(df: DataFrame, run_id: str | Column, source: str = FEED_SOURCE_TAG,
                        ingested_at: str | Column | None = None) -> DataFrame:
    """Add ``_ingested_at`` (UTC ISO-8601 text), ``_source`` and ``_run_id``.

    ``ingested_at`` defaults to the load time (the query's start, in UTC); pass a logical
    time to make a re-run byte-identical. A null or blank run id is an error, for a
    column on the first such row."""
    if run_id is None or (isinstance(run_id, str) and not run_id.strip()):
        raise ValueError("run_id is required")
    if ingested_at is None:
        utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
        at = F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    else:
        at = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
    run = F.lit(run_id)
    if isinstance(run_id, Column):
        blank = run_id.isNull() | (F.trim(run_id) == "")
        run = F.when(blank, F.raise_error(F.lit("run_id is required")).cast("string")).otherwise(run_id)
    return df.withColumns({"_ingested_at": at, "_source": F.lit(source), "_run_id": run})
