"""Bring differently shaped inputs to the one canonical schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from vidlake.functions.dates import date_parts, publish_date, run_date_text
from vidlake.functions.numbers import lenient_long
from vidlake.schemas import BRONZE_NAMES, CANONICAL, CSV_NAMES, METRICS


def apply_mapping(df: DataFrame, names: Mapping[str, str], type_name: str = "string") -> DataFrame:
    """Keep, rename and type the mapped columns. A mapped column the input
    lacks is left out; columns that are not mapped are dropped."""
    present = set(df.columns)
    return df.select(
        *(
            F.col(source).cast(type_name).alias(target)
            for source, target in names.items()
            if source in present
        )
    )


def fill_text(df: DataFrame, column: str, value: str = "") -> DataFrame:
    """Give the column the default where it is absent or NULL."""
    if column not in df.columns:
        return df.withColumn(column, F.lit(value))
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def align(df: DataFrame, columns: Sequence[str] = CANONICAL) -> DataFrame:
    """Exactly these columns in this order; an absent one is an error."""
    return df.select(*columns)


def type_metrics(df: DataFrame) -> DataFrame:
    """The three counters as bigint, NULL where the text is not an integer."""
    return df.withColumns({name: lenient_long(F.col(name)) for name in METRICS})


def add_publish_parts(df: DataFrame) -> DataFrame:
    """Partition columns from the publish date, NULL where it cannot be read."""
    return df.withColumns(date_parts(publish_date(df)))


def stamp_run_date(df: DataFrame, run_date: dt.date) -> DataFrame:
    """Mark every row with the day it was extracted on."""
    return df.withColumn("extraction_date", run_date_text(run_date))


def unified(
    historical: DataFrame | None = None, bronze: DataFrame | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """UNION ALL of the mapped inputs in canonical shape, all columns text; columns
    to keep, which both inputs have, come last."""
    own = {name: name for name in keep}
    columns = (*CANONICAL, *keep)
    parts = []
    if historical is not None:
        parts.append(historical.transform(apply_mapping, {**CSV_NAMES, **own}).transform(align, columns))
    if bronze is not None:
        mapped = bronze.transform(apply_mapping, {**BRONZE_NAMES, **own})
        parts.append(mapped.transform(fill_text, "description").transform(align, columns))
    if not parts:
        raise ValueError("at least one input is needed")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def silver_rows(
    historical: DataFrame | None = None, bronze: DataFrame | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Rows of the silver table. There is no key operator in it, so Spark runs it
    without a shuffle."""
    return unified(historical, bronze, keep).transform(type_metrics).transform(add_publish_parts)
