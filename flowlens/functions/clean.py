"""Column-level cleaning: numeric coercion, label coercion, absent columns.

All expressions are built-in Spark functions, so they stay inside whole-stage
codegen. ANSI mode is on in Spark 4, so a plain ``cast`` of junk text raises;
coercion goes through a strict pattern and ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text accepted as a number (after trim + lower-case). Spark's own cast also
# takes "1d" / "1.5f" and DuckDB takes "1_000"; neither is a number for a
# pandas-style parser, so the pattern decides first.
NUMERIC_TEXT = r"^[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)$"


def col(name: str) -> Column:
    """Reference a column whose name may hold dots or dashes."""
    return F.col("`" + name.replace("`", "``") + "`")


def parse_number(c: Column) -> Column:
    """Text -> double; anything that is not a plain number gives null."""
    t = F.lower(F.trim(c))
    return F.when(t.rlike(NUMERIC_TEXT), t.try_cast("double"))


def to_double(c: Column, dtype: T.DataType) -> Column:
    """pandas ``to_numeric(errors='coerce')`` then ``fillna(0.0)``: null/NaN/junk -> 0.0."""
    if isinstance(dtype, T.StringType):
        v = parse_number(c)
    elif isinstance(dtype, T.BooleanType):
        v = c.cast("double")
    elif isinstance(dtype, T.NumericType):
        v = c.cast("double")
    else:
        v = c.try_cast("double")
    return F.coalesce(F.nanvl(v, F.lit(0.0)), F.lit(0.0))


def to_label(c: Column, dtype: T.DataType) -> Column:
    """Label coercion: numeric coercion, null -> 0, truncation toward zero to int."""
    return F.coalesce(to_double(c, dtype).try_cast("int"), F.lit(0))


def coercion_counts(df: DataFrame, columns) -> list[Column]:
    """Aggregates to observe while a table is read: for each column
    ``<column>_missing`` (null, NaN or blank) and ``<column>_coerced`` (there, but no
    number, so that 0 stands for it)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in columns:
        v = col(c)
        if isinstance(types[c], T.StringType):
            blank = F.coalesce(F.trim(v) == "", F.lit(True))
            number = parse_number(v)
        else:
            blank = v.isNull() | F.isnan(v) if isinstance(types[c], (T.DoubleType, T.FloatType)) else v.isNull()
            number = v.cast("double") if isinstance(types[c], (T.NumericType, T.BooleanType)) else v.try_cast("double")
        lost = number.isNull() | F.isnan(number)
        out += [F.count_if(blank).alias(f"{c}_missing"), F.count_if(~blank & lost).alias(f"{c}_coerced")]
    return out


def coerce_numeric(df: DataFrame, columns) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: to_double(col(c), types[c]) for c in columns if c in types})


def ensure_columns(df: DataFrame, columns, value: float = 0.0) -> DataFrame:
    """Absent columns are added as a constant (default 0.0)."""
    missing = [c for c in columns if c not in df.columns]
    return df.withColumns({c: F.lit(value) for c in missing}) if missing else df


def drop_labels(df: DataFrame, labels=("y_binary", "y_multiclass")) -> DataFrame:
    return df.drop(*labels)


def missing_columns(df: DataFrame, columns) -> list[str]:
    """Required names absent from the frame, in the given order."""
    have = set(df.columns)
    return [c for c in columns if c not in have]
