"""Schema contracts: which columns a layer needs, what was added, and which types moved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIFT_SCHEMA = T.StructType(
    [
        T.StructField("column", T.StringType(), False),
        T.StructField("change", T.StringType(), False),
        T.StructField("expected", T.StringType()),
        T.StructField("found", T.StringType()),
    ]
)

# Casts that keep every value, so that months written with a narrower type still agree.
_LOSSLESS = {
    (T.ByteType, T.IntegerType),
    (T.ByteType, T.LongType),
    (T.ShortType, T.IntegerType),
    (T.ShortType, T.LongType),
    (T.IntegerType, T.LongType),
    (T.IntegerType, T.DoubleType),
    (T.FloatType, T.DoubleType),
}


class ContractError(ValueError):
    """A frame lacks columns its layer needs, or has them in other types."""


def missing_columns(schema: T.StructType, contract: T.StructType) -> list[str]:
    found = set(schema.fieldNames())
    return [name for name in contract.fieldNames() if name not in found]


def added_columns(schema: T.StructType, contract: T.StructType) -> list[str]:
    known = set(contract.fieldNames())
    return [name for name in schema.fieldNames() if name not in known]


def check_contract(df: DataFrame, contract: T.StructType, where: str) -> None:
    """Raise ``ContractError`` unless every contract column exists under its exact name.

    Names are compared with their case. A column that differs only by case is named in the error,
    since Spark would resolve it while other readers of the files would not.
    """
    missing = missing_columns(df.schema, contract)
    if not missing:
        return
    by_lower = {name.lower(): name for name in df.columns}
    described = [
        f"{name} (found {by_lower[name.lower()]})" if name.lower() in by_lower else name
        for name in missing
    ]
    raise ContractError(f"{where}: missing required columns: {', '.join(described)}")


def check_types(df: DataFrame, contract: T.StructType, where: str) -> None:
    """Raise ``ContractError`` if a contract column that ``df`` has is of another type.

    Months of different types could not be read as one table, so this comes before any write.
    """
    wrong = [f"{name} (expected {expected}, found {found})"
             for name, change, expected, found in drift_rows(df.schema, contract)
             if change == "type"]
    if wrong:
        raise ContractError(f"{where}: columns of another type: {', '.join(wrong)}")


def drift_rows(schema: T.StructType, contract: T.StructType) -> list[tuple]:
    rows = [(c, "missing", contract[c].dataType.simpleString(), None)
            for c in missing_columns(schema, contract)]
    rows += [(c, "added", None, schema[c].dataType.simpleString())
             for c in added_columns(schema, contract)]
    for field in contract.fields:
        if field.name in schema.fieldNames():
            found = schema[field.name].dataType
            if found != field.dataType:
                rows.append((field.name, "type", field.dataType.simpleString(),
                             found.simpleString()))
    return rows


def drift_report(df: DataFrame, contract: T.StructType) -> DataFrame:
    """One row per column that is missing, added, or of another type than the contract's."""
    return df.sparkSession.createDataFrame(drift_rows(df.schema, contract), DRIFT_SCHEMA)


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Widen contract columns to their contract type where that keeps every value.

    Other type differences are left as they are, for ``check_types`` to report.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    widened = {
        f.name: F.col(f"`{f.name}`").cast(f.dataType)
        for f in contract.fields
        if f.name in types and (type(types[f.name]), type(f.dataType)) in _LOSSLESS
    }
    return df.withColumns(widened) if widened else df


def local_times(df: DataFrame, contract: T.StructType) -> DataFrame:
    """TIMESTAMP columns that the contract holds without a zone, as local times of the session's.

    Apart from ``conform``, because rules compare such columns in their own type so that they reach
    the scan.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    local = {
        f.name: F.col(f"`{f.name}`").cast(f.dataType)
        for f in contract.fields
        if f.dataType == T.TimestampNTZType() and types.get(f.name) == T.TimestampType()
    }
    return df.withColumns(local) if local else df
