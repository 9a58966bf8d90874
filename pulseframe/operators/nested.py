"""Type conversion that follows nested types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _double_type(t: T.DataType) -> T.DataType:
    if isinstance(t, T.DecimalType):
        return T.DoubleType()
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_double_type(t.elementType), t.containsNull)
    if isinstance(t, T.MapType):
        return T.MapType(_double_type(t.keyType), _double_type(t.valueType), t.valueContainsNull)
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _double_type(f.dataType), f.nullable) for f in t])
    return t


def decimals_to_double(df: DataFrame) -> DataFrame:
    """DECIMAL -> DOUBLE at any depth of arrays, maps and structs. A cast between
    nested types converts element by element inside the JVM; columns without a decimal
    are passed as they are."""

    def convert(field: T.StructField) -> Column:
        wanted = _double_type(field.dataType)
        col = F.col(f"`{field.name}`")
        return col if wanted == field.dataType else col.cast(wanted).alias(field.name)

    return df.select(*[convert(f) for f in df.schema])
