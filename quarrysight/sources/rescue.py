"""Rescued data for JSON lines read against a fixed schema.

``_rescued_data`` holds, as a JSON object, the fields of a line that did not
fit the schema - keys the schema does not declare and values that failed
their type, also inside structs and arrays, under their path (``a.b``,
``a[2].c``) - or the whole line when it is not a JSON object at all. It is
NULL for a clean line. A JSON ``null`` is not rescued.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

_MISFITS = "array<struct<path:string,raw:string>>"
_RAW = "map<string,string>"


def _nothing() -> Column:
    return F.array().cast(_MISFITS)


def _whole(path: Column, raw: Column) -> Column:
    return F.array(F.struct(path.alias("path"), raw.alias("raw"))).cast(_MISFITS)


def _in_value(raw: Column, typed: Column, kind: DataType, path: Column) -> Column:
    """What of a value's JSON text did not get into its typed form."""
    if isinstance(kind, StructType):
        inner = F.from_json(raw, _RAW, {"mode": "PERMISSIVE"})
        fits = _in_object(inner, typed, kind, F.concat(path, F.lit(".")))
        misfit = inner.isNull()
    elif isinstance(kind, ArrayType):
        inner = F.from_json(raw, "array<string>", {"mode": "PERMISSIVE"})
        fits = F.flatten(F.transform(inner, lambda x, i: _in_value(
            x, F.get(typed, i), kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))))
        misfit = inner.isNull()
    else:
        fits, misfit = _nothing(), typed.isNull()
    return F.when(raw.isNull(), _nothing()).when(misfit, _whole(path, raw)).otherwise(fits)


def _in_object(raw: Column, typed: Column, schema: StructType, prefix: Column) -> Column:
    """The same of an object, in the order of its keys."""

    def entry(e: Column) -> Column:
        path = F.concat(prefix, e["key"])
        out = None
        for f in schema.fields:
            value = _in_value(e["value"], typed[f.name], f.dataType, path)
            out = F.when(e["key"] == f.name, value) if out is None else out.when(e["key"] == f.name, value)
        unknown = F.when(e["value"].isNull(), _nothing()).otherwise(_whole(path, e["value"]))
        return unknown if out is None else out.otherwise(unknown)

    return F.flatten(F.transform(F.map_entries(raw), entry))


def rescue_json(lines: DataFrame, schema: StructType, value_col: str = "value") -> DataFrame:
    """Parse ``value_col`` into the schema's columns plus ``_rescued_data``. Of a key that
    stands in a line twice the first misfit is kept."""
    v = F.col(value_col)
    tmp = lines.withColumns({"_p": F.from_json(v, schema, {"mode": "PERMISSIVE"}), "_m": F.from_json(v, _RAW, {"mode": "PERMISSIVE"})})
    tmp = tmp.withColumn("_bad", _in_object(F.col("_m"), F.col("_p"), schema, F.lit("")))
    paths = F.transform("_bad", lambda b: b["path"])
    first = F.filter("_bad", lambda b, i: F.array_position(paths, b["path"]) == i + 1)
    rescued = (
        F.when(F.col("_m").isNull() & v.isNotNull() & (F.length(F.trim(v)) > 0), v)
        .when(F.size("_bad") > 0, F.to_json(F.map_from_entries(first)))
    )
    return tmp.select(*[F.col("_p")[f.name].alias(f.name) for f in schema.fields], rescued.alias("_rescued_data"),
                      *[c for c in lines.columns if c != value_col])
