"""Declarative table definitions (YAML) compiled to Spark schemas, DDL and printable source."""

from __future__ import annotations

import re
import textwrap
from pathlib import Path

import yaml
from pyspark.sql import types as T

DEFAULT_TABLES = ("SSObject", "SSSource", "mpc_orbits", "current_identifications", "numbered_identifications")
#: Datatype names.
_SIMPLE = {
    T.ByteType(): ("int8",),
    T.ShortType(): ("int16", "short", "uint8"),
    T.IntegerType(): ("int32", "int", "uint16"),
    T.LongType(): ("int64", "long", "bigint", "uint32"),
    T.DecimalType(20, 0): ("uint64",),
    T.FloatType(): ("float32", "float"),
    T.DoubleType(): ("float64", "double"),
    T.BooleanType(): ("bool", "boolean"),
    T.TimestampNTZType(): ("timestamp",),
}
_BY_NAME = {name: kind for kind, names in _SIMPLE.items() for name in names}
_TEXT = ("string", "unicode", "str", "char")


def column_type(column: dict) -> T.DataType:
    """Unknown datatypes become strings; timestamps finer than microseconds keep microseconds."""
    if not column.get("datatype"):
        raise ValueError(f"column {column.get('name')!r} has no datatype")
    name = str(column["datatype"]).lower()
    if name == "timestamp" and not isinstance(column.get("precision", 6), int):
        raise ValueError(f"column {column.get('name')!r}: precision must be an integer")
    if name in _TEXT:
        return T.VarcharType(int(column["length"])) if column.get("length") else T.StringType()
    return _BY_NAME.get(name, T.StringType())


def comment_of(column: dict) -> str:
    unit, text = column.get("ivoa:unit"), " ".join(str(column.get("description") or "").split())
    return " ".join(x for x in (f"[{unit}]" if unit else "", text) if x)


def compile_table(table: dict) -> T.StructType:
    if not table.get("columns"):
        raise ValueError(f"table {table.get('name')!r} has no columns")
    fields = []
    for column in table["columns"]:
        meta = {k: v for k, v in (("comment", comment_of(column)), ("unit", column.get("ivoa:unit"))) if v}
        fields.append(T.StructField(column["name"], column_type(column), True, meta))
    return T.StructType(fields)


def load_tables(path: str | Path) -> dict[str, dict]:
    with open(path) as lines:
        return {table["name"]: table for table in yaml.safe_load(lines)["tables"]}


def ddl(name: str, schema: T.StructType, provider: str = "parquet") -> str:
    """CREATE TABLE with comments; varchar bounds stay."""
    rows = []
    for field in schema.fields:
        kind = field.dataType.simpleString()
        comment = field.metadata.get("comment", "").replace("'", "''")
        rows.append(f"  `{field.name}` {kind.upper()}" + (f" COMMENT '{comment}'" if comment else ""))
    return f"CREATE TABLE {name} (\n" + ",\n".join(rows) + f"\n) USING {provider}"


def postgres_ddl(name: str, schema: T.StructType) -> str:
    kinds = {"tinyint": "smallint", "float": "real", "double": "double precision", "string": "text", "int": "integer", "timestamp_ntz": "timestamp"}
    rows = []
    for f in schema.fields:
        kind = f.dataType.simpleString()
        rows.append(f"  {f.name} " + re.sub(r"^decimal\((.*)\)$", r"numeric(\1)", kinds.get(kind, kind)))
    return f"CREATE TABLE {name} (\n" + ",\n".join(rows) + "\n)"


def render(name: str, schema: T.StructType, description: str | None = None, comment_column: int = 36, width: int = 110) -> str:
    """Python source of the schema. Comments start at one column; where fields are longer, at the longest of the run of
    long fields so far; they wrap to two lines at most, the rest becomes an ellipsis."""
    out = [f"# {line}" for line in textwrap.wrap(f"{name}: {description}", width - 3)] if description else []
    out.append(f"{name} = StructType([")
    column, running = comment_column, None
    for field in schema.fields:
        code = f"    StructField({field.name!r}, {field.dataType!r}),"
        if len(code) < comment_column:
            column, running = comment_column, None
        else:
            column = running = max(len(code) + 1, running or 0)
        comment = field.metadata.get("comment", "")
        if not comment:
            out.append(code)
            continue
        room = max(10, width - 1 - column - 2)
        lines = textwrap.wrap(comment, room, break_long_words=False) or [""]
        if len(lines) > 2:
            lines = [lines[0], (lines[1] if len(lines[1]) + 3 <= room else lines[1][: room - 3].rstrip()) + "..."]
        out.append(f"{code:<{column}}# {lines[0]}")
        out += [" " * column + f"# {line}" for line in lines[1:]]
    return "\n".join([*out, "])"])
