"""Declared output schemas: ``Column(name, type, comment)`` lists, enforced by ``conform``."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Col(NamedTuple):
    name: str
    type: str = "string"
    comment: str = ""


S = "string"
QTY = "decimal(18,3)"
QTY13 = "decimal(13,3)"
PRICE = "decimal(18,4)"
VALUE = "decimal(18,2)"
DAYS = "decimal(5,0)"


def cols(spec: str | Sequence) -> list[Col]:
    """Build a column list; plain names default to string."""
    out = []
    for item in spec:
        out.append(Col(item) if isinstance(item, str) else Col(*item))
    return out


def struct_type(schema: Sequence[Col]) -> T.StructType:
    ddl = ", ".join(f"`{c.name}` {c.type}" for c in schema)
    st = T._parse_datatype_string(ddl)
    return T.StructType([T.StructField(f.name, f.dataType, True, {"comment": c.comment} if c.comment else {})
                         for f, c in zip(st.fields, schema)])


def conform(df: DataFrame, schema: Sequence[Col]) -> DataFrame:
    """Final projection: declared column order and types (explicit casts, no silent widening)."""
    return df.select(*[F.col(c.name).cast(c.type).alias(c.name) for c in schema])


def conform_known(df: DataFrame, schema: Sequence[Col]) -> DataFrame:
    """Columns of ``df`` that ``schema`` declares in their declared types, the others as they are.

    For parts of a mart, so that the casts of :func:`conform` are made before a join multiplies the rows.
    """
    types = {c.name: c.type for c in schema}
    return df.select(*[F.col(n).cast(types[n]).alias(n) if n in types else F.col(n) for n in df.columns])
