"""Telling rows apart without relying on unique ids, and keeping a user's columns whatever they are called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def free_name(name: str, taken: list[str]) -> str:
    """name, with as many underscores before it as it takes to be none of `taken` (case doesn't tell columns apart)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def _holds_map(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return isinstance(kind, MapType) or isinstance(kind, ArrayType) and _holds_map(kind.elementType)


class Rows:
    """docs under names of our own: c0, c1, ... for its columns, `k` and `th` for a row's key, `id` and `text` for the two that matter.

    (k, th) are digests of the id and of the whole row, so nulls and repeated ids tell rows apart as any others do. Rows
    that are equal in every column stay indistinguishable and are treated alike. Maps are digested as JSON.
    """

    def __init__(self, docs: DataFrame, id_col: str, text_col: str):
        self.names = docs.columns
        self.id, self.text = (f"c{self.names.index(c)}" for c in (id_col, text_col))
        inner = docs.toDF(*[f"c{i}" for i in range(len(self.names))])
        hashed = [F.to_json(F.struct(f.name)) if _holds_map(f.dataType) else F.col(f.name) for f in inner.schema]
        self.df = inner.withColumns({"k": F.xxhash64(self.id), "th": F.xxhash64(*hashed)})

    def back(self, df: DataFrame, text: Column | None = None, **more: Column) -> DataFrame:
        """df's user columns under their own names, text in place of the text, and `more` under the first free form of their names."""
        out = [(text if text is not None and f"c{i}" == self.text else F.col(f"c{i}")).alias(c) for i, c in enumerate(self.names)]
        taken = list(self.names)
        for name, column in more.items():
            out.append(column.alias(free_name(name, taken)))
            taken.append(name)
        return df.select(*out)
