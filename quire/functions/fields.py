"""Column identity: each column has an id for life and a name in the data files.

A rename gives the id another name, a drop retires it, and a column that is added under a name that was
dropped gets an id and a stored name of its own, so old files never show through. Ids are
written to the Parquet footers as field ids; files are read by stored names, which no two ids
share, so filters reach the files whatever the columns are called now.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StructField, StructType

from quire.functions.schemas import canonical, widens

FIELD_ID = "parquet.field.id"  # the metadata key under which Spark writes a field id


@dataclass
class Fields:
    """Ids and stored names of a dataset's columns by their names."""

    ids: dict[str, int] = field(default_factory=dict)
    stored: dict[str, str] = field(default_factory=dict)
    next_id: int = 1
    used: set[str] = field(default_factory=set)  # stored names in live files, in lower case

    @classmethod
    def parse(cls, text: str | None, schema: StructType) -> "Fields":
        """As written with a commit; commits from before ids number their columns in order."""
        if text is None:
            return cls().extended(schema)
        d = json.loads(text)
        return cls({n: c[0] for n, c in d["columns"].items()}, {n: c[1] for n, c in d["columns"].items()}, d["next"], set(d["used"]))

    def text(self) -> str:
        columns = {n: [i, self.stored[n]] for n, i in self.ids.items()}
        return json.dumps({"columns": columns, "next": self.next_id, "used": sorted(self.used)}, ensure_ascii=False)

    def _copy(self) -> "Fields":
        return Fields(dict(self.ids), dict(self.stored), self.next_id, set(self.used))

    def extended(self, schema: StructType) -> "Fields":
        """With ids for the columns of ``schema`` that have none yet."""
        out = self._copy()
        for name in schema.fieldNames():
            if name in out.ids:
                continue
            number, stored = out.next_id, name
            while stored.lower() in out.used:
                stored = f"{stored}__{number}"
            out.ids[name], out.stored[name], out.next_id = number, stored, number + 1
            out.used.add(stored.lower())
        return out

    def renewed(self, old: StructType, new: StructType) -> "Fields":
        """For files of a new schema that replace all others: a column keeps its id if it has the
        same name and its values can be read as the new type."""
        before = {f.name: f.dataType for f in old.fields}
        out = Fields(next_id=self.next_id)
        for f in new.fields:
            if f.name in before and f.name in self.ids and (canonical(before[f.name]) == canonical(f.dataType) or widens(before[f.name], f.dataType)):
                number = self.ids[f.name]
            else:
                number, out.next_id = out.next_id, out.next_id + 1
            out.ids[f.name], out.stored[f.name] = number, f.name
            out.used.add(f.name.lower())
        return out

    def renamed(self, old: str, new: str) -> "Fields":
        out = self._copy()
        names = [(new if n == old else n) for n in out.ids]
        out.ids = dict(zip(names, out.ids.values()))
        out.stored = {(new if n == old else n): s for n, s in out.stored.items()}
        return out

    def dropped(self, name: str) -> "Fields":
        out = self._copy()
        del out.ids[name], out.stored[name]
        return out

    def stored_schema(self, schema: StructType) -> StructType:
        """The schema of the files."""
        return StructType([StructField(self.stored[f.name], f.dataType, True, f.metadata) for f in schema.fields])

    def to_files(self, schema: StructType) -> list[Column]:
        """Columns of a frame under their stored names, with their ids."""
        return [
            F.col(f"`{f.name}`").alias(self.stored[f.name], metadata={**f.metadata, FIELD_ID: self.ids[f.name]}) for f in schema.fields
        ]

    def from_files(self, schema: StructType) -> list[Column]:
        return [F.col(f"`{self.stored[f.name]}`").alias(f.name, metadata=f.metadata) for f in schema.fields]
