"""Uniform access to the named values of a record.

A record is either *flat* (one column per field, the same for all rows; a
``_present`` array can narrow which fields a row really has) or *ragged* (one
``map<string,string>`` column, each row with its own keys). Absent and null differ:
a field rule is skipped on an absent field but sees a null one.

Values that came from JSON are texts too; a map from names to kinds beside them tells
which were numbers, booleans, objects or arrays.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.numbers import decimal_to_double, to_double

PRESENT = "_present"
KINDS = "kinds"
META = (
    "row_id",
    "file_id",
    "line_number",
    "source_name",
    "batch_id",
    "raw",
    "raw_kinds",
    "normalized",
    "status",
    "validation_errors",
    "mapping_confidence",
    PRESENT,
    KINDS,
)

ERROR_TYPE = "struct<field:string,fields:string,rule:string,message:string>"
NO_ERRORS = f"array<{ERROR_TYPE}>"


@dataclass(frozen=True)
class Fields:
    """Field name -> value column, with presence per row."""

    types: dict[str, str]
    map_column: str | None = None
    present_column: str | None = None
    # helper columns that hold something about a field, filled by `staged`
    helpers: frozenset[str] = frozenset()
    kinds_column: str | None = None

    @staticmethod
    def flat(df: DataFrame, names: list[str] | None = None) -> "Fields":
        types = {
            f.name: f.dataType.simpleString()
            for f in df.schema.fields
            if (f.name not in META if names is None else f.name in names)
        }
        kinds = KINDS if KINDS in df.columns else None
        return Fields(types, None, PRESENT if PRESENT in df.columns else None, kinds_column=kinds)

    @staticmethod
    def ragged(map_column: str, kinds_column: str | None = None) -> "Fields":
        return Fields({}, map_column, kinds_column=kinds_column)

    def knows(self, name: str) -> bool:
        """False only when no row can have the field."""
        return self.map_column is not None or name in self.types

    def dtype(self, name: str) -> str:
        return "string" if self.map_column is not None else self.types[name]

    def value(self, name: str) -> Column:
        """The value; null when absent."""
        if helper("value", name) in self.helpers:
            return F.col(_quoted(helper("value", name)))
        if self.map_column is not None:
            return F.try_element_at(F.col(self.map_column), F.lit(name))
        if name not in self.types:
            return F.lit(None).cast("string")
        return F.col(_quoted(name))

    def has(self, name: str) -> Column | bool:
        """Presence: True or False when it is the same for all rows."""
        if helper("has", name) in self.helpers:
            return F.col(_quoted(helper("has", name)))
        if self.map_column is not None:
            return F.map_contains_key(F.col(self.map_column), F.lit(name))
        if name not in self.types:
            return False
        if self.present_column is None:
            return True
        return F.array_contains(F.col(self.present_column), name)

    def kind(self, name: str) -> Column | None:
        """What JSON had a text value as: number, boolean, object or array, null for a text.
        None where no row has anything but texts."""
        if self.kinds_column is None or not self.knows(name) or self.dtype(name) != "string":
            return None
        return F.try_element_at(F.col(self.kinds_column), F.lit(name))

    def text(self, name: str) -> Column:
        """The value as Python would print it; null stays null."""
        c = self.value(name)
        dtype = self.dtype(name) if self.knows(name) else "string"
        if dtype == "string":
            kind = self.kind(name)
            return c if kind is None else F.when(kind == "boolean", F.initcap(c)).otherwise(c)
        if dtype == "boolean":
            return F.initcap(c.cast("string"))
        return c.cast("string")

    def number(self, name: str) -> Column:
        """The value as double in Python's float grammar, null when it is no number."""
        if helper("number", name) in self.helpers:
            return F.col(_quoted(helper("number", name)))
        c = self.value(name)
        dtype = self.dtype(name) if self.knows(name) else "string"
        if dtype != "string":
            return c.cast("double")
        kind = self.kind(name)
        if kind is None:
            return to_double(c)
        return F.when(kind == "boolean", (c == "true").cast("double")).otherwise(to_double(c))

    def amount(self, name: str) -> Column:
        """The value as double in the decimal grammar, null when it is no number."""
        if helper("amount", name) in self.helpers:
            return F.col(_quoted(helper("amount", name)))
        c = self.value(name)
        return decimal_to_double(c) if self.dtype(name) == "string" else c.cast("double")

    def staged(
        self, df: DataFrame, values: set[str], numbers: set[str], amounts: set[str]
    ) -> tuple[DataFrame, "Fields"]:
        """Compute what several rules need once, in columns of a projection of its own.

        Ragged values are looked up once per field, numbers parsed once per field.
        """
        names, fields, out = set(self.helpers), self, df
        if self.map_column is not None and values:
            found = {}
            for n in sorted(values):
                found[helper("value", n)] = self.value(n)
                found[helper("has", n)] = as_column(self.has(n))
            out = out.withColumns(found)
            names |= set(found)
            fields = replace(self, helpers=frozenset(names))
        parsed = {helper("number", n): fields.number(n) for n in sorted(numbers) if fields.knows(n)}
        parsed |= {helper("amount", n): fields.amount(n) for n in sorted(amounts) if fields.knows(n)}
        if parsed:
            out = out.withColumns(parsed)
        return out, replace(self, helpers=frozenset(names | set(parsed)))

    def truthy(self, name: str) -> Column | bool:
        """Whether the value is set: not absent, null, empty, zero or false."""
        if not self.knows(name):
            return False
        c, dtype = self.value(name), self.dtype(name)
        if dtype == "string":
            filled, kind = F.coalesce(c != F.lit(""), F.lit(False)), self.kind(name)
            if kind is None:
                return filled
            return (
                F.when(c.isNull(), False)
                .when(kind == "boolean", c == "true")
                .when(kind == "number", F.coalesce(to_double(c) != 0, F.lit(True)))
                .when(kind.isin("object", "array"), ~c.isin("{}", "[]"))
                .otherwise(filled)
            )
        if dtype == "boolean":
            return F.coalesce(c, F.lit(False))
        if dtype.startswith(("array", "map")):
            return F.coalesce(F.size(c) > 0, F.lit(False))
        if dtype.startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")):
            return F.coalesce(c != F.lit(0), F.lit(False))
        return c.isNotNull()

    def present_names(self) -> Column:
        """The names a row has, as an array."""
        if self.map_column is not None:
            return F.map_keys(F.col(self.map_column))
        if self.present_column is not None:
            return F.col(self.present_column)
        return F.array(*[F.lit(n) for n in self.types]).cast("array<string>")


def helper(kind: str, name: str) -> str:
    """Name of a helper column for a field."""
    return f"__{kind}_{name}"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col(_quoted(name))


def both(a: Column | bool, b: Column | bool) -> Column | bool:
    """Logical and of two conditions that may be settled at plan time."""
    if a is False or b is False:
        return False
    if a is True:
        return b
    if b is True:
        return a
    return a & b


def as_column(condition: Column | bool) -> Column:
    return F.lit(condition) if isinstance(condition, bool) else condition

