"""Field and collection definitions, and their mapping to Spark types.

A collection is described by an ordered list of typed fields. The definition is
stored as JSON next to the data (see ``sources.catalog``) and never inferred
from rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import types as T

from vectable.plans.errors import SchemaError, UnsupportedTypeError

PARTITION_COLUMN = "__partition"
DEFAULT_PARTITION = "_default"

# The field types a collection may declare and the Spark type of each.
SCALAR_TYPES: dict[str, T.DataType] = {
    "Bool": T.BooleanType(),
    "Int8": T.ByteType(),
    "Int16": T.ShortType(),
    "Int32": T.IntegerType(),
    "Int64": T.LongType(),
    "Float": T.FloatType(),
    "Double": T.DoubleType(),
    "String": T.StringType(),
    "VarChar": T.StringType(),
    "JSON": T.StringType(),
}
ELEMENT_TYPES = tuple(name for name in SCALAR_TYPES if name != "JSON")
VECTOR_TYPES: dict[str, T.DataType] = {
    "BinaryVector": T.ArrayType(T.ByteType()),
    "FloatVector": T.ArrayType(T.FloatType()),
    "Float16Vector": T.ArrayType(T.ByteType()),
    "BFloat16Vector": T.ArrayType(T.ByteType()),
    "SparseFloatVector": T.MapType(T.LongType(), T.FloatType()),
}
METRICS = ("COSINE", "IP", "HAMMING")


@dataclass(frozen=True)
class Field:
    """One field of a collection.

    ``max_length`` counts characters, ``max_capacity`` array elements and ``dim``
    vector dimensions. ``auto_id`` fields are filled by the append;
    ``function_output`` fields are neither read nor written. ``metric`` names the
    similarity a vector field is meant to be searched by.
    """

    name: str
    type: str
    element_type: str | None = None
    nullable: bool = False
    description: str = ""
    primary_key: bool = False
    auto_id: bool = False
    max_length: int | None = None
    max_capacity: int | None = None
    dim: int | None = None
    metric: str | None = None
    function_output: bool = False

    def __post_init__(self) -> None:
        self.spark_type  # raises for a type collections cannot hold
        if self.name.lower() == PARTITION_COLUMN:
            raise SchemaError(f"field name {PARTITION_COLUMN} is reserved")
        if not self.name:
            raise SchemaError("a field needs a name")
        if self.type in VECTOR_TYPES and self.type != "SparseFloatVector" and not self.dim:
            raise SchemaError(f"vector field {self.name} needs a dim")
        if self.type == "BinaryVector" and self.dim % 8:
            raise SchemaError(f"binary vector field {self.name} needs a dim divisible by 8: {self.dim}")
        if self.primary_key and self.type not in ("Int64", "VarChar"):
            raise SchemaError(f"primary key {self.name} must be Int64 or VarChar, not {self.type}")
        if self.primary_key and (self.nullable or self.function_output):
            raise SchemaError(f"primary key {self.name} can be neither nullable nor a function output")
        if self.auto_id and not (self.primary_key and self.type == "Int64"):
            raise SchemaError(f"auto_id field {self.name} must be an Int64 primary key")
        if self.metric is not None and (self.metric not in METRICS or self.type not in VECTOR_TYPES):
            raise SchemaError(f"field {self.name} cannot have the metric {self.metric}")

    @property
    def spark_type(self) -> T.DataType:
        if self.type == "Array":
            if self.element_type not in ELEMENT_TYPES:
                raise UnsupportedTypeError(
                    f"Unsupported array element data type: {self.element_type} in field: {self.name}"
                )
            return T.ArrayType(SCALAR_TYPES[self.element_type])
        known = SCALAR_TYPES.get(self.type) or VECTOR_TYPES.get(self.type)
        if known is None:
            raise UnsupportedTypeError(f"Unsupported data type: {self.type} in field: {self.name}")
        return known

    @property
    def vector_length(self) -> int | None:
        """Stored array length of a dense, binary or half-precision vector."""
        per_dim = {"FloatVector": 1, "Float16Vector": 2, "BFloat16Vector": 2}
        if self.type == "BinaryVector":
            return self.dim // 8
        return self.dim * per_dim[self.type] if self.type in per_dim else None

    @property
    def struct_field(self) -> T.StructField:
        metadata = {"comment": self.description} if self.description else {}
        return T.StructField(self.name, self.spark_type, self.nullable, metadata)


@dataclass(frozen=True)
class CollectionSchema:
    """The definition of one collection: its fields in declared order."""

    fields: tuple[Field, ...]
    description: str = field(default="")

    def __init__(self, fields: Iterable[Field], description: str = "") -> None:
        object.__setattr__(self, "fields", tuple(fields))
        object.__setattr__(self, "description", description)
        names = [f.name.lower() for f in self.fields]
        if not self.visible_fields:
            raise SchemaError("a collection needs at least one readable field")
        if len(set(names)) != len(names):
            raise SchemaError(f"field names repeat: {[f.name for f in self.fields]}")
        if sum(f.primary_key for f in self.fields) > 1:
            raise SchemaError("a collection has at most one primary key")

    def __getitem__(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise SchemaError(f"no field {name} in the collection")

    @property
    def visible_fields(self) -> tuple[Field, ...]:
        """Fields a read returns: all but function outputs."""
        return tuple(f for f in self.fields if not f.function_output)

    @property
    def insert_fields(self) -> tuple[Field, ...]:
        """Fields a write takes from the caller: no function outputs, no auto ids."""
        return tuple(f for f in self.visible_fields if not f.auto_id)

    @property
    def function_outputs(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields if f.function_output)

    @property
    def auto_id_field(self) -> Field | None:
        return next((f for f in self.fields if f.auto_id), None)

    @property
    def struct(self) -> T.StructType:
        """Spark schema of a read: visible fields in order, then the partition tag."""
        fields = [f.struct_field for f in self.visible_fields]
        return T.StructType([*fields, T.StructField(PARTITION_COLUMN, T.StringType(), False)])

    def to_json(self, version: str = "") -> str:
        return json.dumps(
            {"description": self.description, "version": version, "fields": [asdict(f) for f in self.fields]},
            indent=1,
        )

    @classmethod
    def from_json(cls, text: str) -> CollectionSchema:
        stored = json.loads(text)
        return cls([Field(**f) for f in stored["fields"]], stored["description"])
