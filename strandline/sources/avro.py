"""Records as Avro binary with a schema id in front (a zero byte and four bytes of id), without the Avro connector.

The writer's schema is the declared struct: nullable fields are unions with null first, timestamps are milliseconds, and names
are taken over. Encoding and decoding run in Arrow batches; columns must not be of other types than those of `schemas`.
"""

from __future__ import annotations

import io
import json
import struct
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

MAGIC = 0
HEADERS = "array<struct<key:string,value:binary>>"


def avro_schema(kind: T.StructType, name: str) -> str:
    """The Avro schema (JSON) of a struct. Nested records are called after their field."""

    def of(t: T.DataType, nullable: bool, label: str) -> Any:
        plain = {T.StringType: "string", T.DoubleType: "double", T.LongType: "long", T.IntegerType: "int", T.BooleanType: "boolean"}
        if isinstance(t, T.StructType):
            own: Any = {"type": "record", "name": label, "fields": [{"name": f.name, "type": of(f.dataType, f.nullable, f"{label}_{f.name}"), **({"default": None} if f.nullable else {})} for f in t]}
        elif isinstance(t, T.ArrayType):
            own = {"type": "array", "items": of(t.elementType, False, label)}
        elif isinstance(t, T.TimestampType):
            own = {"type": "long", "logicalType": "timestamp-millis"}
        else:
            own = plain[type(t)]
        return ["null", own] if nullable else own

    return json.dumps(of(kind, False, name))


def _write_long(out: io.BytesIO, n: int) -> None:
    z = (n << 1) ^ (n >> 63)
    while z & ~0x7F:
        out.write(bytes([z & 0x7F | 0x80]))
        z >>= 7
    out.write(bytes([z]))


def _read_long(data: io.BytesIO) -> int:
    z = shift = 0
    while True:
        b = data.read(1)[0]
        z |= (b & 0x7F) << shift
        if not b & 0x80:
            return (z >> 1) ^ -(z & 1)
        shift += 7


def _codec(t: T.DataType, nullable: bool) -> tuple[Callable[[io.BytesIO, Any], None], Callable[[io.BytesIO], Any]]:
    """(write, read) of values of a type, as Arrow rows hold them; timestamps as epoch microseconds."""
    if isinstance(t, T.StructType):
        parts = [(f.name, *_codec(f.dataType, f.nullable)) for f in t]

        def write(out, v):
            for name, w, _ in parts:
                w(out, v[name])

        read = lambda data: {name: r(data) for name, _, r in parts}
    elif isinstance(t, T.ArrayType):
        w_item, r_item = _codec(t.elementType, False)

        def write(out, v):
            if len(v):
                _write_long(out, len(v))
                for x in v:
                    w_item(out, x)
            _write_long(out, 0)

        def read(data):
            items: list = []
            while n := _read_long(data):
                if n < 0:  # a block with its size in bytes
                    n, _ = -n, _read_long(data)
                items += [r_item(data) for _ in range(n)]
            return items

    elif isinstance(t, T.StringType):

        def write(out, v):
            raw = v.encode()
            _write_long(out, len(raw))
            out.write(raw)

        read = lambda data: data.read(_read_long(data)).decode()
    elif isinstance(t, T.DoubleType):
        write, read = lambda out, v: out.write(struct.pack("<d", v)), lambda data: struct.unpack("<d", data.read(8))[0]
    elif isinstance(t, T.BooleanType):
        write, read = lambda out, v: out.write(b"\x01" if v else b"\x00"), lambda data: data.read(1) == b"\x01"
    elif isinstance(t, T.TimestampType):
        write, read = lambda out, v: _write_long(out, v // 1000), lambda data: _read_long(data) * 1000
    else:
        write, read = lambda out, v: _write_long(out, int(v)), _read_long
    if not nullable:
        return write, read

    def write_or_null(out, v):
        _write_long(out, 0 if v is None else 1)
        if v is not None:
            write(out, v)

    return write_or_null, lambda data: read(data) if _read_long(data) else None


def _flat(t: T.DataType) -> T.DataType:
    """The type with timestamps as epoch microseconds."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _flat(f.dataType), f.nullable) for f in t])
    return T.LongType() if isinstance(t, T.TimestampType) else t


def _times(col: Column, t: T.StructType, into: bool) -> Column:
    """The struct column with its timestamps as epoch microseconds, or back."""
    fields = []
    for f in t:
        c = col[f.name]
        if isinstance(f.dataType, T.StructType):
            c = F.when(c.isNotNull(), _times(c, f.dataType, into))
        elif isinstance(f.dataType, T.TimestampType):
            c = F.unix_micros(c) if into else F.timestamp_micros(c)
        fields.append(c.alias(f.name))
    return F.struct(*fields)


def encoded(rows: DataFrame, schema: T.StructType, key: str, schema_id: int) -> DataFrame:
    """(key, value, headers) of records: the key as bytes of its text, the value framed Avro, headers trace_id and event_type where
    there are such columns. A null key or a null in a required field fails the query."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write, head = _codec(schema, False)[0], struct.pack(">bI", MAGIC, schema_id)
        for batch in batches:
            out = []
            for record in batch.column("value").to_pylist():
                buffer = io.BytesIO()
                buffer.write(head)
                write(buffer, record)
                out.append(buffer.getvalue())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.binary()), batch.column("headers")], ["key", "value", "headers"])

    named = [c for c in ("trace_id", "event_type") if c in rows.columns]
    headers = F.array(*[F.struct(F.lit(c).alias("key"), F.encode(c, "UTF-8").alias("value")) for c in named]).cast(HEADERS)
    checked = F.coalesce(F.col(key).cast("string"), F.raise_error(F.lit(f"a record has no key ({key})")).cast("string"))
    whole = F.struct(*[F.col(f.name) for f in schema])
    framed = rows.select(F.encode(checked, "UTF-8").alias("key"), _times(whole, schema, True).alias("value"), headers.alias("headers"))
    return framed.mapInArrow(encode, f"key binary, value binary, headers {HEADERS}")


def decoded(records: DataFrame, schema: T.StructType) -> DataFrame:
    """The records of framed Avro values (value: binary) written with the schema, as its columns. A null value gives no record;
    bytes without the frame fail the query."""
    flat = _flat(schema)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, arrow = _codec(schema, False)[1], to_arrow_schema(flat)
        for batch in batches:
            out = []
            for raw in batch.column("value").to_pylist():
                if len(raw) < 5 or raw[0] != MAGIC:
                    raise ValueError("not a framed Avro value")
                out.append(read(io.BytesIO(raw[5:])))
            yield pa.RecordBatch.from_pylist(out, arrow)

    rows = records.where("value is not null").select("value").mapInArrow(decode, flat)
    return rows.select(F.struct("*").alias("r")).select(_times(F.col("r"), schema, False).alias("r")).select("r.*")
