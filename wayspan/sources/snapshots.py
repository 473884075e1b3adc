"""Vehicle snapshots: binary files of the GTFS-Realtime format to rows.

The wire format is decoded here: only the few fields that the engine needs.
Unknown fields are skipped; a malformed file gives one row with ``error`` set.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "snapshot_key string, entity_idx int, feed_ts long, veh_ts long, vehicle_id string, trip_id string, route_id string, lat double, lon double, speed double, bearing double, error string"

# Field numbers of the format.
HEADER, ENTITY = 1, 2
HEADER_TIMESTAMP = 3
ENTITY_ID, ENTITY_VEHICLE = 1, 4
VEHICLE_TRIP, VEHICLE_POSITION, VEHICLE_TIMESTAMP, VEHICLE_DESCRIPTOR = 1, 2, 5, 8
TRIP_ID, TRIP_ROUTE = 1, 5
LATITUDE, LONGITUDE, BEARING, SPEED = 1, 2, 3, 5
DESCRIPTOR_ID = 1


def varint(buf: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        if at >= len(buf) or shift > 63:
            raise ValueError("a number is cut off")
        byte = buf[at]
        value |= (byte & 0x7F) << shift
        at += 1
        if byte < 0x80:
            return value, at
        shift += 7


def message(buf: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field, value): integers for numbers, bytes for the rest."""
    at, end = 0, len(buf)
    while at < end:
        tag, at = varint(buf, at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(buf, at)
        else:
            if kind == 2:
                size, at = varint(buf, at)
            elif kind in (1, 5):
                size = 8 if kind == 1 else 4
            else:
                raise ValueError(f"wire type {kind}")
            if at + size > end:
                raise ValueError("a field is cut off")
            value, at = buf[at : at + size], at + size
        yield tag >> 3, value


def last(buf: bytes) -> dict[int, int | bytes]:
    """Fields of a message of which each occurs once; repeated messages are merged by concatenation."""
    out: dict[int, int | bytes] = {}
    for field, value in message(buf):
        if isinstance(value, bytes) and isinstance(out.get(field), bytes) and field not in (ENTITY_ID,):
            value = value if len(value) == 4 else out[field] + value
        out[field] = value
    return out


def text(value: int | bytes | None) -> str:
    return value.decode() if isinstance(value, bytes) else ""


def single(value: bytes) -> float:
    return struct.unpack("<f", value)[0]


def decode(buf: bytes) -> list[tuple]:
    """Rows (entity_idx, feed_ts, veh_ts, vehicle_id, trip_id, route_id, lat, lon, speed, bearing) of a snapshot.

    Entities without vehicle, position, trip, its two ids, speed or bearing are left out.
    A missing vehicle time is the feed's; a missing descriptor's id is the entity's.
    """
    feed_ts, entities = 0, []
    for field, value in message(buf):
        if field == HEADER:
            feed_ts = int(last(value).get(HEADER_TIMESTAMP, feed_ts))
        elif field == ENTITY:
            entities.append(value)
    rows = []
    for i, raw in enumerate(entities):
        entity = last(raw)
        if ENTITY_VEHICLE not in entity:
            continue
        vehicle = last(entity[ENTITY_VEHICLE])
        if VEHICLE_POSITION not in vehicle or VEHICLE_TRIP not in vehicle:
            continue
        trip, where = last(vehicle[VEHICLE_TRIP]), last(vehicle[VEHICLE_POSITION])
        trip_id, route_id = text(trip.get(TRIP_ID)), text(trip.get(TRIP_ROUTE))
        if not trip_id or not route_id or SPEED not in where or BEARING not in where:
            continue
        known = VEHICLE_DESCRIPTOR in vehicle
        vehicle_id = text(last(vehicle[VEHICLE_DESCRIPTOR]).get(DESCRIPTOR_ID)) if known else text(entity.get(ENTITY_ID))
        place = [single(where[f]) if f in where else 0.0 for f in (LATITUDE, LONGITUDE, SPEED, BEARING)]
        rows.append((i, feed_ts, int(vehicle.get(VEHICLE_TIMESTAMP, 0)) or feed_ts, vehicle_id, trip_id, route_id, *place))
    return rows


def _decode_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4, pa.string()]
    for b in batches:
        rows = []
        for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
            try:
                rows += [(path, *r, None) for r in decode(content)]
            except (ValueError, struct.error, UnicodeDecodeError, TypeError) as e:
                rows.append((path, *[None] * 10, str(e)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Positions of all days below ``path`` (folders YYYY-MM-DD of .pb files), with ``day``.

    Rows whose ``error`` is set stand for unreadable files; count them, then leave them out.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pb").option("recursiveFileLookup", "true").load(path).select("path", "content")
    rows = files.mapInArrow(_decode_files, SCHEMA)
    return rows.withColumn("day", F.to_date(F.regexp_extract("snapshot_key", r"(\d{4}-\d{2}-\d{2})/[^/]+$", 1)))


def readable(rows: DataFrame) -> DataFrame:
    return rows.where("error is null").drop("error")
