"""A small made-up network: one bus route in two directions past opposite kerbs, a trolleybus, a tram."""

import struct

START, FAR = (49.830000, 24.010000), (49.850000, 24.050000)
N, S = (49.840000, 24.030000), (49.839371, 24.030000)
MOVING, AT_N = (49.840800, 24.03), (49.840090, 24.03)
T0 = 1_786_000_000

MEMBERS = {
    "routes": ("route_id,route_short_name,route_type", ["R_BUS,А01,3", "R_TROL,Тр22,3", "R_TRAM,Т1,0"]),
    "trips": ("route_id,trip_id,direction_id,shape_id", ["R_BUS,1_1_0,0,", "R_BUS,1_1_1,1,", "R_TROL,2_1_0,0,", "R_TRAM,3_1_0,0,"]),
    "stop_times": ("trip_id,stop_id,stop_sequence", ["1_1_0,FAR,10", "1_1_0,START,1", "1_1_0,N,2", "1_1_1,START,1", "1_1_1,S,2", "1_1_1,FAR,3", "2_1_0,START,1", "3_1_0,START,1"]),
    "stops": ("stop_id,stop_lat,stop_lon", [f"START,{START[0]},{START[1]}", f"FAR,{FAR[0]},{FAR[1]}", f"N,{N[0]},{N[1]}", f"S,{S[0]},{S[1]}"]),
}


def write_static(folder, extra=None):
    import zipfile

    path = folder / "feed.zip"
    with zipfile.ZipFile(path, "w") as z:
        for name, (header, lines) in (MEMBERS | (extra or {})).items():
            z.writestr(f"{name}.txt", "﻿" + "\n".join([header, *lines]) + "\n")
    return path


def _varint(n: int) -> bytes:
    out = b""
    while n > 0x7F:
        out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
    return out + bytes([n])


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _num(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _float(field: int, x: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", x)


def feed(*entities: bytes, ts: int = T0) -> bytes:
    return _bytes(1, _bytes(1, b"2.0") + _num(3, ts)) + b"".join(_bytes(2, e) for e in entities)


def entity(lat=MOVING[0], lon=MOVING[1], speed=8.0, bearing=0.0, trip="1_1_0", route="R_BUS", vehicle="v1", ts=T0, eid="e1") -> bytes:
    pos = _float(1, lat) + _float(2, lon) + (b"" if bearing is None else _float(3, bearing)) + (b"" if speed is None else _float(5, speed))
    v = _bytes(1, _bytes(1, trip.encode()) + _bytes(5, route.encode())) + _bytes(2, pos) + (_num(5, ts) if ts else b"") + (_bytes(8, _bytes(1, vehicle.encode())) if vehicle is not None else b"")
    return _bytes(1, eid.encode()) + _bytes(4, v)


POSITION = "day string, snapshot_key string, entity_idx int, feed_ts long, veh_ts long, vehicle_id string, trip_id string, route_id string, lat double, lon double, speed double, bearing double"


def position(i=0, lat=MOVING[0], lon=MOVING[1], speed=8.0, bearing=0.0, trip="1_1_0", route="R_BUS", vehicle="v1", veh=T0, ts=T0):
    return ("2026-08-06", f"s{i:04d}", 0, ts, veh, vehicle, trip, route, lat, lon, speed, bearing)
