"""Tiny SAS transport (XPORT v5) writer for test fixtures: 80-byte header records, 140-byte
variable descriptors, IBM-370 doubles for numbers, blank-padded text."""

from __future__ import annotations

import math
import struct

_STAMP = "01JAN16:00:00:00"


def ibm_double(x) -> bytes:
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return b"." + b"\x00" * 7
    if x == 0:
        return b"\x00" * 8
    sign = 0x80 if x < 0 else 0
    f, e = abs(float(x)), 0
    while f >= 1:
        f /= 16
        e += 1
    while f < 1 / 16:
        f *= 16
        e -= 1
    m = int(round(f * 2 ** 56))
    if m >= 2 ** 56:
        m >>= 4
        e += 1
    return bytes([sign | (e + 64)]) + m.to_bytes(7, "big")


def write_xport(path: str, columns: list[tuple[str, str, int]], rows: list[tuple], name: str = "ARRIVALS",
                encoding: str = "latin-1") -> None:
    """``columns``: (name, 'num'|'char', length); numbers are 8 bytes."""
    rec = []
    rec.append(b"HEADER RECORD*******LIBRARY HEADER RECORD!!!!!!!000000000000000000000000000000  ")
    rec.append(("SAS     SAS     SASLIB  9.4     LINUX   " + " " * 24 + _STAMP).encode())
    rec.append((_STAMP + " " * 64).encode())
    rec.append(b"HEADER RECORD*******MEMBER  HEADER RECORD!!!!!!!000000000000000001600000000140  ")
    rec.append(b"HEADER RECORD*******DSCRPTR HEADER RECORD!!!!!!!000000000000000000000000000000  ")
    rec.append(("SAS     " + name.ljust(8)[:8] + "SASDATA 9.4     LINUX   " + " " * 24 + _STAMP).encode())
    rec.append((_STAMP + " " * 16 + " " * 40 + " " * 8).encode())
    rec.append(("HEADER RECORD*******NAMESTR HEADER RECORD!!!!!!!000000" + f"{len(columns):04d}"
                + "00000000000000000000  ").encode())
    head = b"".join(rec)
    names, pos = b"", 0
    for i, (cname, kind, length) in enumerate(columns):
        length = 8 if kind == "num" else length
        names += struct.pack(">hhhh8s40s8shhh2s8shhl52s", 1 if kind == "num" else 2, 0, length, i + 1,
                             cname.encode().ljust(8), b" " * 40, b" " * 8, 0, 0, 0, b"\x00\x00", b" " * 8, 0, 0,
                             pos, b"\x00" * 52)
        pos += length
    if len(names) % 80:
        names += b" " * (80 - len(names) % 80)
    obs = b"HEADER RECORD*******OBS     HEADER RECORD!!!!!!!000000000000000000000000000000  "
    data = bytearray()
    for row in rows:
        for (cname, kind, length), v in zip(columns, row):
            if kind == "num":
                data += ibm_double(v)
            else:
                data += ("" if v is None else str(v)).encode(encoding)[:length].ljust(length)
    if len(data) % 80:
        data += b" " * (80 - len(data) % 80)
    with open(path, "wb") as fh:
        fh.write(head + names + obs + bytes(data))
