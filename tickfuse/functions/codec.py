"""Channel arithmetic of the vendor formats, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Detectors of a hardware ring, first ring, channels of a group here and there, groups.
PER_RING, FIRST_RING, GROUP, VENDOR_GROUP, GROUPS = 48, 2, 36, 37, 8
RINGS_PER_OFFSET = 3


def src_ring(src: Column) -> Column:
    return F.shiftright(src, 8)


def src_ip(src: Column) -> Column:
    return src.bitwiseAND(F.lit(0xFF))


def src_to_detector(src: Column) -> Column:
    return (src_ring(src) - FIRST_RING) * PER_RING + src_ip(src) - 1


def shift_ring(src: Column, offset: Column | int) -> Column:
    """The source channel on the ring `offset` hardware blocks further on; null outside 2..255."""
    offset = F.lit(offset) if isinstance(offset, int) else offset
    ring = src_ring(src) + offset * RINGS_PER_OFFSET
    moved = F.when((ring >= FIRST_RING) & (ring <= 255), F.shiftleft(ring, 8) + src_ip(src))
    return F.when(offset == 0, src).otherwise(moved)


def encode_event(singles: DataFrame, channel: str = "channel", crystal: str = "crystal", energy: str = "energy", time: str = "time_100fs", ip_base: int = 1, ch_base: int = 1, energy_scale: float = 1e-3, time_scale: float = 1e-4) -> DataFrame:
    """Singles to vendor events: columns ip, ch, vendor_energy, vendor_time. Indices out of range are left out; an
    energy that isn't finite, or below zero, is 0."""
    c, k = F.col(channel), F.col(crystal)
    good = c.between(0, 0x7FFF) & k.between(0, GROUP * GROUPS - 1)
    ip = F.shiftleft((F.floor(c / PER_RING).cast("int") + FIRST_RING).bitwiseAND(F.lit(0xFF)), 8) + c % PER_RING + 1 + (ip_base - 1)
    ch = F.floor(k / GROUP).cast("int") * VENDOR_GROUP + k % GROUP + ch_base
    e = (F.col(energy).cast("double") * energy_scale).cast("float")
    e = F.when(e.isNull() | F.isnan(e) | (e < 0) | (e == float("inf")), F.lit(0.0)).otherwise(e).cast("float")
    return singles.where(good).withColumns({"ip": ip.cast("int"), "ch": ch.cast("int"), "vendor_energy": e, "vendor_time": F.col(time).cast("double") * time_scale})


def decode_event(events: DataFrame, ip: str = "ip", ch: str = "ch", energy: str = "vendor_energy", time: str = "vendor_time", ip_base: int = 1, ch_base: int = 1, energy_scale: float = 1e3, time_scale: float = 1e4) -> DataFrame:
    """Vendor events to singles: columns channel, crystal, energy, time_100fs. Virtual and foreign channels are left
    out. The default scales invert those of encode_event; time_scale=1e3 reads times as picoseconds."""
    addr, k = F.col(ip) - ip_base + 1, F.col(ch) - ch_base
    good = (F.col(ip) >= ip_base) & (F.col(ch) >= ch_base) & (src_ring(addr) >= FIRST_RING) & src_ip(addr).between(1, PER_RING) & (k < VENDOR_GROUP * GROUPS) & (k % VENDOR_GROUP < GROUP)
    e, t = F.col(energy).cast("double") * energy_scale, F.col(time) * time_scale
    bad = lambda x: x.isNull() | F.isnan(x) | (x < 0) | (x == float("inf"))
    return events.where(good).withColumns({"channel": src_to_detector(addr).cast("int"), "crystal": (F.floor(k / VENDOR_GROUP) * GROUP + k % VENDOR_GROUP).cast("int"), "energy": F.when(bad(e), F.lit(0.0)).otherwise(e).cast("float"), "time_100fs": F.when(bad(t), F.lit(0)).otherwise(F.floor(t + 0.5)).cast("bigint")})


def packet_t0(payload: Column, unused: int = 0) -> Column:
    """The 48-bit big-endian time in bytes 2..7 after the unused header; 0 for a packet that is too short."""
    return F.when(F.length(payload) >= unused + 8, F.conv(F.hex(F.substring(payload, unused + 3, 6)), 16, 10).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
