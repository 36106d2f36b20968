"""Scalar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def channel_separation(a: Column, b: Column, channels: int) -> Column:
    """Circular distance of two channels on a ring of `channels`."""
    d = F.abs(a - b)
    return F.least(d, F.lit(channels) - d)


def global_crystal(channel: Column, crystal: Column, per_channel: int) -> Column:
    return channel * per_channel + crystal


def shift_channel(channel: Column, offset: int, most: int = 0xFFFFFFFF) -> Column:
    """channel + offset; a value outside 32 bits without sign (or above `most`) raises."""
    moved = channel.cast("bigint") + offset
    return F.when(moved.between(0, most), moved).otherwise(F.raise_error(F.concat(F.lit("channel out of range: "), moved.cast("string"))).cast("bigint"))


def saturate_u32(x: Column) -> Column:
    return F.least(x, F.lit(4294967295))


def format_time_ns(ns: Column) -> Column:
    """Nanoseconds as minutes, seconds and milliseconds."""
    total_ms = F.floor(ns / 1_000_000).cast("bigint")
    return F.format_string("%dm %ds %dms", F.floor(total_ms / 60000), F.floor(total_ms / 1000) % 60, total_ms % 1000)


def ip_to_text(ip: Column) -> Column:
    part = lambda s: F.shiftrightunsigned(ip, s).bitwiseAND(F.lit(255)).cast("string")
    return F.concat_ws(".", part(24), part(16), part(8), part(0))


def is_ipv4(text: Column) -> Column:
    return text.rlike(r"^((25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])$")


def text_to_ip(text: Column) -> Column:
    """null for what is no IPv4 address."""
    p = F.split(text, r"\.")
    n = sum((F.try_element_at(p, F.lit(i + 1)).try_cast("bigint") * (1 << 8 * (3 - i)) for i in range(4)), F.lit(0))
    return F.when(is_ipv4(text), n)


def parse_command(text: Column) -> Column:
    """key=value;key=value to a map, nothing trimmed; parts without = or with an empty key are left out, the last of a key holds."""
    pairs = F.filter(F.split(text, ";"), lambda s: F.instr(s, "=") > 1)
    key, value = (lambda s: F.substring_index(s, "=", 1)), (lambda s: F.substring(s, F.instr(s, "=") + 1, F.length(s)))
    seen = F.array_distinct(F.transform(pairs, key))
    return F.map_from_arrays(seen, F.transform(seen, lambda k: F.element_at(F.transform(F.filter(pairs, lambda s: key(s) == k), value), -1)))


def parse_uint64(params: Column, key: str, fallback: int) -> Column:
    """The number that a parameter begins with, after white space and a sign, as decimal(20,0); a negative one wraps at
    2**64. Without the key, without digits or above 64 bits it is `fallback`."""
    found = F.try_element_at(params, F.lit(key))
    pattern = r"^[\x20\x09-\x0D]*([+-]?)([0-9]+)"
    n = F.regexp_extract(found, pattern, 2).try_cast("decimal(38,0)")
    wrapped = F.when((F.regexp_extract(found, pattern, 1) == "-") & (n > 0), F.expr("18446744073709551616BD") - n).otherwise(n)
    return F.when(n <= F.expr("18446744073709551615BD"), wrapped).otherwise(F.lit(fallback)).cast("decimal(20,0)")


def split_list(text: Column) -> Column:
    """Parts between commas or semicolons as they are; only empty ones are left out."""
    return F.filter(F.split(text, "[,;]"), lambda s: s != "")


def shard_strategy(text: Column) -> Column:
    """The strategy of one of three spellings each; null for anything else."""
    # The names; each is also known in lower and in upper case.
    names = ["HashByChannel", "FreeSpaceAware", "RoundRobin"]
    return F.coalesce(*[F.when(text.isin(n, n.lower(), n.upper()), F.lit(n)) for n in names])


def detector_type(text: Column) -> Column:
    # Detector types that are known by name.
    return F.when(text.isin("BDM2", "BDM50100"), text).otherwise(F.lit("Unknown"))


def session_name(name: Column, options: Column, prefix: Column, now_ms: Column) -> Column:
    """The name, else the session of the options, else prefix_now."""
    return F.coalesce(F.nullif(name, F.lit("")), F.nullif(F.try_element_at(options, F.lit("session")), F.lit("")), F.concat(prefix, F.lit("_"), now_ms.cast("string")))


def corrected_time(local: Column, offset: Column, unit: str = "ns") -> Column:
    """local + offset, in ns, us or ms (truncated)."""
    per = {"ns": 1, "us": 1000, "ms": 1_000_000}[unit]
    s = local + offset
    return s if per == 1 else ((s - F.when(s >= 0, s % per).otherwise(s % per)) / per).cast("bigint")


def segment_mib_per_s(packets: Column, seconds: Column, packet_bytes: int = 1024) -> Column:
    return F.when(seconds > 0, packets * packet_bytes / (1024.0 * 1024.0) / seconds)


def reserve_singles(gibit: Column, packet_bytes: int, singles_per_packet: int, most: int = (1 << 64) - 1) -> Column:
    """Singles that so many GiBit of packets can hold at most, as decimal(20,0), saturating; 0 for none or fewer."""
    packets = F.floor(gibit.cast("double") * float(1 << 30) / float(8 * packet_bytes))
    full = F.lit(str(most)).cast("decimal(20,0)")
    exact = (packets.cast("decimal(20,0)") * F.lit(singles_per_packet)).cast("decimal(38,0)")
    return F.when(gibit <= 0, F.lit(0)).when(packets >= most // singles_per_packet, full).otherwise(exact).cast("decimal(20,0)")
