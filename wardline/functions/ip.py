"""IP address expressions on string columns, without a Python function per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Address syntax and private ranges.
IPV4_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PRIVATE_RANGES = (("10.0.0.0", 8), ("172.16.0.0", 12), ("192.168.0.0", 16), ("100.64.0.0", 10))
CGNAT_RANGE = ("100.64.0.0", 10)
INVALID_PREFIX = -2
IPV6_PREFIX = -1

_IPV4_BODY = rf"{IPV4_OCTET}(\.{IPV4_OCTET}){{3}}"
IPV4_PATTERN = f"^{_IPV4_BODY}$"


def _ipv6_pattern() -> str:
    h = "[0-9A-Fa-f]{1,4}"
    forms = [f"({h}:){{7}}{h}", f"({h}:){{1,7}}:", f":((:{h}){{1,7}}|:)"]
    forms += [f"({h}:){{{i}}}(:{h}){{1,{7 - i}}}" for i in range(1, 7)]
    forms.append(f"({h}:){{6}}{_IPV4_BODY}")
    forms.append(f":(:{h}){{0,5}}:{_IPV4_BODY}")
    forms += [f"({h}:){{{i}}}(:{h}){{0,{5 - i}}}:{_IPV4_BODY}" for i in range(1, 6)]
    return "^(" + "|".join(forms) + ")(%[^%]+)?$"


IPV6_PATTERN = _ipv6_pattern()


def _range_bounds(network: str, bits: int) -> tuple[int, int]:
    value = 0
    for octet in network.split("."):
        value = value * 256 + int(octet)
    return value, value + 2 ** (32 - bits) - 1


def is_ipv4(ip: Column) -> Column:
    return F.coalesce(ip.rlike(IPV4_PATTERN), F.lit(False))


def is_ipv6(ip: Column) -> Column:
    """The long pattern runs only on texts with a colon."""
    return F.coalesce(F.when(ip.contains(":"), ip.rlike(IPV6_PATTERN)), F.lit(False))


def octet(ip: Column, position: int) -> Column:
    """Octet 1..4 of a valid IPv4 address, NULL otherwise."""
    part = F.try_element_at(F.split(ip, r"\."), F.lit(position)).try_cast("int")
    return F.when(is_ipv4(ip), part)


def ip_long(ip: Column) -> Column:
    """IPv4 address as a 32-bit number, NULL if it is not one."""
    zero = F.lit(0).cast("bigint")
    total = F.aggregate(F.split(ip, r"\."), zero, lambda acc, part: acc * 256 + part.try_cast("bigint"))
    return F.when(is_ipv4(ip), total)


# The functions below take the number and the IPv6 flag of an address, so that a caller
# can parse each address once and derive several columns from it.

def in_ranges(number: Column, ranges) -> Column:
    hit = F.lit(False)
    for network, bits in ranges:
        low, high = _range_bounds(network, bits)
        hit = hit | number.between(low, high)
    return F.coalesce(hit, F.lit(False))


def private_flag(number: Column, v6: Column) -> Column:
    """1 private, 0 any other valid address, -1 missing or invalid."""
    return F.when(in_ranges(number, PRIVATE_RANGES), 1).when(number.isNotNull() | v6, 0).otherwise(-1)


def network(number: Column, v6: Column, bits: int) -> Column:
    """Network address of /bits as a number; IPv6 and invalid addresses have marker values."""
    return (
        F.when(number.isNotNull(), number - number % (2 ** (32 - bits)))
        .when(v6, F.lit(IPV6_PREFIX).cast("bigint"))
        .otherwise(F.lit(INVALID_PREFIX).cast("bigint"))
    )


def is_private_ip(ip: Column) -> Column:
    return private_flag(ip_long(ip), is_ipv6(ip))


def ip_prefix(ip: Column, bits: int) -> Column:
    return network(ip_long(ip), is_ipv6(ip), bits)


def address_class(ip: Column) -> Column:
    first = octet(ip, 1)
    return (
        F.when(first < 128, "A").when(first < 192, "B").when(first < 224, "C")
        .when(first < 240, "D").when(first.isNotNull(), "E")
    )
