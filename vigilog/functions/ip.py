"""IPv4 expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_QUAD = r"^\d{1,3}(\.\d{1,3}){3}$"
# First and last address of the private ranges.
PRIVATE_RANGES = [
    ("10.0.0.0", "10.255.255.255"),
    ("172.16.0.0", "172.31.255.255"),
    ("192.168.0.0", "192.168.255.255"),
]


def ip_to_long(ip: Column) -> Column:
    """Dotted quad to integer; null for anything else."""
    octets = F.split(ip, r"\.")
    a, b, c, d = (F.get(octets, F.lit(i)).try_cast("bigint") for i in range(4))
    ok = ip.rlike(_QUAD) & (F.greatest(a, b, c, d) <= 255)
    return F.when(ok, a * F.lit(16777216) + b * F.lit(65536) + c * F.lit(256) + d)


def long_to_ip(n: Column) -> Column:
    octets = [F.shiftright(n, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
    return F.when(n.between(0, 4294967295), F.concat_ws(".", *octets))


def _number(quad: str) -> int:
    a, b, c, d = map(int, quad.split("."))
    return a * 16777216 + b * 65536 + c * 256 + d


def is_internal(n: Column) -> Column:
    """Whether an address, as a number, lies in a private range."""
    return reduce(or_, [n.between(_number(low), _number(high)) for low, high in PRIVATE_RANGES])


def with_ip_columns(df: DataFrame, column: str = "ip_address") -> DataFrame:
    """Add ``ip_long`` and ``internal``; both are null for text that is no address."""
    return df.withColumn("ip_long", ip_to_long(F.col(column))).withColumn("internal", is_internal(F.col("ip_long")))
