"""Quality-flag bits of the aerosol product."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values: (shift of the cloud bits, shift of the adjacency bits) per reading of the flag.
BIT_ORDERS = {"documented": (0, 5), "as_written": (13, 8)}
CLOUD_KEEP = (1, 2)
ADJACENCY_KEEP = (0, 3)


def quality_keep(flag: Column, bit_order: str = "documented") -> Column:
    """True where the cloud and adjacency bits both allow the pixel.

    ``documented`` reads bits 0-2 and 5-7; ``as_written`` reads bits 13-15 and 8-10.
    A flag of 0 or NULL is never kept.
    """
    cloud_shift, adjacency_shift = BIT_ORDERS[bit_order]
    cloud = F.shiftright(flag, cloud_shift).bitwiseAND(7)
    adjacency = F.shiftright(flag, adjacency_shift).bitwiseAND(7)
    return F.coalesce(cloud.isin(*CLOUD_KEEP) & adjacency.isin(*ADJACENCY_KEEP), F.lit(False))
