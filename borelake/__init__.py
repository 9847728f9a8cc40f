"""Borehole, downhole-log and hydrogeology analytics on Spark DataFrames."""

from .config import tuned
from .plans.bores import Bores
from .plans.queries import AllBores, NationalBores, StateBores
from .plans.stores import build_national, build_state
from .region import Region
from .sources.snapshot import SnapshotStore

__all__ = [
    "AllBores", "Bores", "NationalBores", "Region", "SnapshotStore", "StateBores",
    "build_national", "build_state", "tuned",
]
