from oreflow.plans.layers import bronze_to_silver, raw_to_bronze, rebuild_silver, repair_quarantined
from oreflow.plans.marts import build_marts, update_marts
from oreflow.plans.status import settle, update_status

__all__ = [
    "bronze_to_silver", "build_marts", "raw_to_bronze", "rebuild_silver", "repair_quarantined",
    "settle", "update_marts", "update_status",
]
