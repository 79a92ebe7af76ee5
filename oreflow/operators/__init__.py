from oreflow.operators.marts import code_dimension, dimension, entity, junction
from oreflow.operators.quality import (
    Rule,
    budget_only,
    profile,
    repair,
    route,
    split,
    strict,
    verdict,
)
from oreflow.operators.records import explode_nested, explode_records, flatten, stamp
from oreflow.operators.status import merge_status, one_per_key

__all__ = [
    "Rule", "budget_only", "code_dimension", "dimension", "entity", "explode_nested",
    "explode_records", "flatten", "junction", "merge_status", "one_per_key", "profile", "repair", "route", "split",
    "stamp", "strict", "verdict",
]
