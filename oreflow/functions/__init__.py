from oreflow.functions.casts import as_date, as_int, magnitude, whole
from oreflow.functions.keys import record_key

__all__ = ["as_date", "as_int", "magnitude", "record_key", "whole"]
