from talkloom.functions.numbers import lenient_double, round_1
from talkloom.functions.text import normalise, path_id, strip

__all__ = ["lenient_double", "normalise", "path_id", "round_1", "strip"]
