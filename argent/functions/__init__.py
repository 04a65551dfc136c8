"""Column-expression library: every function takes and returns ``Column``.

All of them are built-in Spark expressions (no Python UDF), so they stay
inside whole-stage code generation.
"""

from argent.functions.exprs import *  # noqa: F401,F403
from argent.functions.exprs import __all__  # noqa: F401
