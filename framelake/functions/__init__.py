"""Column-level scalar functions (all JVM-side expressions)."""
from framelake.functions.scalars import *  # noqa: F401,F403
