"""Column expressions (pure ``Column -> Column`` builders, all JVM-side)."""

from shoptrail.functions.events import *  # noqa: F401,F403
