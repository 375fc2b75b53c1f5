"""Column -> Column helpers.  Everything is a built-in Spark expression (codegen'd, JVM side)."""

from claimwise.functions.scalars import *  # noqa: F401,F403
