"""Column expressions. All JVM-side built-ins; no Python UDFs."""

from tickloom.functions.scalar import *  # noqa: F401,F403
