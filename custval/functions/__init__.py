"""Column-expression helpers (JVM-side built-ins only; no Python UDFs)."""

from custval.functions.exprs import *  # noqa: F401,F403
