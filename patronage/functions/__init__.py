"""Column expressions (all JVM-side, codegen-friendly; no Python UDFs)."""

from .exprs import *  # noqa: F401,F403
