"""tidemark: subscription-business analytics as Spark DataFrame jobs.

Layers: ``sources`` (bronze inputs), ``operators`` (silver, intermediate,
gold, history, quality), ``functions`` (column helpers and rule tables),
``plans`` (model graph, query catalogue), ``streaming`` (none needed; see
its docstring).
"""

from tidemark.context import RunContext, build_session

__all__ = ["RunContext", "build_session"]
