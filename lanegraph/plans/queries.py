"""Imports every module that registers queries."""

from . import registry  # noqa: F401
from . import tables_q  # noqa: F401
from . import analysis_q  # noqa: F401
from . import graph_q  # noqa: F401
from . import ml_q  # noqa: F401
from . import audit_q  # noqa: F401
