"""All queries of the evidence engine and their SQL."""

from __future__ import annotations

from . import queries_deep as _deep
from . import queries_extraction as _extraction
from . import queries_functions as _functions
from . import queries_mining as _mining
from . import queries_more as _more
from . import queries_operators as _operators
from . import queries_reporting as _reporting
from . import queries_rest as _rest
from . import queries_views as _views

_MODULES = (_views, _operators, _mining, _more, _rest, _extraction, _functions, _deep, _reporting)
QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
