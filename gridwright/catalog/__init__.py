"""Every operator as a query over the driver tables, with the SQL that must give the same rows."""

from gridwright.catalog import (  # noqa: F401
    evaluation,
    features,
    joins,
    models,
    quality,
    runs,
    sources,
    tables,
    time,
)
from gridwright.catalog.registry import ORACLES, QUERIES  # noqa: F401
