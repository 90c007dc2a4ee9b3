"""Importing this package registers every query."""

from brightmere.plans import (  # noqa: F401
    features,
    increments,
    joins,
    loads,
    monitoring,
    quality,
    relational,
    scalars,
    scans,
    streams,
)
from brightmere.plans.registry import QUERIES, SQL  # noqa: F401
