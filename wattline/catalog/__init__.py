"""One runnable query per operator, with the SQL that checks it where SQL can."""

from wattline.catalog import (
    aggregates,
    cleaning,
    gaps,
    ingest,
    modelling,
    reduction,
    relational,
    windows,
)
from wattline.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
