"""Vistaflow: named views, search documents and access lists as Spark jobs."""

from vistaflow.model import DOCUMENT_SCHEMA, Filter, ViewDef
from vistaflow.plans.query import aggregate, query
from vistaflow.plans.requests import AccessRules, ViewRequests
from vistaflow.sources.catalog import ViewCatalog

__all__ = [
    "DOCUMENT_SCHEMA",
    "AccessRules",
    "Filter",
    "ViewCatalog",
    "ViewDef",
    "ViewRequests",
    "aggregate",
    "query",
]
