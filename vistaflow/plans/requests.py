"""The three calls a user may make on a named view, behind the access rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from vistaflow.model import require_identifier
from vistaflow.operators.access import may_access
from vistaflow.operators.shaping import coerce_output, envelope
from vistaflow.plans.query import DEFAULT_LIMIT, aggregate, query
from vistaflow.sources.catalog import ViewCatalog


@dataclass(frozen=True)
class AccessRules:
    """Who may read which view; without grants only superusers may, unless all may."""

    grants: DataFrame | None = None
    superusers: tuple[str, ...] = ()
    all_access: bool = False

    def allow(self, user_email: str, view_name: str) -> bool:
        if self.grants is None:
            known = {s.strip().lower() for s in self.superusers}
            return self.all_access or user_email.strip().lower() in known
        return may_access(
            user_email, view_name, self.grants, self.superusers, all_access=self.all_access
        )


class ViewRequests:
    """List and describe views, query rows, aggregate.

    A bad argument is a ValueError, a denied view a PermissionError and an unknown one a
    LookupError. View names match in any case. Results are lazy DataFrames of values as a
    response shows them; the caller decides how to take them.
    """

    def __init__(self, catalog: ViewCatalog, rules: AccessRules = AccessRules()) -> None:
        self.catalog = catalog
        self.rules = rules

    def views(self) -> DataFrame:
        return self.catalog.list_views()

    def columns(self, user_email: str, view_name: str) -> DataFrame:
        return self.catalog.list_columns(self._permitted(user_email, view_name))

    def query(self, user_email: str, view_name: str, **arguments) -> DataFrame:
        """See plans.query.query for the arguments."""
        return coerce_output(query(self._rows(user_email, view_name), **arguments))

    def query_envelope(self, user_email: str, view_name: str, **arguments) -> DataFrame:
        """How many rows the same :meth:`query` gives, and whether its limit cut more off."""
        rows = query(self._rows(user_email, view_name), **arguments)
        return envelope(rows, arguments.get("limit", DEFAULT_LIMIT))

    def aggregate(
        self, user_email: str, view_name: str, aggregation: str, **arguments
    ) -> DataFrame:
        """See plans.query.aggregate for the arguments."""
        rows = self._rows(user_email, view_name)
        return coerce_output(aggregate(rows, aggregation, **arguments))

    def _rows(self, user_email: str, view_name: str) -> DataFrame:
        return self.catalog.frame(self._permitted(user_email, view_name))

    def _permitted(self, user_email: str, view_name: str) -> str:
        """The registered name of a view the user may read."""
        require_identifier(view_name, "view_name")
        if not self.rules.allow(user_email, view_name):
            raise PermissionError(f"No access to view {view_name!r}.")
        same = [n for n in self.catalog.view_names() if n.lower() == view_name.lower()]
        return same[0] if len(same) == 1 else view_name
