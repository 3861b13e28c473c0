"""The registered queries: every operator over the test tables, each beside its SQL."""

from terrazzo.catalog import checks, columns, groups, ingest, layers, streams  # noqa: F401
from terrazzo.catalog.registry import QUERIES, SQL  # noqa: F401
