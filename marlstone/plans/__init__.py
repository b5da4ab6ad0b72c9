"""The query catalogue; its modules register their queries in catalog.QUERIES and their SQL in catalog.ORACLES."""

from marlstone.plans import catalog, curation, detection, export, fields, masks  # noqa: F401
