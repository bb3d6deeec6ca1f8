"""All named queries; importing the modules registers them."""

from millrace.catalog import drift, features, incremental, ingest, learning, slices, star, streams  # noqa: F401
from millrace.catalog.registry import ORACLES, QUERIES  # noqa: F401
