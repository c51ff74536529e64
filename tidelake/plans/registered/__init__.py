"""All registered queries with their DuckDB counterparts."""

from tidelake.plans.registered import feeds, file_sql, files, lake, loads, operators, payloads, streams, views  # noqa: F401
from tidelake.plans.registered.registry import ORACLES, QUERIES  # noqa: F401
