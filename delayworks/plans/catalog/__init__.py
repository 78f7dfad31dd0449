"""All registered queries, by area."""

from delayworks.plans.catalog import (  # noqa: F401
    airports, flights, io, joining, learning, loans, monitoring, profiles, weather,
)
