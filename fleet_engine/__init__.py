"""fleet_engine: connected-fleet analytics as Spark jobs."""

from fleet_engine.session import get_session

__all__ = ["get_session"]
