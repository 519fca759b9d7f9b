"""cabrank: trip-record ingestion, table publication and trip analytics as Spark jobs."""

from cabrank.session import build_session, workspace
from cabrank.specs import REGISTRY, ZONES, DatasetSpec

__all__ = ["REGISTRY", "ZONES", "DatasetSpec", "build_session", "workspace"]
