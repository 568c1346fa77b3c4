"""Trip analytics on Spark: ingest monthly trip files, roll them up by hour, serve the rollups."""

from kerbside.spec import SERVICES, SPECS, ServiceSpec

__all__ = ["SERVICES", "SPECS", "ServiceSpec"]
