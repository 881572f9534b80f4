"""Billing and usage analytics for metered services, as Spark jobs."""

from tollhouse.profiles import SERVICE_A, SERVICE_B, ServiceProfile
from tollhouse.sources.tables import Tables

__all__ = ["SERVICE_A", "SERVICE_B", "ServiceProfile", "Tables"]
