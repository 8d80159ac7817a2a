"""Sources, sinks, and the role frames the plans read."""

from quaymart.sources.roles import Marketplace, Rentals
from quaymart.sources.tables import TABLES, Tables

__all__ = ["Marketplace", "Rentals", "TABLES", "Tables"]
