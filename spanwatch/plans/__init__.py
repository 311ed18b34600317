from spanwatch.plans.catalog import QUERIES
from spanwatch.plans.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]
