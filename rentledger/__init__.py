"""Order and transaction reporting for rental marketplaces, on Spark DataFrames."""

from .session import configure, get_session

__all__ = ["configure", "get_session"]
