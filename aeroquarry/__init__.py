"""A Spark-native observation lake: one retrieval call, composable filters, append-only storage."""

__all__ = ["get"]


def __getattr__(name: str):
    if name == "get":
        from .plans.client import get

        return get
    raise AttributeError(name)
