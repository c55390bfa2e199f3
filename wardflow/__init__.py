"""Analytics operators and ready-made healthcare models on plain PySpark."""

from wardflow.params import Params

__all__ = ["Params"]
