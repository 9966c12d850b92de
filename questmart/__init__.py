"""Player-analytics marts, A/B statistics and model studies as Spark DataFrame builders."""

from questmart.params import Params
from questmart.schemas import Bronze

__all__ = ["Bronze", "Params"]
