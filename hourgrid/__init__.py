"""Station-hour demand analytics expressed as Spark DataFrame plans."""

from hourgrid.spec import DemandSpec
from hourgrid.session import get_spark

__all__ = ["DemandSpec", "get_spark"]
