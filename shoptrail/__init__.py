"""Online-retail behaviour analytics as Spark DataFrame jobs."""

from shoptrail.params import TaskParams

__all__ = ["TaskParams"]
