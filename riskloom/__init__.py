"""Account-risk analytics expressed as Spark DataFrame, Structured Streaming and
``pyspark.ml`` jobs."""

from riskloom.config import CostMatrix, ModelConfig, Monitoring, Settings, SplitRule

__all__ = ["CostMatrix", "ModelConfig", "Monitoring", "Settings", "SplitRule"]
