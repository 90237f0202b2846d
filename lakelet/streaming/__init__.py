from lakelet.streaming.pipeline import Dataset, Pipeline

__all__ = ["Dataset", "Pipeline"]
