"""riskframe: fraud-analytics jobs expressed as Spark DataFrame / SQL / Structured Streaming plans."""

__version__ = "0.1.0"
