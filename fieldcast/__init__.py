"""fieldcast: climate, crop and renewable-energy analytics as Spark DataFrame operators."""

__version__ = "0.1.0"
