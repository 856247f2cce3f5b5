"""Lead intelligence on Spark: articles in, scored and reviewable sales leads out."""

__version__ = "0.1.0"
