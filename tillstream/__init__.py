"""Commerce analytics on Spark: layered click / inventory / session tables,
feature tables, a rolling one-hour stream, recommender and price models,
and the exploratory and monitoring reports over them."""

__version__ = "0.1.0"
