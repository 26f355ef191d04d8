"""Documents to searchable, prompt-ready tables, as Spark jobs."""

__version__ = "0.1.0"
