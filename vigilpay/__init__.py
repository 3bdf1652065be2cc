"""Payment-risk analytics as Spark jobs: batch tables and streams share one set of operators."""

__version__ = "0.1.0"
