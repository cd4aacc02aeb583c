"""kinmatch: entity resolution for business records as Spark DataFrame plans."""

__version__ = "0.1.0"
