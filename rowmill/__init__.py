"""Record intake, normalisation, validation, de-duplication and reporting on Spark."""

__version__ = "0.1.0"
