"""voxsift: feedback triage and reporting on Spark DataFrames."""

from .config import TriageConfig

__all__ = ["TriageConfig"]
