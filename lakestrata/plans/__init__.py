"""Views over the input tables, the layered pipeline and the query registry."""

from .pipeline import PipelineTables, refresh_pipeline, run_jobs, run_pipeline
from .queries import QUERIES

__all__ = ["QUERIES", "PipelineTables", "refresh_pipeline", "run_jobs", "run_pipeline"]
