"""millstar — an industrial-sensor star schema built as Spark jobs.

Layers: landed JSON payload -> bronze snapshots -> cleaned silver -> gold star
schema (12 dimensions, 5 facts) -> exports.  Every transformation is a
``DataFrame -> DataFrame`` function; the session is always passed in.
"""

from millstar.plans.pipeline import Layout, run_pipeline, transform
from millstar.session import build_session, scratch_path

__all__ = ["Layout", "build_session", "run_pipeline", "scratch_path", "transform"]
