"""panelcast: panel time-series analytics on Spark.

Every operator takes a DataFrame plus the names of its series-key columns
and works on all series at once; the single-series case is ``keys=[]``.
"""

from panelcast.session import ensure_checkpoint_dir, get_session

__all__ = ["get_session", "ensure_checkpoint_dir"]
__version__ = "0.1.0"
