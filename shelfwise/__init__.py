"""shelfwise — Spark-native sales and inventory analytics.

Every operator is a lazy function ``f(model, as_of, **params) -> DataFrame``
built from Spark's own expressions.  Nothing is collected to the driver;
results are written by the sinks or collected by the caller.
"""

from shelfwise.session import build_session, ensure_checkpoint_dir
from shelfwise.sources.model import StarModel, load_model

__all__ = ["build_session", "ensure_checkpoint_dir", "StarModel", "load_model"]
