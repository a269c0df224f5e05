"""kestrel: Spark-native funnel, sessionisation and experiment analytics.

Every operator is a DataFrame -> DataFrame function; what is collected to the
driver (verdicts of contracts, histograms, models) has a stated bound.
"""

from kestrel.config import Profile  # noqa: F401
from kestrel.session import checkpoint_dir, get_spark  # noqa: F401
