"""Text statistics for large document collections on Spark."""

from termloom.functions import *  # noqa: F401,F403
from termloom.operators import *  # noqa: F401,F403
from termloom.plans import *  # noqa: F401,F403
from termloom.sinks import *  # noqa: F401,F403
from termloom.sources import *  # noqa: F401,F403
