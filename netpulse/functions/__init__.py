"""Column functions: pure expressions, no actions, no Python in the row path."""

from netpulse.functions.columns import *  # noqa: F401,F403
from netpulse.functions.predicates import *  # noqa: F401,F403
