"""Column -> Column functions: text helpers (C*) and row predicates (B*)."""

from diffloom.functions.text import *  # noqa: F401,F403
from diffloom.functions.filters import *  # noqa: F401,F403
