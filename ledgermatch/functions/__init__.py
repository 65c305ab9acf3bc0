"""Column expressions (scalar functions, F1-F17 of the survey)."""

from ledgermatch.functions.scalars import *  # noqa: F401,F403
