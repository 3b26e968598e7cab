"""Column expressions evaluated per row."""

from ledgerloom.functions.rowwise import *  # noqa: F401,F403
