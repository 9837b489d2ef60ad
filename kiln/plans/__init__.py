"""Named queries over the driver tables, one module per operator family."""

from kiln.plans import encoding, evaluation, models, setsorder, statistics, tabular, text  # noqa: F401
