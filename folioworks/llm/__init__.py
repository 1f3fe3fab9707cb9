"""Operators for training-data pipelines. Nothing else in the library imports this subpackage."""

import folioworks.operators  # noqa: F401  (its helpers, like these, travel inside the tasks)
