"""Import every query module so the registry is complete."""

from barwatch.plans import batch  # noqa: F401
from barwatch.plans import reports  # noqa: F401
from barwatch.plans import streams  # noqa: F401
from barwatch.plans import ml  # noqa: F401
from barwatch.plans import ingest  # noqa: F401
