"""Query plans: dashboard reports, quality/health checks, the registered catalog."""

from tickwise.plans import quality, reports  # noqa: F401
