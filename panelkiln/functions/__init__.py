"""Column-expression helpers. Every helper returns a ``Column``; none starts a job."""
