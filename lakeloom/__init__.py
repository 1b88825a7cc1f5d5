"""lakeloom: analytics, retrieval and data-quality jobs as plain DataFrame functions."""

__version__ = "0.1.0"
