"""Structured Streaming use of fitted operators (see ``scoring``)."""
