"""Contracts, discovery, secured views and access audit over the session catalog."""
