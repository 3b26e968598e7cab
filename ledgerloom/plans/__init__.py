"""Preset feature tables composed of the operators."""
