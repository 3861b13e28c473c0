"""Errors raised by the jobs, so that callers can tell a missing input from a bad one."""


class LayerError(Exception):
    """Base class of every error raised by this library."""


class IngestionError(LayerError):
    """A source is missing or not what it should be."""


class ContractError(LayerError):
    """A table breaks one of its declared rules."""


class ConfigurationError(LayerError):
    """A setting is missing or wrong."""
