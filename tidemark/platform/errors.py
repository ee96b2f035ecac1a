"""Errors of the platform layer."""


class TidemarkError(Exception):
    """Base of all errors raised here."""


class ConfigurationError(TidemarkError):
    """Something about the configuration."""


class ConfigurationFileNotFoundError(ConfigurationError):
    """A configuration file is missing."""


class ConfigurationParseError(ConfigurationError):
    """A configuration file can't be read as a mapping."""


class ConfigurationValidationError(ConfigurationError):
    """The merged configuration doesn't fit the settings."""
