"""Errors raised while planning, before any Spark job starts."""


class VectableError(Exception):
    """Base class of the package's own errors."""


class OptionError(VectableError, ValueError):
    """A read or write option is missing or malformed."""


class CollectionNotFoundError(VectableError):
    """The named collection does not exist in the named database."""


class CollectionExistsError(VectableError):
    """A collection of that name is already there."""


class SaveModeError(VectableError):
    """The save mode is not append."""


class SchemaError(VectableError, ValueError):
    """A collection definition, or a DataFrame bound to one, is not valid."""


class UnsupportedTypeError(SchemaError):
    """A field or column has a type that collections cannot hold."""
