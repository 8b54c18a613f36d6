"""The options every read and write takes, checked once and up front."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from vectable.plans.errors import OptionError

# The defaults users of the options rely on.
DEFAULT_DATABASE = "default"
DEFAULT_BATCHSIZE = 1000


@dataclass(frozen=True)
class CollectionOptions:
    """Where a collection lives and how it is batched.

    ``uri`` is a directory on any file system Spark can reach. ``token`` is
    accepted for call compatibility and unused. ``batchsize`` bounds the rows of
    one fetch batch or written file; files are only bounded when it was given,
    because 1000-row files would bury a large collection in small files.
    """

    uri: str
    collection: str
    database: str = DEFAULT_DATABASE
    token: str = ""
    batchsize: int = DEFAULT_BATCHSIZE
    batchsize_given: bool = False
    version: str = ""  # of the data; the definition names it

    @classmethod
    def of(cls, options: CollectionOptions | Mapping[str, object]) -> CollectionOptions:
        if isinstance(options, CollectionOptions):
            return options
        given = {str(k).lower(): v for k, v in options.items()}
        return cls(
            uri=_path(given, "uri"),
            collection=_name(given, "collection", None),
            database=_name(given, "database", DEFAULT_DATABASE),
            token=str(given.get("token", "")),
            batchsize=_positive_int(given, "batchsize", DEFAULT_BATCHSIZE),
            batchsize_given="batchsize" in given,
        )

    @property
    def database_path(self) -> str:
        return f"{self.uri.rstrip('/')}/{self.database}"

    @property
    def collection_path(self) -> str:
        return f"{self.database_path}/{self.collection}"

    @property
    def data_path(self) -> str:
        return f"{self.collection_path}/data{self._suffix}"

    @property
    def ids_path(self) -> str:
        return f"{self.collection_path}/_ids{self._suffix}"

    @property
    def _suffix(self) -> str:
        return f"-{self.version}" if self.version else ""

    @property
    def descriptor_path(self) -> str:
        return f"{self.collection_path}/_collection.json"


def _path(given: Mapping[str, object], key: str) -> str:
    value = given.get(key)
    if value is None or not str(value).strip():
        raise OptionError(f"{key} parameter is required")
    return str(value)


def _name(given: Mapping[str, object], key: str, default: str | None) -> str:
    value = given.get(key, default)
    if value is None or not str(value).strip():
        raise OptionError(f"{key} parameter is required")
    name = str(value)
    # A name is one directory level, and Spark skips those starting with _ or .
    if "/" in name or name[0] in "_.":
        raise OptionError(f"{key} must not contain '/' nor start with '_' or '.': {name!r}")
    return name


def _positive_int(given: Mapping[str, object], key: str, default: int) -> int:
    text = str(given.get(key, default)).strip()
    if not text.isascii() or not text.isdigit() or int(text) == 0:
        raise OptionError(f"{key} must be a positive integer: {text!r}")
    return int(text)
