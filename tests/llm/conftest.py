from .fixtures import docs, empty  # noqa: F401
