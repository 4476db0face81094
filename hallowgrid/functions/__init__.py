from . import geo, scalar, text  # noqa: F401
