from . import codes, dates, money  # noqa: F401
